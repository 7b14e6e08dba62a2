"""Fixed values and defaults shared by operators and tests."""

import string

# Results depend on these exact strings.
PAGE_MARKERS = (
    "به تازگی فعال نبوده",
    "نمایش پروفایل",
    "RSS",
    "Votes",
)
NO_ANSWER_VARIANT = "پاسخ در متن وجود ندارد"
NO_ANSWER = "این اطلاعات در متن موجود نیست"
PERSIAN_DIGITS = "۰۱۲۳۴۵۶۷۸۹"
ASCII_DIGITS = "0123456789"
PUNCTUATION = string.punctuation + "،؛؟"
SUMMARY_TYPES = (
    "one_line_summary",
    "title_generation",
    "detailed_summary",
    "bullet_point_summary",
)
WIDE_SUMMARY_COLUMNS = ("context", *SUMMARY_TYPES)
NESTED_MRC_COLUMNS = ("context", "factual_questions", "unanswerable_question")
TASK_METRICS = {
    "summarization": ("bert_score", "rouge", "bleu", "meteor"),
    "mrc": ("f1_score", "exact_match", "bert_score"),
}

# The strings pandas reads as missing in a CSV field (its documented default).
CSV_NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# The 29 characters str.strip() and str.split() treat as whitespace.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# Our own wordings; callers replace them through arguments.
SYSTEM_MESSAGE = (
    "You are a careful assistant. Read the request, answer in the language it is "
    "written in, and say so when the material given does not hold the answer."
)
SUMMARY_TEMPLATES = {
    "one_line_summary": "Write one sentence that states the main point of this text.\n\n{context}",
    "title_generation": "Write a short title for this text. Reply with the title only.\n\n{context}",
    "detailed_summary": "Retell this text in full paragraphs, keeping every key point.\n\n{context}",
    "bullet_point_summary": "List the main points of this text, one per line after a dash.\n\n{context}",
}
CHOICE_INTRO = "Which of these questions asks the same thing as the target? Reply with its number only."
MRC_INTRO = (
    "Answer the question with the shortest span of the text that answers it. "
    f"If the text holds no answer, reply exactly: {NO_ANSWER}"
)
