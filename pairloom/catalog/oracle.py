"""The registered queries again, as SQL over the given tables.

Written from the operators' definitions, with windows, unnesting and recursion
where the Spark side uses joins, aggregates and Arrow functions.
"""

from __future__ import annotations

from pairloom.catalog.spark_queries import (
    ACCUM,
    BATCH,
    BLOCK,
    EVERY,
    MAX_LEN,
    SYSTEM,
    TOKENS_PER_STEP,
    WORLD,
)
from pairloom.catalog.inputs import LETTERS, TURN_SPAN, VECTORS_PER_SIDE
from pairloom.constants import (
    ASCII_DIGITS,
    CHOICE_INTRO,
    MRC_INTRO,
    NO_ANSWER,
    NO_ANSWER_VARIANT,
    PAGE_MARKERS,
    PERSIAN_DIGITS,
    PUNCTUATION,
    SUMMARY_TEMPLATES,
    SUMMARY_TYPES,
    WHITESPACE,
)

GIB = 1024**3


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


SPACES = "(" + " || ".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"
SPACE_RUN = "'[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]+'"


def stripped(x: str) -> str:
    return f"trim({x}, {SPACES})"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, {SPACE_RUN}), lambda t: t <> '')"


def normalized(x: str) -> str:
    canonical = f"replace({x}, {text(NO_ANSWER_VARIANT)}, {text(NO_ANSWER)})"
    return f"translate({canonical}, {text(PERSIAN_DIGITS + PUNCTUATION)}, {text(ASCII_DIGITS)})"


PAIRS = f"""
turns AS (
  SELECT conv_id, turn, role, text,
         lead(role) OVER w AS next_role, lead(text) OVER w AS next_text, lag(role) OVER w AS prev_role,
         lag(text) OVER w AS prev_text
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
pairs AS (
  SELECT conv_id * {TURN_SPAN} + turn AS id, text AS inputs, next_text AS targets,
         CASE WHEN prev_role = 'system' THEN prev_text END AS system
  FROM turns WHERE role = 'user' AND next_role = 'assistant')"""


def thinned(x: str, key: str) -> str:
    """The derived prediction: every third token left out, unless key % 5 = 0."""
    kept = f"array_to_string(list_filter({words(x)}, lambda t, i: i % 3 <> 0), ' ')"
    return f"CASE WHEN {key} % 5 = 0 THEN {x} ELSE {kept} END"


EVAL = f"""{PAIRS},
raw AS (SELECT id, targets AS reference, {thinned('targets', 'id')} AS prediction FROM pairs),
ev AS (SELECT id, {normalized('prediction')} AS p, {normalized('reference')} AS r FROM raw),
tok AS (
  SELECT id, p, r, pt, rt, len(pt) AS np, len(rt) AS nr
  FROM (SELECT id, p, r, {words('p')} AS pt, {words('r')} AS rt FROM ev))"""

OVERLAP = f"""{EVAL},
grams AS (
  SELECT id, side, n, array_to_string(t[i:i + n - 1], chr(1)) AS gram, count(*) AS c
  FROM (SELECT id, 'p' AS side, pt AS t FROM tok UNION ALL SELECT id, 'r', rt FROM tok),
       range(1, 5) AS orders(n), unnest(range(1, len(t) - n + 2)) AS starts(i)
  GROUP BY id, side, n, gram),
shared AS (
  SELECT a.id, a.n, sum(least(a.c, b.c)) AS m
  FROM grams a JOIN grams b ON a.id = b.id AND a.n = b.n AND a.gram = b.gram AND a.side = 'p' AND b.side = 'r'
  GROUP BY a.id, a.n),
counts AS (
  SELECT tok.id, any_value(p) AS p, any_value(r) AS r, any_value(np) AS np, any_value(nr) AS nr,
         {', '.join(f"coalesce(max(CASE WHEN n = {n} THEN m END), 0)::INTEGER AS m{n}" for n in range(1, 5))}
  FROM tok LEFT JOIN shared ON tok.id = shared.id GROUP BY tok.id)"""

LCS = f"""{OVERLAP},
dp AS (
  SELECT id, pt, rt, 0 AS i, list_transform(range(0, len(rt) + 1), lambda j: 0::BIGINT) AS line FROM tok
  UNION ALL
  SELECT id, pt, rt, i + 1,
         list_reduce(
           list_transform(range(1, len(rt) + 1),
             lambda j: [CASE WHEN pt[i + 1] = rt[j] THEN line[j] + 1 ELSE line[j + 1] END]),
           lambda acc, v: list_append(acc, greatest(acc[len(acc)], v[1])), [0::BIGINT])
  FROM dp WHERE i < len(pt)),
longest AS (SELECT id, line[len(line)] AS lcs FROM dp WHERE i = len(pt))"""

# The k-th occurrence from the end meets the k-th from the end of the same word.
METEOR = f"""{LCS},
spread AS (
  SELECT id, side, w, pos, row_number() OVER (PARTITION BY id, side, w ORDER BY pos DESC) AS k
  FROM (SELECT id, 'p' AS side, lower(unnest(pt)) AS w, generate_subscripts(pt, 1) AS pos FROM tok
        UNION ALL SELECT id, 'r', lower(unnest(rt)), generate_subscripts(rt, 1) FROM tok)),
met AS (
  SELECT a.id, a.pos AS i, b.pos AS j FROM spread a JOIN spread b
  ON a.id = b.id AND a.w = b.w AND a.k = b.k AND a.side = 'p' AND b.side = 'r'),
linked AS (
  SELECT id, CASE WHEN i = lag(i) OVER w + 1 AND j = lag(j) OVER w + 1 THEN 0 ELSE 1 END AS opens
  FROM met WINDOW w AS (PARTITION BY id ORDER BY i)),
chunked AS (SELECT id, count(*) AS m, sum(opens) AS ch FROM linked GROUP BY id)"""

EM_SCORE = f"CASE WHEN lower({stripped('p')}) = lower({stripped('r')}) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
F1_SCORE = "CASE WHEN m1 = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * (m1::DOUBLE/np) * (m1::DOUBLE/nr) / (m1::DOUBLE/np + m1::DOUBLE/nr) END"


def _bleu() -> str:
    logs = []
    for n in range(1, 5):
        zeros = " + ".join(f"(m{k} = 0)::INTEGER" for k in range(1, n + 1))
        count = f"CASE WHEN m{n} > 0 THEN m{n}::DOUBLE ELSE ln(greatest(np, 2)) / (5 * power(2, {zeros})) END"
        logs.append(f"ln(({count}) / greatest(1, np - {n - 1}))")
    brevity = "CASE WHEN np > nr THEN 1.0::DOUBLE ELSE exp(1 - nr::DOUBLE / np) END"
    return f"CASE WHEN m1 = 0 OR np = 1 THEN 0.0::DOUBLE ELSE ({brevity}) * exp(({' + '.join(logs)}) / 4) END"


BLEU_SCORE = _bleu()


def _recall(found: str, possible: str) -> str:
    blank = f"{stripped('p')} = '' OR {stripped('r')} = ''"
    return f"CASE WHEN {blank} OR {possible} <= 0 THEN 0.0::DOUBLE ELSE {found}::DOUBLE / ({possible}) END"


ROUGE_1, ROUGE_2, ROUGE_L = _recall("m1", "nr"), _recall("m2", "nr - 1"), _recall("lcs", "nr")
METEOR_SCORE = (
    "CASE WHEN coalesce(m, 0) = 0 THEN 0.0::DOUBLE ELSE (1 - 0.5::DOUBLE * power(ch::DOUBLE / m, 3)) * "
    "(m::DOUBLE / np) * (m::DOUBLE / nr) / (0.9::DOUBLE * m / np + 0.1::DOUBLE * m / nr) END"
)
SCORED = f"""{METEOR},
scored AS (
  SELECT counts.id, {EM_SCORE} AS em, {F1_SCORE} AS f1, {BLEU_SCORE} AS bl,
         {ROUGE_1} AS r1, {ROUGE_2} AS r2, {ROUGE_L} AS rl, {METEOR_SCORE} AS me
  FROM counts LEFT JOIN longest ON counts.id = longest.id LEFT JOIN chunked ON counts.id = chunked.id)"""

SCORE_NAMES = [
    ("exact_match", "score", "em"),
    ("f1_score", "score", "f1"),
    ("bleu", "score", "bl"),
    ("rouge", "rouge-1", "r1"),
    ("rouge", "rouge-2", "r2"),
    ("rouge", "rouge-l", "rl"),
    ("meteor", "score", "me"),
]

MESSAGES = f"""{PAIRS},
full_chat AS (SELECT id, inputs, targets, coalesce(system, {text(SYSTEM)}) AS system FROM pairs)"""


def chatml(role: str, content: str) -> str:
    return f"'<|im_start|>{role}' || chr(10) || {content} || '<|im_end|>' || chr(10)"


def header(role: str, content: str) -> str:
    return f"'<|start_header_id|>{role}<|end_header_id|>' || chr(10) || chr(10) || {stripped(content)} || '<|eot_id|>'"


OPEN_TURN = "'<|im_start|>assistant' || chr(10)"
GENERATION = f"{chatml('system', text(SYSTEM))} || {chatml('user', 'inputs')} || {OPEN_TURN}"
CHAT = f"{chatml('system', text(SYSTEM))} || {chatml('user', 'inputs')} || {chatml('assistant', 'targets')}"

WIDE = """
wide AS (
  SELECT doc_id, text AS context,
         CASE WHEN len(string_split(text, chr(10))) > 1 THEN string_split(text, chr(10))[-1] END AS one_line_summary,
         lang || ' / ' || source AS title_generation,
         array_to_string(list_reverse(string_split(text, chr(10))), chr(10)) AS detailed_summary,
         '- ' || array_to_string(string_split(text, chr(10)), chr(10) || '- ') AS bullet_point_summary
  FROM documents)"""

UNMARKED = " AND ".join(f"NOT contains(context, {text(m)})" for m in PAGE_MARKERS)


def _summaries(ids: str, condition: str) -> str:
    """Template text around the context, by splitting the template at its slot."""
    branches = []
    for kind in SUMMARY_TYPES:
        before, after = SUMMARY_TEMPLATES[kind].split("{context}")
        branches.append(
            f"SELECT {ids}{text(before)} || context || {text(after)} AS inputs, {kind} AS targets "
            f"FROM wide WHERE {UNMARKED} AND ({condition.format(kind=kind)})"
        )
    return f"WITH {WIDE} " + " UNION ALL ".join(branches)


FLAT_QA = """
lines AS (SELECT doc_id, lang, text, string_split(text, chr(10)) AS l FROM documents),
qa AS (
  SELECT doc_id, text AS context, 0 AS question_no, l[1] AS question, l[2] AS answer
  FROM lines WHERE lang <> 'es' AND len(l) > 1
  UNION ALL
  SELECT doc_id, text, 1, l[-2], l[-1] FROM lines WHERE lang <> 'es' AND len(l) > 1
  UNION ALL
  SELECT doc_id, text, CASE WHEN lang <> 'es' AND len(l) > 1 THEN 2 ELSE 0 END, l[-1], {no_answer} FROM lines)""".format(
    no_answer=text(NO_ANSWER)
)


def mrc(context: str, question: str) -> str:
    return stripped(f"{text(MRC_INTRO + chr(10) * 2 + 'Text: ')} || {context} || chr(10) || 'Question: ' || {question}")


TOKEN_STREAM = f"""
toks AS (SELECT conv_id, turn, unnest(w) AS tok, generate_subscripts(w, 1) AS place
         FROM (SELECT conv_id, turn, {words('text')} AS w FROM conversations)),
placed AS (SELECT conv_id, turn, tok, row_number() OVER (ORDER BY conv_id, turn, place) - 1 AS g FROM toks),
blocks AS (
  SELECT g // {BLOCK} AS block_id, string_agg(tok, ' ' ORDER BY g) AS tokens,
         count(DISTINCT (conv_id, turn)) AS n_docs, count(*) AS n_tokens
  FROM placed GROUP BY 1)"""

STEPS = """
steps AS (
  SELECT user_id AS run, ts, event_id, event_type, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step
  FROM events),
runs AS (SELECT *, first_value(ts) OVER w AS start, sum(floor(value * 100)::BIGINT) OVER w AS done
         FROM steps WINDOW w AS (PARTITION BY run ORDER BY step))"""


def seconds(begin: str, end: str) -> str:
    return f"(date_diff('microsecond', {begin}, {end}) / 1000000.0::DOUBLE)"


def _throughput(done: str, seen: str = "true", closed: str = "true") -> str:
    return f"""WITH {STEPS},
kept AS (SELECT * REPLACE (min(ts) OVER (PARTITION BY run) AS start) FROM runs WHERE {seen}),
logged AS (SELECT *, lag(ts) OVER (PARTITION BY run ORDER BY step) AS prev FROM kept WHERE step % {EVERY} = 0)
SELECT run, step, round({done} / nullif({seconds('start', 'ts')}, 0), 6) AS throughput,
       round({seconds('coalesce(prev, start)', 'ts')}, 6) AS elapsed_time FROM logged WHERE {closed}"""


def _gpu(k: int) -> str:
    return f"""
  SELECT run, step, 'gpu_{k - 1}_utilization', value / {k} FROM s WHERE event_type <> 'error' UNION ALL
  SELECT run, step, 'gpu_{k - 1}_memory_allocated_gib', value * 1e9 / {k} / {GIB} FROM s WHERE event_type <> 'error' UNION ALL
  SELECT run, step, 'gpu_{k - 1}_memory_reserved_gib', value * 2e9 / {k} / {GIB} FROM s WHERE event_type <> 'error'"""


RATES = f"""
rates AS (
  SELECT user_id AS run, time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01') AS w, count(*) AS steps,
         min(ts) AS a, max(ts) AS b FROM events GROUP BY 1, 2),
shown AS (
  SELECT run, w, epoch(w)::BIGINT AS window_start, steps, round({seconds('a', 'b')}, 6) AS span,
         round(steps * {TOKENS_PER_STEP} / 21600.0::DOUBLE, 6) AS tokens_per_second FROM rates)"""

HASH_DOC = "md5('7:' || doc_id)"


def _below(size: float) -> str:
    return text(f"{int(size * 16**13):013x}")


def _soft() -> str:
    span = 2 * VECTORS_PER_SIDE
    best = lambda mine, other: f"""
  SELECT a.id, a.vec_id, max(list_cosine_similarity(a.v, b.v)) AS best FROM tv a JOIN tv b
  ON a.id = b.id AND a.side = {mine} AND b.side = {other} GROUP BY a.id, a.vec_id"""  # noqa: E731
    return f"""WITH tv AS (
  SELECT vec_id // {span} AS id, vec_id, vec_id % 2 AS side, embedding::DOUBLE[] AS v FROM embeddings),
p AS (SELECT id, avg(best) AS precision FROM ({best(0, 1)}) GROUP BY id),
r AS (SELECT id, avg(best) AS recall FROM ({best(1, 0)}) GROUP BY id),
soft AS (SELECT id, precision, recall, CASE WHEN precision + recall = 0 THEN 0
         ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM p JOIN r USING (id))"""


SOFT = _soft()


def letters(tok: str) -> str:
    """Soft alignment of the token lists of `tok`, a vector being a token's length and counts of letters."""
    counts = ", ".join(f"length(t) - length(replace(t, '{c}', ''))" for c in LETTERS)
    return f"""
said AS (SELECT id, side, t, count(*) AS c, [length(t), {counts}]::DOUBLE[] AS v
  FROM (SELECT id, 0 AS side, unnest(pt) AS t FROM {tok} UNION ALL SELECT id, 1, unnest(rt) FROM {tok}) GROUP BY id, side, t),
nearest AS (SELECT a.id, a.side, a.t, any_value(a.c) AS c, max(list_cosine_similarity(a.v, b.v)) AS best
  FROM said a JOIN said b ON a.id = b.id AND a.side <> b.side GROUP BY a.id, a.side, a.t),
sides AS (SELECT {tok}.id, coalesce(sum(c * best) FILTER (side = 0) / sum(c) FILTER (side = 0), 0) AS precision,
    coalesce(sum(c * best) FILTER (side = 1) / sum(c) FILTER (side = 1), 0) AS recall
  FROM {tok} LEFT JOIN nearest USING (id) GROUP BY {tok}.id),
soft AS (SELECT id, precision, recall, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM sides)"""


def _stage(name: str, before: list[str], form: str) -> str:
    """One stage of METEOR: among words no earlier stage has met, the k-th from the end meets the k-th of its form."""
    met = " UNION ALL ".join(f"SELECT * FROM {b}" for b in before)
    free = lambda side, at: f"AND NOT EXISTS (SELECT 1 FROM ({met}) m WHERE m.id = s.id AND m.{at} = s.pos)" if before else ""
    ranked = lambda side, at: f"""
    SELECT id, pos, {form} AS w, row_number() OVER (PARTITION BY id, {form} ORDER BY pos DESC) AS k
    FROM mwords s WHERE side = '{side}' {free(side, at)}"""  # noqa: E731
    return f"""
{name} AS (SELECT a.id, a.pos AS i, b.pos AS j FROM ({ranked('p', 'i')}) a JOIN ({ranked('r', 'j')}) b USING (id, w, k))"""


# Synonyms: from the end, each free word takes the last free reference word that is one.
STEM_SYNONYMS = f"""WITH {PAIRS},
mtok AS (SELECT id, {words(normalized('inputs'))} AS pt, {words(normalized('targets'))} AS rt FROM pairs),
mwords AS (SELECT id, 'p' AS side, lower(unnest(pt)) AS w, generate_subscripts(pt, 1) AS pos FROM mtok
  UNION ALL SELECT id, 'r', lower(unnest(rt)), generate_subscripts(rt, 1) FROM mtok),
vocabulary AS (SELECT DISTINCT w FROM (SELECT unnest({words(f"lower({normalized('text')})")}) AS w FROM documents) WHERE length(w) > 3),
alike AS (SELECT w, lag(w) OVER o AS a, lead(w) OVER o AS b FROM vocabulary WINDOW o AS (PARTITION BY left(w, 3) ORDER BY w)),
synonyms AS (SELECT w, a AS syn FROM alike WHERE a IS NOT NULL UNION ALL SELECT w, b FROM alike WHERE b IS NOT NULL),
{_stage('exact', [], 'w')},
{_stage('stems', ['exact'], "CASE WHEN length(w) > 3 AND w LIKE '%s' THEN left(w, length(w) - 1) ELSE w END")},
earlier AS (SELECT * FROM exact UNION ALL SELECT * FROM stems),
open_p AS (SELECT * FROM mwords s WHERE side = 'p' AND NOT EXISTS (SELECT 1 FROM earlier m WHERE m.id = s.id AND m.i = s.pos)),
open_r AS (SELECT * FROM mwords s WHERE side = 'r' AND NOT EXISTS (SELECT 1 FROM earlier m WHERE m.id = s.id AND m.j = s.pos)),
choices AS (SELECT p.id, p.pos AS i, list(r.pos ORDER BY r.pos DESC) AS js
  FROM open_p p JOIN synonyms USING (w) JOIN open_r r ON r.id = p.id AND r.w = syn GROUP BY p.id, p.pos),
taken AS (SELECT id, list(i ORDER BY i DESC) AS places, list_reduce([[]::BIGINT[]] || list(js ORDER BY i DESC),
    lambda used, js: list_append(used, coalesce(list_filter(js, lambda j: NOT list_contains(used, j))[1], -1))) AS used
  FROM choices GROUP BY id),
matched AS (SELECT * FROM earlier UNION ALL
  SELECT id, i, j FROM (SELECT id, unnest(places) AS i, unnest(used) AS j FROM taken) WHERE j > 0),
steps_of AS (SELECT id, CASE WHEN i = lag(i) OVER o + 1 AND j = lag(j) OVER o + 1 THEN 0 ELSE 1 END AS opens
  FROM matched WINDOW o AS (PARTITION BY id ORDER BY i)),
counted AS (SELECT id, count(*) AS m, sum(opens) AS ch FROM steps_of GROUP BY id)"""

ORACLE: dict[str, str] = {
    "normalize_text": f"SELECT doc_id, {normalized('text')} AS normalized, {stripped('text')} AS stripped FROM documents",
    "exact_match": f"WITH {EVAL} SELECT id, {EM_SCORE} AS exact_match FROM tok",
    "token_f1": f"WITH {OVERLAP} SELECT id, round({F1_SCORE}, 6) AS f1_score FROM counts",
    "bleu": f"WITH {OVERLAP} SELECT id, round({BLEU_SCORE}, 6) AS bleu FROM counts",
    "rouge": f"""WITH RECURSIVE {LCS} SELECT id, round({ROUGE_1}, 6) AS rouge_1, round({ROUGE_2}, 6) AS rouge_2,
        round({ROUGE_L}, 6) AS rouge_l FROM counts JOIN longest USING (id)""",
    "meteor": f"WITH RECURSIVE {SCORED} SELECT id, round(me, 6) AS meteor FROM scored",
    "ngram_overlap": f"""WITH {OVERLAP} SELECT id, np::INTEGER AS n_pred, nr::INTEGER AS n_ref, m1, m2, m3, m4 FROM counts""",
    "soft_alignment": f"""{SOFT} SELECT id, round(precision, 6) AS precision, round(recall, 6) AS recall,
        round(f1, 6) AS f1 FROM soft""",
    "eval_report": f"WITH RECURSIVE {SCORED} "
    + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, '{s}' AS sub_metric, round(avg({c}), 6) AS score, count(*) AS n FROM scored"
        for m, s, c in SCORE_NAMES
    ),
    "score_examples": f"WITH RECURSIVE {SCORED} "
    + " UNION ALL ".join(
        f"SELECT id, '{m}' AS metric, '{s}' AS sub_metric, round({c}, 6) AS score FROM scored" for m, s, c in SCORE_NAMES
    ),
    "bert_score_texts": f"""WITH {EVAL}, {letters('tok')}
        SELECT id, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM soft""",
    "mrc_report": f"""WITH ev AS (SELECT item_id AS id, {normalized(thinned('text', 'item_id'))} AS p, {normalized('text')} AS r FROM benchmark),
tok AS (SELECT id, p, r, {words('p')} AS pt, {words('r')} AS rt FROM ev), {letters('tok')},
c AS (SELECT id, w, sum(a) AS a, sum(b) AS b FROM (
  SELECT id, unnest(pt) AS w, 1 AS a, 0 AS b FROM tok UNION ALL SELECT id, unnest(rt), 0, 1 FROM tok) GROUP BY id, w),
f AS (SELECT id, 2.0::DOUBLE * sum(least(a, b)) / (sum(a) + sum(b)) AS f1, {EM_SCORE} AS em,
      any_value(soft.precision) AS sp, any_value(soft.recall) AS sr, any_value(soft.f1) AS sf FROM c JOIN ev USING (id) JOIN soft USING (id) GROUP BY id, p, r)
SELECT 'f1_score' AS metric, 'score' AS sub_metric, round(avg(f1), 6) AS score, count(*) AS n FROM f UNION ALL
SELECT 'exact_match', 'score', round(avg(em), 6), count(*) FROM f UNION ALL
SELECT 'bert_score', 'precision', round(avg(sp), 6), count(sp) FROM f UNION ALL
SELECT 'bert_score', 'recall', round(avg(sr), 6), count(sr) FROM f UNION ALL
SELECT 'bert_score', 'f1', round(avg(sf), 6), count(sf) FROM f""",
    "meteor_stem_synonyms": f"""{STEM_SYNONYMS}
        SELECT t.id, coalesce(m, 0) AS matches, coalesce(ch, 0)::BIGINT AS chunks, round({METEOR_SCORE}, 6) AS meteor
        FROM (SELECT id, len(pt) AS np, len(rt) AS nr FROM mtok) t LEFT JOIN counted ON t.id = counted.id""",
    "pair_by_key": """SELECT doc_id AS id, text AS prediction, CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END AS reference
        FROM documents JOIN labels USING (doc_id)""",
    "unmatched": """SELECT 'prediction' AS side, count(*) AS n_unmatched FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL
        SELECT 'reference', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""",
    "pair_by_position": """WITH n AS (SELECT role, text, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) - 1 AS id
        FROM conversations)
        SELECT u.id, u.text AS prediction, a.text AS reference FROM n u JOIN n a ON u.id = a.id
        WHERE u.role = 'user' AND a.role = 'assistant'""",
    "ensure_system": f"WITH {MESSAGES} SELECT id, 'system,user,assistant' AS roles, system AS first_content FROM full_chat",
    "ensure_system_turns": f"""WITH o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations)
        SELECT conv_id, turn, role, text FROM conversations UNION ALL
        SELECT conv_id, turn - 1, 'system', {text(SYSTEM)} FROM o WHERE k = 1 AND role <> 'system'""",
    "render_messages": f"""WITH {MESSAGES} SELECT id, {chatml('system', 'system')} || {chatml('user', 'inputs')} ||
        {chatml('assistant', 'targets')} AS prompt FROM full_chat""",
    "render_chat": f"WITH {PAIRS} SELECT id, inputs, targets, {CHAT} AS prompt FROM pairs",
    "render_chat_headers": f"""WITH {PAIRS} SELECT id, '<|begin_of_text|>' || {header('user', 'inputs')} ||
        {header('assistant', 'targets')} AS prompt FROM pairs""",
    "generation_prompt": f"WITH {PAIRS} SELECT id, {GENERATION} AS prompt FROM pairs",
    "split_response": f"""WITH {PAIRS}, g AS (SELECT id, {chatml('user', 'inputs')} || {chatml('assistant', 'targets')} AS t FROM pairs),
        h AS (SELECT id, t, strpos(t, 'assistant') AS k FROM g)
        SELECT id, {stripped("replace(substr(t, 1, k - 1), 'user', '')")} AS user, {stripped('substr(t, k + 9)')} AS assistant FROM h""",
    "split_response_tagged": f"WITH {PAIRS} SELECT id, {stripped('inputs')} AS user, {stripped('targets')} AS assistant FROM pairs",
    "drop_marked": f"SELECT doc_id, lang, n_chars FROM documents WHERE {UNMARKED.replace('context', 'text')}",
    "drop_incomplete": f"WITH {WIDE} SELECT * FROM wide WHERE one_line_summary IS NOT NULL",
    "training_pairs": f"WITH {PAIRS} SELECT id, inputs, targets FROM pairs",
    "unpivot_targets": f"WITH {WIDE} "
    + " UNION ALL ".join(f"SELECT doc_id, '{k}' AS type, {k} AS summary FROM wide" for k in SUMMARY_TYPES),
    "flatten_qa": f"WITH {FLAT_QA} SELECT doc_id, question_no::BIGINT AS question_no, question, answer FROM qa",
    "summary_pairs": _summaries("doc_id, ", "true"),
    "summary_pairs_complete": _summaries("", "{kind} IS NOT NULL"),
    "choice_pairs": f"""WITH g AS (SELECT item_id // 5 AS group_id, list(text ORDER BY item_id) AS c FROM benchmark GROUP BY 1)
        SELECT group_id, {text(CHOICE_INTRO)} || chr(10) || chr(10) ||
          {' || '.join(f"'{i}. ' || c[{i}] || chr(10)" for i in range(1, 6))} || chr(10) || 'Target: ' ||
          c[group_id % 5 + 1] || chr(10) || chr(10) || 'Number:' AS inputs,
          (group_id % 5 + 1)::VARCHAR AS targets FROM g""",
    "mrc_pairs": f"WITH {FLAT_QA} SELECT doc_id, question_no::BIGINT AS question_no, {mrc('context', 'question')} AS inputs, answer AS targets FROM qa",
    "mrc_prompts_flat": f"WITH {PAIRS} SELECT {mrc('inputs', 'targets')} AS inputs, id::VARCHAR AS targets FROM pairs",
    "split_exact": f"""SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {HASH_DOC}, doc_id) <=
        ceil(0.2 * (SELECT count(*) FROM documents)) THEN 'test' ELSE 'train' END AS split FROM documents""",
    "split_exact_repeats": """WITH o AS (SELECT source, row_number() OVER (ORDER BY md5('7:' || source), source) AS k,
          count(*) OVER () AS n FROM documents)
        SELECT source, CASE WHEN k <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split, count(*) AS n_rows FROM o GROUP BY 1, 2""",
    "split_threshold": f"""SELECT conv_id, turn, CASE WHEN md5('7:' || length(conv_id::VARCHAR) || '=' || conv_id || ':' || length(turn::VARCHAR) || '=' || turn) < {_below(0.1)}
        THEN 'test' ELSE 'train' END AS split FROM conversations""",
    "tokenize": f"""SELECT conv_id, turn, len({words('text')}) AS n_tokens, array_to_string({words('text')}, '|') AS tokens
        FROM conversations""",
    "count_tokens": f"SELECT lang, sum(len({words('text')}))::BIGINT AS n_tokens FROM documents GROUP BY lang",
    "count_tokens_total": f"SELECT sum(len({words('text')}))::BIGINT AS n_tokens FROM documents",
    "pack_sequences": f"WITH {TOKEN_STREAM} SELECT * FROM blocks WHERE n_tokens = {BLOCK}",
    "pack_sequences_tail": f"WITH {TOKEN_STREAM} SELECT * FROM blocks",
    "batch_generate": f"""WITH {PAIRS}, g AS (SELECT id, {GENERATION} AS t FROM pairs)
        SELECT id, t || length(t) || ' at 0.5' AS generated_text FROM g""",
    "generate_responses": f"""WITH {PAIRS}, g AS (SELECT id, {chatml('user', 'inputs')} || {OPEN_TURN} AS t FROM pairs),
        h AS (SELECT id, t || length(t) || ' at 0.5' AS t, strpos(t, 'assistant') AS k FROM g)
        SELECT id, {stripped("replace(substr(t, 1, k - 1), 'user', '')")} AS user, {stripped('substr(t, k + 9)')} AS assistant FROM h""",
    "throughput": _throughput(f"(step * {BATCH * MAX_LEN * ACCUM * WORLD})"),
    "throughput_actual": _throughput("done"),
    "throughput_gaps": _throughput(f"(step * {BATCH * MAX_LEN * ACCUM * WORLD})", "event_type <> 'error'"),
    "throughput_running": _throughput(
        f"(step * {BATCH * MAX_LEN * ACCUM * WORLD})",
        closed="ts <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)",
    ),
    "epoch_throughput": f"""WITH {STEPS},
        f AS (SELECT run, day(ts)::BIGINT AS epoch, max(ts) AS b, max(step) AS step, min(start) AS start FROM runs GROUP BY 1, 2),
        e AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY run ORDER BY epoch), start) AS a FROM f)
        SELECT run, epoch, step,
          round((step // {EVERY}) * {EVERY * BATCH * MAX_LEN * ACCUM * WORLD} / nullif({seconds('start', 'b')}, 0), 6) AS throughput,
          round({seconds('a', 'b')}, 6) AS elapsed_time FROM e""",
    "sample_metrics": f"""WITH {STEPS}, s AS (SELECT * FROM steps WHERE step % {EVERY} = 0),
        m(run, step, metric, value) AS (
  SELECT run, step, 'cpu_utilization', value FROM s UNION ALL
  SELECT run, step, 'ram_usage_gib', value * 1e8 / {GIB} FROM s UNION ALL
  SELECT run, step, 'ram_available_gib', value * 2e8 / {GIB} FROM s UNION ALL
  SELECT run, step, 'disk_read_gib', value * 3e7 / {GIB} FROM s UNION ALL
  SELECT run, step, 'disk_write_gib', value * 4e7 / {GIB} FROM s UNION ALL {_gpu(1)} UNION ALL {_gpu(2)})
        SELECT run, step, metric, round(value, 6) AS value FROM m""",
    "throughput_windows": f"WITH {RATES} SELECT run, window_start, steps, span, tokens_per_second FROM shown",
    "throughput_stream": f"""WITH {RATES} SELECT run, window_start, steps, span, tokens_per_second FROM shown
        WHERE w + INTERVAL 6 HOURS <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)""",
    "csv_round_trip": f"WITH {PAIRS} SELECT id, inputs, targets FROM pairs",
    "jsonl_dir": f"""WITH {WIDE} SELECT doc_id, one_line_summary, title_generation FROM wide WHERE one_line_summary IS NOT NULL""",
    # By name: whole and half numbers are doubles, numbers and names are text, and rows that lack a column are lost.
    "jsonl_union": """SELECT * FROM (
          SELECT doc_id, n_chars AS size, lang, source AS origin FROM documents WHERE lang = 'en' UNION ALL BY NAME
          SELECT doc_id, n_chars + 0.5::DOUBLE AS size, lang, length(source)::VARCHAR AS origin FROM documents WHERE lang = 'fr' UNION ALL BY NAME
          SELECT doc_id, n_chars AS size, lang FROM documents WHERE lang IN ('de', 'es'))
        WHERE origin IS NOT NULL""",
    "infer_then_evaluate": f"""WITH {PAIRS}, h AS (SELECT id, inputs, list_filter({words('inputs')}, lambda t, i: i % 2 = 1) AS half FROM pairs),
        n AS (SELECT id, {normalized("array_to_string(half, ' ')")} AS p, {normalized('inputs')} AS r FROM h),
        tok AS (SELECT id, p, r, {words('p')} AS pt, {words('r')} AS rt FROM n),
        c AS (SELECT id, w, sum(a) AS a, sum(b) AS b FROM (
          SELECT id, unnest(pt) AS w, 1 AS a, 0 AS b FROM tok UNION ALL SELECT id, unnest(rt), 0, 1 FROM tok) GROUP BY id, w),
        f AS (SELECT tok.id, any_value({EM_SCORE}) AS em, coalesce(2.0::DOUBLE * sum(least(a, b)) / (sum(a) + sum(b)), 0) AS f1
          FROM tok LEFT JOIN c ON c.id = tok.id GROUP BY tok.id),
        m AS (SELECT 'f1_score' AS metric, round(avg(f1), 6) AS score, count(*) AS n FROM f UNION ALL
          SELECT 'exact_match', round(avg(em), 6), count(*) FROM f)
        SELECT way, metric, score, n FROM m, (VALUES ('key'), ('position')) AS ways(way)""",
    "registered_metric": f"""WITH {EVAL} SELECT id, 'lengths' AS metric, 'ratio' AS sub_metric,
          round(least(length(p), length(r))::DOUBLE / greatest(1, length(p), length(r)), 6) AS score FROM ev UNION ALL
        SELECT id, 'lengths', 'longer', (length(p) > length(r))::INTEGER::DOUBLE FROM ev UNION ALL
        SELECT id, 'exact_match', 'score', {EM_SCORE} FROM ev""",
    "splits_round_trip": f"""WITH {PAIRS} SELECT id, {CHAT} AS prompt,
        CASE WHEN md5('7:' || id) < {_below(0.2)} THEN 'test' ELSE 'train' END AS split FROM pairs""",
    "scores_round_trip": f"""WITH {OVERLAP}
        SELECT 'exact_match' AS metric, 'score' AS sub_metric, round(avg({EM_SCORE}), 6) AS score, count(*) AS n FROM counts UNION ALL
        SELECT 'f1_score', 'score', round(avg({F1_SCORE}), 6), count(*) FROM counts""",
}
