"""Chat rendering, response splitting, filters, reshapes and prompts."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairloom.constants import NESTED_MRC_COLUMNS, NO_ANSWER, SUMMARY_TYPES, WIDE_SUMMARY_COLUMNS
from pairloom.operators import chat, prompts
from pairloom.operators.filters import drop_incomplete, drop_marked, to_pairs
from pairloom.operators.reshape import flatten_qa, unpivot_targets
from pairloom.plans import datasets
from pairloom.schemas import MESSAGES, NESTED_MRC


def conversations(spark, *lists):
    return spark.createDataFrame([(i, m) for i, m in enumerate(lists)], f"id long, messages {MESSAGES.simpleString()}")


def test_ensure_system(spark):
    frame = conversations(
        spark, [("system", "s"), ("user", "u")], [("user", "u")], [("user", "u"), ("system", "late")]
    )
    roles = lambda message: [
        [m["role"] for m in r[0]]
        for r in frame.orderBy("id").select(chat.ensure_system("messages", message)).collect()
    ]
    assert roles("be kind") == [["system", "user"], ["system", "user"], ["system", "user", "system"]]
    assert roles("") == roles(None) == [["system", "user"], ["user"], ["user", "system"]]
    with pytest.raises(Exception, match="at least one message"):
        conversations(spark, []).select(chat.ensure_system("messages", "x")).collect()


def test_ensure_system_turns_equals_array_form(spark):
    long = spark.createDataFrame(
        [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "system", "s"), (2, 1, "user", "c")],
        "conv_id long, turn long, role string, text string",
    )
    rows = sorted(chat.ensure_system_turns(long, "sys").collect())
    assert rows[0] == (1, -1, "system", "sys") and len(rows) == 5
    assert chat.ensure_system_turns(long, None).count() == 4


def test_render_chat_and_generation_prompt(spark):
    frame = spark.createDataFrame([(" hi ", "yo")], "inputs string, targets string")
    chatml = chat.render_chat(frame, chat.CHATML, "S").head()["prompt"]
    assert chatml == (
        "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\n hi <|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"
    )
    headers = chat.render_generation_prompt(frame, chat.HEADERS, None).head()["prompt"]
    assert headers == (
        "<|begin_of_text|><|start_header_id|>user<|end_header_id|>\n\nhi<|eot_id|>"
        "<|start_header_id|>assistant<|end_header_id|>\n\n"
    )
    whole = chat.render_chat(frame, chat.CHATML, None).head()["prompt"]
    assert whole.startswith(chat.render_generation_prompt(frame, chat.CHATML, None).head()["prompt"])


@pytest.mark.parametrize(
    "generated, user, assistant",
    [
        ("user hi assistant A assistant B", "hi", "A assistant B"),
        ("user only users", "only s", ""),
        ("\n user \x1c x assistant\n", "x", ""),
        ("", "", ""),
    ],
)
def test_split_response_strict(spark, generated, user, assistant):
    frame = spark.createDataFrame([(1, generated)], "id long, generated_text string")
    assert chat.split_responses(frame).collect() == [(1, user, assistant)]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["user", "assistant", " ", "\n", "x", "us", "er", "é"]), max_size=9), min_size=1, max_size=30))
def test_split_response_like_python(spark, samples):
    """Cut at the first tag, drop every "user" before it, strip both."""
    texts = ["".join(s) for s in samples]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, generated_text string")
    want = []
    for i, text in enumerate(texts):
        head, _, tail = text.partition("assistant")
        want.append((i, head.replace("user", "").strip(), tail.strip()))
    assert sorted(tuple(r) for r in chat.split_responses(frame).collect()) == want


def test_split_response_tagged(spark):
    """Role words inside the texts survive."""
    frame = spark.createDataFrame([("ask the user's assistant", "the assistant says")], "inputs string, targets string")
    for fmt in (chat.CHATML, chat.HEADERS):
        rendered = chat.render_chat(frame, fmt, "You help the user.").select("prompt")
        assert chat.split_responses(rendered, "prompt", "tagged", fmt).collect() == [
            ("ask the user's assistant", "the assistant says")
        ]
    with pytest.raises(ValueError, match="mode"):
        chat.split_response("x", mode="loose")


def test_drop_marked(spark):
    frame = spark.createDataFrame([("an RSS feed",), ("an rss feed",), (None,), ("نمایش پروفایل",)], "t string")
    assert {r["t"] for r in drop_marked(frame, "t").collect()} == {None, "an rss feed"}
    assert drop_marked(frame, "t", ()).count() == 4
    assert drop_marked(frame.dropna(), "t", ("(", ".")).count() == 3


def test_drop_incomplete_and_pairs(spark):
    frame = spark.createDataFrame([(1, "a", None), (2, "b", "c")], "id long, x string, y string")
    assert drop_incomplete(frame).count() == 1 and drop_incomplete(frame, ["x"]).count() == 2
    assert to_pairs(frame, "x", F.upper("y")).columns == ["inputs", "targets"]


def test_unpivot_keeps_nulls(spark):
    frame = spark.createDataFrame([("c", "one", None, "three", "four")], ", ".join(f"{c} string" for c in WIDE_SUMMARY_COLUMNS))
    rows = unpivot_targets(frame, ["context"]).collect()
    assert {(r["type"], r["summary"]) for r in rows} == set(zip(SUMMARY_TYPES, ("one", None, "three", "four")))


def mrc_frame(spark):
    return spark.createDataFrame(
        [
            ("c1", [("q1", "a1"), ("q2", "a2")], ("u", NO_ANSWER)),
            ("c2", [], ("u2", NO_ANSWER)),
            ("c3", None, ("u3", None)),
        ],
        NESTED_MRC,
    )


def test_flatten_qa(spark):
    rows = [(r["context"], r["question_no"], r["question"]) for r in flatten_qa(mrc_frame(spark)).collect()]
    assert sorted(rows) == [("c1", 0, "q1"), ("c1", 1, "q2"), ("c1", 2, "u"), ("c2", 0, "u2"), ("c3", 0, "u3")]


def test_mrc_pairs_layouts(spark):
    nested = mrc_frame(spark)
    assert tuple(nested.columns) == NESTED_MRC_COLUMNS
    rows = datasets.mrc_pairs(nested).collect()
    assert len(rows) == 4 and all(NO_ANSWER in r["inputs"] for r in rows)
    flat = spark.createDataFrame([("c", "q \n", "a"), ("c", None, "a")], "context string, question string, answer string")
    (row,) = datasets.mrc_pairs(flat).collect()
    assert row["inputs"].endswith("Text: c\nQuestion: q") and row["targets"] == "a"
    with pytest.raises(ValueError, match="layout"):
        datasets.mrc_pairs(flat, layout="deep")


def test_summary_pairs(spark):
    wide = spark.createDataFrame(
        [("text {context} }{", "1", "2", None, "4"), ("RSS", "1", "2", "3", "4"), (None, "1", "2", "3", "4")],
        ", ".join(f"{c} string" for c in WIDE_SUMMARY_COLUMNS),
    )
    rows = datasets.summary_pairs(wide).collect()
    assert len(rows) == 8
    assert sum(r["inputs"] is None for r in rows) == 4
    assert all(r["inputs"].count("text {context} }{") == 1 for r in rows if r["inputs"])
    assert datasets.summary_pairs(wide, drop_nulls=True).count() == 3
    long = spark.createDataFrame([("RSS", "s", "title_generation")], "context string, summary string, type string")
    assert datasets.summary_pairs(long).count() == 1
    own = spark.createDataFrame([("title_generation", "T: {context}!")], "type string, template string")
    assert datasets.summary_pairs(long, own).collect() == [("T: RSS!", "s")]
    with pytest.raises(Exception, match="no template for"):
        datasets.summary_pairs(long.withColumn("type", F.lit("haiku"))).collect()


def test_choice_prompt(spark):
    schema = "inputs array<struct<question string>>, main_question struct<formal string>, target string"
    row = lambda n: ([(f"q{i}",) for i in range(n)], ("main ",), "3")
    (pair,) = datasets.choice_pairs(spark.createDataFrame([row(6)], schema)).collect()
    assert "1. q0\n2. q1\n3. q2\n4. q3\n5. q4\n" in pair["inputs"] and "q5" not in pair["inputs"]
    assert pair["targets"] == "3" and pair["inputs"] == pair["inputs"].strip()
    with pytest.raises(Exception, match="fewer than 5"):
        datasets.choice_pairs(spark.createDataFrame([row(4)], schema)).collect()


def test_default_templates_cover_every_type(spark):
    rows = prompts.default_templates(spark).collect()
    assert {r["type"] for r in rows} == set(SUMMARY_TYPES) and all("{context}" in r["template"] for r in rows)
