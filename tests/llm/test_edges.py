"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pairloom.llm.hosts import host_quality
from pairloom.llm.jaccard import jaccard_components, nearest_kept
from pairloom.llm.language import identify_language
from pairloom.llm.lm import score_texts
from pairloom.llm.merkle import edited_fingerprints, fingerprints
from pairloom.llm.mixing import emit_mix, mix_sources
from pairloom.llm.packing import pack_documents
from pairloom.llm.roles import repair_roles
from pairloom.llm.text import fold
from pairloom.llm.toxicity import fit_toxicity, score_toxicity
from pairloom.llm.warc import round_trip

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = (
    "score size copies part g bucket token tokens set_id member root host words lines n ids train spread "
    "closing first seen amount before tie units lang_pred word body slice __text __size"
).split()
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", "a", 4),
    (4, "one", "fr", "b", 3),
    (4, "one", "fr", "b", 3),
    (5, "the cat sat on the mat and the dog sat on the log " * 4000, "en", "a", 200_000),
    (6, "12 34 ## 56", None, "b", 11),
    (None, "a row without an id but with some words in it", "en", "b", 45),
    (7, "Ünïcödé wörds ñandú 漢字 and <|endoftext|> it's 'quoted'   text", "de", "a", 50),
    (8, "x" * 70_000, "de", "a", 70_000),
]


@pytest.fixture(scope="module")
def nasty(spark):
    docs = spark.createDataFrame(ROWS, DOCS)
    return docs.select("*", *(F.lit("clash").alias(c) for c in CLASHES)).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(nasty):
    return nasty.where("false")


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=lambda i: (i is None, i))


ALL = sorted((r[0] for r in ROWS), key=lambda i: (i is None, i))


def test_language(nasty, empty):
    rows = identify_language(nasty, fold(F.col("doc_id"), 3) >= 0).collect()
    assert len(rows) == len(ROWS)
    by = {r["doc_id"]: r for r in rows}
    assert {by[i]["lang_pred"] for i in (1, 2, 3, 6)} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert by[5]["lang_pred"] == "en"
    assert identify_language(empty, F.lit(True)).count() == 0
    assert {r["lang_pred"] for r in identify_language(nasty, F.lit(False)).collect()} == {"und"}


def test_toxicity(spark, nasty, empty):
    labels = spark.createDataFrame([(2, 1, 1), (4, 1, 0), (5, 1, 0), (5, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    labels = labels.withColumn("text", F.lit("clash"))
    for frame in (labels, labels.where("false"), labels.where("toxic = 0")):
        rows = score_toxicity(nasty, fit_toxicity(nasty, frame, F.lit(True))).collect()
        assert len(rows) == len(ROWS)
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert score_toxicity(empty, fit_toxicity(empty, labels, F.lit(True))).count() == 0


def test_jaccard(nasty, empty):
    rows = jaccard_components(nasty).collect()
    assert len(rows) == len(ROWS)
    by = {r["doc_id"]: r for r in rows}
    assert {by[i]["n_shingles"] for i in (1, 2, 3)} == {0}
    assert by[4]["n_shingles"] == 1 and by[8]["n_shingles"] == 1
    assert all(r["component_id"] == r["doc_id"] for r in rows)
    assert jaccard_components(empty).count() == 0
    kept = nearest_kept(nasty)
    assert kept.columns == nasty.columns
    assert ids(kept) == sorted({i for i in ALL if i is not None}) + [None]


def test_kept_rows_are_chosen_by_component(spark):
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(60)) for k in "abcd")
    near = a.replace("a59", "x")
    rows = [
        (1, near), (2, a), (2, b),  # one id, two texts: one is near to 1, the other near to nothing
        (7, c), (None, c), (None, c), (None, c + " y"),  # null ids beside a named row
        (None, d), (None, d), (None, d + " z"),  # null ids alone
        (9, "p q"), (9, "r s"), (9, "r s"),
        (None, ""), (5, " "),
    ]
    kept = nearest_kept(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    got = sorted(((r["doc_id"], r["text"]) for r in kept), key=str)
    of_d = [r for r in got if r[0] is None and r[1].startswith("d0")]
    assert len(of_d) == 1
    assert [r for r in got if r not in of_d] == sorted([(1, near), (2, b), (7, c), (9, "p q"), (9, "r s"), (None, ""), (5, " ")], key=str)


def test_mixing(nasty, empty):
    rows = mix_sources(nasty, keep=("doc_id", "source", "size")).collect()
    assert len(rows) == len(ROWS) and {r["size"] for r in rows} == {"clash"}
    assert all(0 <= r["__copies"] <= 3 for r in rows)
    targets = {r["source"]: r["__target"] for r in rows}
    assert sum(targets.values()) == pytest.approx(sum(r["__size"] for r in rows))
    assert emit_mix(nasty).columns == nasty.columns
    assert emit_mix(nasty).count() == sum(r["__copies"] for r in rows)
    assert mix_sources(empty).count() == 0


def test_packing(nasty, empty):
    pieces = pack_documents(nasty, TOKENIZER).collect()
    assert sorted({p["doc_id"] for p in pieces}, key=lambda i: (i is None, i)) == sorted(set(ALL), key=lambda i: (i is None, i))
    whole = {p["doc_id"]: p["doc_tokens"] for p in pieces}
    assert whole[1] == whole[2] == whole[3] == 1
    assert sum(p["length"] for p in pieces) == sum(whole[i] for i in ALL)
    assert pack_documents(empty, TOKENIZER).count() == 0


def test_hosts(nasty, empty):
    rows = host_quality(nasty).collect()
    assert len(rows) == len(ROWS)
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_words"] == 0 and by[1]["base_failed"] and not by[1]["kept"]
    assert by[5]["n_words"] == 52_000 and by[5]["n_repeat_words"] == 52_000
    assert host_quality(empty).count() == 0


def test_merkle(nasty, empty):
    rows = edited_fingerprints(nasty).collect()
    assert len(rows) == len(ROWS)
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["fingerprint"] == by[2]["fingerprint"] == by[2]["edited_fingerprint"]
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert by[2]["near_next"] == 1.0  # 1 follows 2, and both are empty
    assert edited_fingerprints(empty).count() == 0
    assert edited_fingerprints(nasty.where("doc_id = 5")).head()["near_next"] == 1.0
    assert edited_fingerprints(nasty.where("doc_id IS NULL")).count() == 1
    assert fingerprints(nasty).count() == len(ROWS)


def test_lm(nasty, empty):
    for train in (F.lit(True), F.lit(False), F.col("doc_id") == 5):
        rows = score_texts(nasty, train, shards=3).collect()
        assert len(rows) == len(ROWS)
        assert all(r["score"] <= 0 and 0 <= r["n_known"] <= r["n_tokens"] for r in rows)
        by = {r["doc_id"]: r for r in rows}
        assert by[1]["n_tokens"] == by[2]["n_tokens"] == 1
        assert by[1]["score"] == by[2]["score"]
    assert score_texts(empty, F.lit(True)).count() == 0


def test_warc(spark):
    pages = spark.createDataFrame(
        [
            (3, "http://a/\r\nx", "p" * 200),
            (1, None, "p" * 200),
            (2, "http://b", "short"),
            (4, "http://c", "short"),
            (5, "http://d", None),
            (None, "http://e", "p" * 200),
            (6, "http://ü", "é" * 300_000),
        ],
        "page_id long, url string, html string",
    ).select("*", *(F.lit("clash").alias(c) for c in ("kind", "first", "digest", "file", "offset", "pages")))
    rows = {r["record_id"]: r for r in round_trip(pages).collect()}
    assert len(rows) == 7
    assert rows["3"]["kind"] == rows[None]["kind"] == "revisit" and rows["3"]["refers_to"] == "1"
    assert rows["3"]["payload_bytes"] == 200 and rows["3"]["digest"] == rows["1"]["digest"]
    assert {rows[i]["kind"] for i in "12456"} == {"response"}
    assert rows["5"]["payload_bytes"] == 0 and rows["6"]["payload"] == ("é" * 300_000).encode()
    assert round_trip(pages.where("false")).count() == 0


def test_roles(spark):
    turns = spark.createDataFrame(
        [(None, 0, "user", None), (1, None, None, "x"), (1, 1, "tool", ""), (1, 1, "tool", ""), (2, 5, "assistant", "y" * 100_000)],
        "conv_id long, turn long, role string, text string",
    ).select("*", F.lit("clash").alias("part"), F.lit("clash").alias("rendered"), F.lit("clash").alias("step"))
    rows = repair_roles(turns).collect()
    assert {r["conv_id"] for r in rows} == {None, 1, 2}
    assert sum(r["action"] != "insert" for r in rows) == 5
    assert repair_roles(turns.where("false")).count() == 0
