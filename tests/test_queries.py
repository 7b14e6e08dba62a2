"""Every registered query against its SQL on the given tables."""

import zlib

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

import __spark_entry__ as driver
from pairloom.catalog.oracle import ORACLE
from pairloom.catalog.spark_queries import registered

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


#: Queries that SQL can't express on whole tables; each has a test of its own.
WITHOUT_SQL = {"rouge_documents", "tokenize_subwords"}


def test_every_query_has_sql():
    assert set(registered()) == set(ORACLE) | WITHOUT_SQL
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    assert differences(spark, con, driver.queries()[name], driver.oracle_sql()[name], SF_DIR) == []


def test_entry_runs(spark):
    rows = driver.entry(spark).collect()
    assert {r["metric"] for r in rows} == {"exact_match", "f1_score", "bleu", "rouge", "meteor"}


def test_rouge_of_whole_documents(spark):
    """No SQL: a subsequence over 20,000 words is beyond it. Brute force on the short ones, bounds on all."""
    rows = registered()["rouge_documents"](spark, SF_DIR).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    checked = 0
    for r in rows:
        a, b = texts[r["doc_id"]].split(), "\n".join(texts[r["doc_id"]].split("\n")[::-1]).split()
        assert (r["n_pred"], r["n_ref"]) == (len(a), len(b)) and r["rouge_1"] == 1 >= r["rouge_2"] >= 0 < r["rouge_l"] <= 1
        if len(a) <= 60:
            line = [0] * (len(b) + 1)
            for x in a:
                above, line = line, [0]
                for j, y in enumerate(b):
                    line.append(above[j] + 1 if x == y else max(above[j + 1], line[j]))
            assert r["rouge_l"] == pytest.approx(line[-1] / len(b), abs=1e-6)
            checked += 1
    assert checked > 50


def test_subwords_equal_whole_text_encoding(spark):
    """Three vocabularies: words cut before, once each, give the tokens of the whole text."""
    from pairloom.catalog.inputs import subword_vocabularies

    rows = {(r["conv_id"], r["turn"]): r for r in registered()["tokenize_subwords"](spark, SF_DIR).collect()}
    turns = spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect()
    assert len(rows) == len(turns)
    for name, (make_encode, _) in subword_vocabularies().items():
        whole = make_encode()([r["text"] for r in turns])
        for r, tokens in zip(turns, whole):
            got = rows[r["conv_id"], r["turn"]]
            assert (got[f"n_{name}"], got[f"{name}_crc32"]) == (len(tokens), zlib.crc32(" ".join(tokens).encode()))


def test_subwords_of_hard_texts(spark):
    from pairloom.catalog.inputs import subword_vocabularies
    from pairloom.functions.tokens import vocabulary_tokenizer

    texts = [None, "", "  ", "a  b\n\n c's DON'T 12345 ...", "é́ İ ß", "<|endoftext|> x<|startoftext|>", "日本語 テスト　全角", "🙂🙂 \t\r\n x", "z" * 5000, "Ünï " * 900]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "i int, t string").repartition(2)
    for name, (make_encode, split) in subword_vocabularies().items():
        got = {r["i"]: r["k"] for r in frame.select("i", vocabulary_tokenizer(make_encode, split)(F.col("t")).alias("k")).collect()}
        whole = make_encode()([t or "" for t in texts])
        assert [got[i] for i in range(len(texts))] == whole == [got[i + len(texts)] for i in range(len(texts))], name


def test_tokens_leave_slice_by_slice():
    """A batch's token lists are never held all at once."""
    import pyarrow as pa

    from pairloom.functions.tokens import BATCH_CHARS, _token_lists

    texts = ["ab " * (BATCH_CHARS // 6), None, "", "c d", "x " * BATCH_CHARS, "e"] * 3
    told = list(_token_lists(iter([pa.array(texts, pa.string()), pa.array(["f", None])]), lambda words: [[w] for w in words], str.split))
    assert max(sum(len(w) for own in lists.to_pylist() for w in own) for lists in told) <= BATCH_CHARS
    assert len(told) > 6
    assert [own for lists in told for own in lists.to_pylist()] == [(t or "").split() for t in [*texts, "f", None]]
