"""Soft alignment from texts, token-bounded batches, the thesaurus at the batch dictionary, texts beside scores."""

import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.functions import pair_stats
from pairloom.functions.pair_stats import Thesaurus, pair_counts, token_slices
from pairloom.operators import metrics, report
from pairloom.operators.soft_align import bert_score_pairs, embed_pairs, greedy_scores, soft_scores
from pairloom.plans.jobs import evaluate_files

LETTERS = "abcdefgh"


def counting():
    """A factory of encoders: letter counts as vectors; refuses more texts at once than it was promised."""

    def make():
        def encode(texts):
            assert len(texts) <= 32 and len(set(texts)) == len(texts)
            return [np.array([[t.count(c) for c in LETTERS] for t in text.split()], dtype=np.float32).reshape(-1, 8) for text in texts]

        return encode

    return make


make_counting = counting()


def some_pairs(spark, n=60, seed=3):
    rng = random.Random(seed)
    say = lambda: " ".join("".join(rng.choices(LETTERS + "z", k=rng.randint(1, 4))) for _ in range(rng.choice((0, 1, 5, 40))))
    rows = [(i, say(), say()) for i in range(n)]
    rows += [(1000, "ab cd", "ab cd"), (1001, "", ""), (1002, "z", "a"), (1003, "a " * 3000, "b a")]
    return rows, spark.createDataFrame(rows, "id long, prediction string, reference string").repartition(3)


def test_scores_from_texts_equal_those_from_vectors(spark):
    rows, pairs = some_pairs(spark)
    fused = {r["id"]: tuple(r)[1:] for r in bert_score_pairs(pairs, make_counting, batch_size=4, tile=7).collect()}
    stored = report.score_examples(pairs, ("bert_score",), vectors=embed_pairs(pairs, make_counting, batch_size=1))
    by_part = {(r["id"], r["sub_metric"]): r["score"] for r in stored.collect()}
    assert set(fused) == {r[0] for r in rows}
    for i, own in fused.items():
        # An id whose texts have no token has no vectors at all.
        assert own == pytest.approx([by_part.get((i, p)) or 0.0 for p in ("precision", "recall", "f1")], abs=1e-6)
    assert fused[1000] == pytest.approx((1, 1, 1)) and fused[1001] == fused[1002] == (0, 0, 0)


def test_tiles_change_nothing():
    rng = np.random.default_rng(1)
    p, r = rng.normal(size=(37, 5)), rng.normal(size=(11, 5))
    assert greedy_scores(p, r, 4) == pytest.approx(greedy_scores(p, r, 512))
    assert greedy_scores(-p[:1], p[:1]) == pytest.approx((-1, -1, -1))


def test_soft_alignment_from_texts_is_one_map_pass(spark):
    _, pairs = some_pairs(spark)
    source = spark.createDataFrame(pairs.collect(), pairs.schema)
    for frame in (
        bert_score_pairs(source, make_counting, batch_size=4),
        report.score_texts(source, ("bert_score", "f1_score"), encoder=make_counting),
    ):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" in plan
        assert not any(word in plan for word in ("Exchange", "Join", "Generate", "MapIn"))


def test_null_texts_and_wrong_encoders(spark):
    frame = spark.createDataFrame([(1, None, "ab"), (2, "ab", "ab")], "id long, prediction string, reference string")
    score = soft_scores(make_counting)
    assert frame.select(score("prediction", "reference").alias("s")).select("s.f1").collect()[0][0] == 0.0
    with pytest.raises(Exception, match="matrices for"):
        frame.select(soft_scores(lambda: lambda texts: [])("prediction", "reference")).collect()
    with pytest.raises(ValueError, match="vectors"):
        report.evaluate(frame, ("bert_score",))
    with pytest.raises(ValueError, match="vectors"):
        report.evaluate(frame, ("bert_score",), encoder=make_counting, vectors=frame)


def test_evaluation_job_scores_texts_and_keeps_them(spark, tmp_path):
    for name, rows in (("refs", [(1, "ab cd!"), (2, "ef")]), ("preds", [(1, "ab cd"), (2, "ab")])):
        spark.createDataFrame(rows, "id long, text string").write.option("header", True).csv(str(tmp_path / name))
    out = str(tmp_path / "out")
    report_rows = evaluate_files(
        spark, str(tmp_path / "refs"), str(tmp_path / "preds"), "text", "text", ("exact_match", "bert_score"), out, on="id",
        encoder=make_counting,
    ).collect()
    assert {(r["metric"], r["sub_metric"]): r["score"] for r in report_rows} == pytest.approx(
        {("exact_match", "score"): 0.5, ("bert_score", "precision"): 0.5, ("bert_score", "recall"): 0.5, ("bert_score", "f1"): 0.5}
    )
    texts = {r["id"]: r for r in spark.read.parquet(f"{out}/texts").collect()}
    assert (texts["1"]["prediction"], texts["1"]["reference"]) == ("ab cd", "ab cd")
    assert [s["score"] for s in texts["2"]["scores"]] == [0, 0, 0, 0]
    assert spark.read.parquet(f"{out}/examples").count() == 8


def test_a_large_thesaurus_gives_the_same_scores(spark, monkeypatch):
    rng = random.Random(8)
    vocab = ["Car", "car", "cars", "auto", "wagon", "big", "Large", "large", "dog"]
    rows = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 9))), " ".join(rng.choices(vocab, k=rng.randint(1, 9)))) for i in range(150)]
    pairs = spark.createDataFrame(rows, "id long, prediction string, reference string")
    words = [("car", "auto"), ("Car", "Wagon"), ("big", "large"), ("big", "large"), ("dog", None), (None, "dog"), ("none", "such")]
    synonyms = spark.createDataFrame(words, "word string, syn string")
    scored = lambda: {r["id"]: r["score"] for r in report.score_examples(pairs, ("meteor",), synonyms=synonyms).collect()}
    assert metrics.small_thesaurus(synonyms) is not None
    small = scored()
    monkeypatch.setattr(metrics, "THESAURUS_ROWS", 2)
    assert metrics.small_thesaurus(synonyms) is None
    assert scored() == small
    none = {r["id"]: r["score"] for r in report.score_examples(pairs, ("meteor",)).collect()}
    assert any(small[i] > none[i] for i in small)


def test_an_empty_thesaurus(spark):
    empty = Thesaurus.of(pa.table({"word": pa.array([], pa.string()), "syn": pa.array([], pa.string())}))
    assert empty.codes(["a", "b"]) == {}


def test_slices_change_no_count():
    rng = random.Random(4)
    side = lambda: pa.array([[rng.choice("abcdef") for _ in range(rng.choice((0, 1, 4, 30)))] for _ in range(80)], pa.list_(pa.string()))
    p, r = side(), side()
    whole = pair_counts(p, r, list(pair_stats.FIELDS), limit=10**9)
    assert pair_counts(p, r, list(pair_stats.FIELDS), limit=13).equals(whole)
    cuts = list(token_slices(p, r, 13))
    assert [a for a, _ in cuts][1:] == [b for _, b in cuts][:-1] and cuts[-1][1] == 80
    sizes = np.array([len(a) + len(b) for a, b in zip(p.to_pylist(), r.to_pylist())])
    assert all(b == a + 1 or sizes[a:b].sum() <= 13 for a, b in cuts)


def test_memory_of_a_batch_of_long_rows():
    """10,000 rows of 600 tokens a side: what the counts take beyond the batch itself stays small."""
    code = """
import resource, numpy as np, pyarrow as pa
from pairloom.functions.pair_stats import pair_counts
rng = np.random.default_rng(0)
words = pa.array([f"w{i}" for i in range(5000)])
side = lambda: pa.ListArray.from_arrays(pa.array(np.arange(10_001) * 600, pa.int32()), words.take(pa.array(rng.integers(0, 5000, 6_000_000))))
p, r = side(), side()
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
pair_counts(p, r, ["m1", "m2", "m3", "m4", "aligned"])
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout.split()[-1]) < 300
