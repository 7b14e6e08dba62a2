"""Metrics against hand-worked cases and plain-Python second implementations."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.functions.pair_stats import OVERLAPS, lcs_length
from pairloom.operators import metrics, pairing, report
from pairloom.operators.soft_align import embed_pairs, soft_alignment

TEXT = ("exact_match", "f1_score", "bleu", "rouge", "meteor")


def grams(t, n):
    return Counter(tuple(t[i : i + n]) for i in range(len(t) - n + 1))


def overlap(p, r, n):
    return sum((grams(p, n) & grams(r, n)).values())


def plain_lcs(a, b):
    line = [0] * (len(b) + 1)
    for x in a:
        line = [0] + [0] * len(b) if not b else _next_line(line, x, b)
    return line[-1]


def _next_line(line, x, b):
    new = [0]
    for j, y in enumerate(b):
        new.append(line[j] + 1 if x == y else max(line[j + 1], new[j]))
    return new


def plain_bleu(p, r):
    if not overlap(p, r, 1) or len(p) <= 1:
        return 0.0
    logs, zeros = 0.0, 0
    for n in range(1, 5):
        m = overlap(p, r, n)
        if m == 0:
            zeros += 1
            m = math.log(len(p)) / (2**zeros * 5)
        logs += math.log(m / max(1, len(p) - n + 1))
    return (1.0 if len(p) > len(r) else math.exp(1 - len(r) / len(p))) * math.exp(logs / 4)


def plain_meteor(p, r, stem=None, synonyms=None):
    """Stage by stage, scanning both sides from the end."""
    p, r = [w.lower() for w in p], [w.lower() for w in r]
    free_p, free_r, met = set(range(len(p))), set(range(len(r))), []
    tests = [lambda a, b: a == b]
    if stem:
        tests.append(lambda a, b: stem(a) == stem(b))
    if synonyms is not None:
        tests.append(lambda a, b: b in synonyms.get(a, ()))
    for same in tests:
        for i in sorted(free_p, reverse=True):
            j = next((j for j in sorted(free_r, reverse=True) if same(p[i], r[j])), None)
            if j is not None:
                free_p.discard(i)
                free_r.discard(j)
                met.append((i, j))
    if not met:
        return 0.0
    met.sort()
    chunks = 1 + sum((i + 1, j + 1) != nxt for (i, j), nxt in zip(met, met[1:]))
    precision, recall = len(met) / len(p), len(met) / len(r)
    return (1 - 0.5 * (chunks / len(met)) ** 3) * precision * recall / (0.9 * precision + 0.1 * recall)


def expected(p_text, r_text):
    p, r = p_text.split(), r_text.split()
    m = [overlap(p, r, n) for n in range(1, 5)]
    over = lambda a, b: a / b if b > 0 and p and r else 0.0
    return {
        ("exact_match", "score"): float(p_text.strip().lower() == r_text.strip().lower()),
        ("f1_score", "score"): 2 * m[0] / (len(p) + len(r)) if m[0] else 0.0,
        ("bleu", "score"): plain_bleu(p, r),
        ("rouge", "rouge-1"): over(m[0], len(r)),
        ("rouge", "rouge-2"): over(m[1], len(r) - 1),
        ("rouge", "rouge-l"): over(plain_lcs(p, r), len(r)),
        ("meteor", "score"): plain_meteor(p, r),
    }


def pairs_of(spark, texts):
    rows = [(i, p, r) for i, (p, r) in enumerate(texts)]
    return spark.createDataFrame(rows, "id long, prediction string, reference string")


def scores_of(frame):
    found = {}
    for row in frame.collect():
        found.setdefault(row["id"], {})[row["metric"], row["sub_metric"]] = row["score"]
    return found


def random_pairs(n=300, seed=5):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["a", "b", "c", "A", "dd", "é", "f", "g", "۱", "h"])
    line = lambda: " ".join(word() for _ in range(rnd.choice([0, 1, 2, 3, 5, 9, 40])))
    return [(line(), line()) for _ in range(n)] + [("x y z", "x y z"), ("", ""), ("one", "one"), (" ", "a")]


def test_all_scores_match_plain_python(spark):
    texts = [(p.replace("۱", "1"), r.replace("۱", "1")) for p, r in random_pairs()]
    found = scores_of(report.score_examples(pairs_of(spark, random_pairs()), TEXT))
    for i, (p, r) in enumerate(texts):
        assert found[i] == pytest.approx(expected(p, r), abs=1e-12), (p, r)


def test_scores_do_not_depend_on_partitioning_or_batch(spark):
    pairs = pairs_of(spark, random_pairs(120))
    base = scores_of(report.score_examples(pairs.repartition(1), TEXT))
    assert scores_of(report.score_examples(pairs.repartition(17), TEXT)) == base
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert scores_of(report.score_examples(pairs, TEXT)) == base
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize(
    "p, r, key, score",
    [
        ("a a a", "a b", ("f1_score", "score"), 0.4),
        ("a b", "c d", ("f1_score", "score"), 0.0),
        ("", "c d", ("f1_score", "score"), 0.0),
        ("", "c d", ("rouge", "rouge-1"), 0.0),
        ("a b", "a", ("rouge", "rouge-2"), 0.0),
        ("a b c b d a b", "b d c a b a", ("rouge", "rouge-l"), 4 / 6),
        ("same", "same", ("bleu", "score"), 0.0),
        ("Yes!", " yes ", ("exact_match", "score"), 1.0),
        ("۱۲", "12", ("exact_match", "score"), 1.0),
        ("a b c", "a b c", ("meteor", "score"), 1 - 0.5 / 27),
    ],
)
def test_micro_cases(spark, p, r, key, score):
    found = scores_of(report.score_examples(pairs_of(spark, [(p, r)]), TEXT))
    assert found[0][key] == pytest.approx(score)


def test_counts_match_the_relational_form(spark):
    """Exploded n-grams joined on (id, n, gram), the form that shuffles."""
    pairs = metrics.with_token_counts(pairs_of(spark, random_pairs(150)))
    fast = {
        r["id"]: [r[f"m{n}"] for n in range(1, 5)]
        for r in metrics.with_features(pairs.select("id", "prediction", "reference"), set(OVERLAPS))
        .select("id", "stats.*")
        .collect()
    }

    def table(column):
        gram = lambda n: F.when(
            F.size(column) >= n,
            F.transform(
                F.sequence(F.lit(1), F.size(column) - (n - 1)),
                lambda i: F.array_join(F.slice(F.col(column), i, F.lit(n)), "\x01"),
            ),
        )
        parts = [pairs.select("id", F.lit(n).alias("n"), F.explode(gram(n)).alias("g")) for n in range(1, 5)]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole.groupBy("id", "n", "g").count()

    shared = (
        table("p_tokens")
        .withColumnRenamed("count", "cp")
        .join(table("r_tokens").withColumnRenamed("count", "cr"), ["id", "n", "g"])
        .groupBy("id", "n")
        .agg(F.sum(F.least("cp", "cr")).alias("m"))
    )
    slow = {i: [0, 0, 0, 0] for i in fast}
    for r in shared.collect():
        slow[r["id"]][r["n"] - 1] = r["m"]
    assert fast == slow


def test_lcs_on_long_sequences():
    rnd = random.Random(3)
    for n, m, k in [(0, 5, 3), (5, 0, 3), (700, 900, 4), (700, 900, 400)]:
        a, b = [rnd.randrange(k) for _ in range(n)], [rnd.randrange(k) for _ in range(m)]
        assert lcs_length(a, b) == plain_lcs(a, b)


def test_large_vocabulary_renumbers_exactly(spark, monkeypatch):
    """The path taken when n-gram keys would overflow gives the same counts."""
    from pairloom.functions import pair_stats as module

    monkeypatch.setattr(module, "_KEY_LIMIT", 2**12)
    texts = random_pairs(60, seed=9)
    found = scores_of(report.score_examples(pairs_of(spark, texts), ("bleu", "rouge", "meteor")))
    for i, (p, r) in enumerate(texts):
        want = expected(p.replace("۱", "1"), r.replace("۱", "1"))
        assert found[i] == pytest.approx({k: want[k] for k in found[i]}, abs=1e-12)


def test_meteor_stems_and_synonyms(spark):
    stem = lambda w: w.rstrip("s")
    table = {"car": {"auto", "wagon"}, "big": {"large"}, "large": {"big"}}
    rnd = random.Random(11)
    vocab = ["car", "cars", "auto", "wagon", "big", "large", "larges", "the", "The", "dog", "dogs"]
    texts = [
        (" ".join(rnd.choices(vocab, k=rnd.randint(1, 9))), " ".join(rnd.choices(vocab, k=rnd.randint(1, 9))))
        for _ in range(200)
    ]
    synonyms = spark.createDataFrame([(w, s) for w, ss in table.items() for s in ss], "word string, syn string")
    pairs = pairs_of(spark, texts)
    for kwargs, plain in [
        ({"stem": stem}, {"stem": stem}),
        ({"stem": stem, "synonyms": synonyms}, {"stem": stem, "synonyms": table}),
        ({"synonyms": synonyms}, {"synonyms": table}),
    ]:
        found = scores_of(report.score_examples(pairs, ("meteor",), **kwargs))
        for i, (p, r) in enumerate(texts):
            want = plain_meteor(p.split(), r.split(), **plain)
            assert found[i]["meteor", "score"] == pytest.approx(want), (p, r, plain)


def test_properties(spark):
    texts = random_pairs(200, seed=2)
    found = scores_of(report.score_examples(pairs_of(spark, texts), TEXT))
    mirrored = scores_of(report.score_examples(pairs_of(spark, [(r, p) for p, r in texts]), ("f1_score",)))
    for i, scores in found.items():
        assert all(0 <= s <= 1 for s in scores.values())
        assert scores["rouge", "rouge-l"] <= scores["rouge", "rouge-1"]
        assert scores["f1_score", "score"] == pytest.approx(mirrored[i]["f1_score", "score"])
    same = scores_of(report.score_examples(pairs_of(spark, [(p, p) for p, _ in texts if p.split()]), TEXT))
    for scores in same.values():
        assert scores["exact_match", "score"] == scores["f1_score", "score"] == 1
        assert scores["rouge", "rouge-1"] == scores["rouge", "rouge-l"] == 1


def test_report_averages_and_lines(spark):
    pairs = pairs_of(spark, [("a b", "a b"), ("c", "d")])
    rows = {(r["metric"], r["sub_metric"]): r for r in report.format_report(report.evaluate(pairs, TEXT)).collect()}
    assert rows["exact_match", "score"]["score"] == 0.5
    assert rows["exact_match", "score"]["line"] == "Average exact_match: 0.5000"
    assert rows["rouge", "rouge-2"]["line"] == "Average rouge rouge-2: 0.5000"
    assert report.evaluate(pairs.limit(0), TEXT).count() == 0


def test_metric_registry(spark):
    with pytest.raises(ValueError, match="unknown metric"):
        metrics.metric("no_such")
    with pytest.raises(ValueError, match="unknown task"):
        metrics.metrics_for("poetry")
    assert metrics.metrics_for("summarization") == ("bert_score", "rouge", "bleu", "meteor")
    metrics.register_metric("length_gap", lambda p, r: F.abs(F.length(p) - F.length(r)).cast("double"))
    metrics.register_metric("lengths", lambda p, r: {"p": F.length(p), "r": F.length(r)})
    rows = report.evaluate(pairs_of(spark, [("abc", "a"), ("a", "abcd")]), ("length_gap", "lengths")).collect()
    assert {(r["metric"], r["sub_metric"]): r["score"] for r in rows} == {
        ("length_gap", "score"): 2.5,
        ("lengths", "p"): 2.0,
        ("lengths", "r"): 2.5,
    }


def test_null_texts(spark):
    pairs = pairs_of(spark, [(None, "a")])
    with pytest.raises(Exception, match="null prediction"):
        report.evaluate(pairs, ("f1_score",)).collect()
    assert report.evaluate(pairs, ("f1_score",), on_null="empty").head()["score"] == 0.0


def brute_soft(pred, ref):
    if not len(pred) or not len(ref):
        return 0.0, 0.0, 0.0
    unit = lambda m: np.array([v / np.linalg.norm(v) if np.linalg.norm(v) else v for v in m])
    cos = unit(pred) @ unit(ref).T
    p, r = cos.max(axis=1).mean(), cos.max(axis=0).mean()
    return p, r, 0.0 if p + r == 0 else 2 * p * r / (p + r)


def test_soft_alignment_blocks(spark):
    """A hot id cut into many blocks, short ids, missing sides and a zero vector: all equal brute force."""
    rng = np.random.default_rng(4)
    sizes = {1: (200, 131), 2: (3, 1), 3: (1, 64), 4: (0, 5), 5: (4, 0), 6: (8, 8)}
    data, rows = {}, []
    for i, (n, m) in sizes.items():
        data[i] = {
            "prediction": rng.normal(size=(n, 6)).astype(np.float32),
            "reference": rng.normal(size=(m, 6)).astype(np.float32),
        }
    data[6]["reference"] = data[6]["prediction"].copy()
    data[2]["prediction"][0] = 0
    for i, sides in data.items():
        rows += [(i, side, k, v.tolist()) for side, m in sides.items() for k, v in enumerate(m)]
    vectors = spark.createDataFrame(rows, "id long, side string, pos int, vec array<float>").repartition(5)
    for block in (8, 512):
        found = {r["id"]: (r["precision"], r["recall"], r["f1"]) for r in soft_alignment(vectors, block).collect()}
        assert set(found) == set(sizes)
        for i, sides in data.items():
            want = brute_soft(sides["prediction"].astype(float), sides["reference"].astype(float))
            assert found[i] == pytest.approx(want, abs=1e-6), (i, block)
    assert found[6] == pytest.approx((1, 1, 1))


def test_embedded_pairs_score(spark):
    """From texts to soft alignment with a user encoder: one-hot letters."""

    def make_encoder():
        return lambda texts: [np.eye(26)[[ord(c) - 97 for c in t]] for t in texts]

    pairs = pairs_of(spark, [("abc", "abd"), ("xy", "xy")])
    rows = report.score_examples(pairs, ("bert_score",), vectors=embed_pairs(pairs, make_encoder)).collect()
    found = {(r["id"], r["sub_metric"]): r["score"] for r in rows}
    assert found[0, "precision"] == pytest.approx(2 / 3)
    assert found[1, "f1"] == pytest.approx(1.0)
    with pytest.raises(ValueError, match="vectors"):
        report.evaluate(pairs, ("bert_score",))


def test_pairing(spark):
    preds = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, prediction string")
    refs = spark.createDataFrame([(1, "a"), (2, "x")], "id long, reference string")
    assert pairing.pair(preds, refs).count() == 2
    assert {r["side"]: r["n_unmatched"] for r in pairing.unmatched(preds, refs).collect()} == {
        "prediction": 1,
        "reference": 0,
    }
    by_place = pairing.pair_by_position(preds.coalesce(1), refs.coalesce(1))
    assert by_place.orderBy("id").collect() == [(0, "a", "a"), (1, "b", "x")]
    ordered = pairing.pair_by_position(preds, refs, order_by="id")
    assert sorted(ordered.collect()) == [(0, "a", "a"), (1, "b", "x")]
    found = report.evaluate(by_place, ("exact_match",), n_predictions=3).head()
    assert found["score"] == pytest.approx(1 / 3)
