"""Language-model scores against a plain Witten-Bell model over whole counts."""

import random
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.llm import lm
from pairloom.llm.text import split_words


def spelt_chances(rows, words):
    """Letter chances of the distinct words, by the model's own speller fitted on plain counts."""
    train = pa.array([t or "" for _, t, own in rows if own], pa.string())
    split = split_words(train, lower=True)
    uses = np.bincount(split.codes, minlength=len(split.distinct))
    raw, begin, size = lm._letters(split)
    number, byte, _ = lm._trigrams(raw, begin, size)
    trigrams = np.bincount(number, weights=np.repeat(uses, size + 1), minlength=lm._SYMBOLS**3).astype(float)
    letters = np.bincount(raw, weights=np.repeat(uses, size), minlength=256).astype(float)
    speller = lm.Speller(trigrams, letters, len(split.codes), len(train))
    asked = split_words(pa.array([" ".join(words)], pa.string()))
    return dict(zip(asked.distinct.to_pylist(), speller.spelt(asked))), speller.end


def brute_scores(rows, order):
    texts = [((t or "").lower().split(), own) for _, t, own in rows]
    follows = Counter()
    for words, own in texts:
        if own:
            line = ["<s>"] * (order - 1) + words + ["</s>"]
            for at in range(order - 1, len(line)):
                for n in range(order):
                    if n or line[at] != "</s>":
                        follows[tuple(line[at - n : at]), line[at]] += 1
    total, kinds = Counter(), Counter()
    for (context, _), c in follows.items():
        total[context] += c
        kinds[context] += 1
    spelt, end = spelt_chances(rows, sorted({w for words, _ in texts for w in words}))
    out = []
    for words, _ in texts:
        line, score = ["<s>"] * (order - 1) + words + ["</s>"], 0.0
        for at in range(order - 1, len(line)):
            w = line[at]
            p = 10.0**end if w == "</s>" else (follows[(), w] + kinds[()] * 10.0 ** spelt[w]) / (total[()] + kinds[()])
            for n in range(1, order):
                context = tuple(line[at - n : at])
                if total[context]:
                    p = (follows[context, w] + 8 * kinds[context] * p) / (total[context] + 8 * kinds[context])
            score += log10(p)
        out.append(score)
    return out


def written(seed):
    """Few words, one of them a third of all; repeated passages; new words in texts that aren't learnt from."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    passage = " ".join(rng.choices(words, k=12))
    rows = []
    for i in range(400):
        own = [rng.choice(words) if rng.random() < 0.6 else "the" for _ in range(rng.choice((0, 1, 5, 30)))]
        if i % 3 == 0:
            own.append(passage)
        if i % 5 == 0:
            own.insert(rng.randrange(len(own) + 1), f"New{i}")
        rows.append((i, " ".join(own) if i != 7 else None, i % 5 != 0))
    return rows


@pytest.mark.parametrize("order,parts,shards", [(2, 1, 5), (3, 17, 3), (4, 3, 1)])
def test_scores_match_brute_force(spark, monkeypatch, order, parts, shards):
    rows = written(order)
    frame = spark.createDataFrame(rows, "doc_id long, text string, own boolean").repartition(parts)
    got = {r["doc_id"]: r["score"] for r in lm.score_texts(frame, F.col("own"), shards=shards, order=order).collect()}
    expected = dict(enumerate(brute_scores(rows, order)))
    assert got.keys() == expected.keys()
    # Chances are kept in steps of 0.07 % and, of shorter contexts, of 0.9 %.
    assert all(got[i] == pytest.approx(expected[i], rel=4e-3, abs=4e-3) for i in got)
    assert sum(got.values()) == pytest.approx(sum(expected.values()), rel=1e-3)


def test_contexts_dealt_over_shards_change_nothing(spark, monkeypatch):
    """All contexts dealt over the shards, or none: the same scores."""
    frame = spark.createDataFrame(written(9), "doc_id long, text string, own boolean").repartition(4)
    found = []
    for hot in (1, 10**9):
        monkeypatch.setattr(lm, "_HOT", hot)
        found.append({r["doc_id"]: r["score"] for r in lm.score_texts(frame, F.col("own"), shards=4).collect()})
    assert all(found[0][i] == pytest.approx(found[1][i], rel=1e-9) for i in found[0])


def test_answers_are_not_dealt_twice(spark):
    """The slices come to the answers, which already lie by slice; only the slices are shuffled."""
    frame = spark.createDataFrame(written(5), "doc_id long, text string, own boolean").repartition(3)
    plan = lm.score_texts(frame, F.col("own"))._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan
    assert plan.count("Exchange hashpartitioning") == 1
