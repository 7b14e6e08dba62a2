"""Toxicity scores by weak supervision.

Voters are words (a lexicon) and word beginnings (patterns, also dense ones of
several words) mined from labelled rows, plus one that votes clean where no other
fires. A generative model of the votes is fitted by expectation and maximisation:
each voter, the label among them, has a rate of firing on toxic and on clean
texts, and voters that go together within a class share their evidence according
to their correlation. Its posterior labels train a linear classifier over the
votes, which is calibrated on the labels and scores every text.

Everything is learned from at most `max_toxic + max_clean` labelled rows, chosen
by a hash of their id; classes are weighed back to their true shares. Every text
is scored whole. Null and empty texts have no words and get the score of a text
without votes. Without labelled rows of both classes every score is 0. A doc_id
labelled several times counts as toxic if one label says so; repeated documents
are rows of their own, but equal labelled texts count once in the mining.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.text import slices, texts

_WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6, 7, 8)
#: Words of a text for each that a dense pattern needs.
SPARSE = 200
MAX_TOXIC, MAX_CLEAN = 10_000, 20_000
#: Voters at most, and candidates among which they are chosen.
MAX_VOTERS, CANDIDATES = 256, 4096


def beginnings(words: set[str], n: int) -> Counter[str]:
    """How many distinct words go on from each beginning of `n` letters."""
    return Counter(w[:n] for w in words if len(w) > n)


def marks(held: int, length: int) -> tuple[str, ...]:
    """Patterns that a beginning of `held` distinct words fires in a text of `length` words."""
    return ("*", "**") if held > 1 and held * SPARSE >= length else ("*",)


def features_of(text: str) -> set[str]:
    """Distinct words of a text in lower case and its word beginnings.

    A beginning is marked by `*`, and also by `**` where several words have it, at least one in `SPARSE`:
    in a long text a few may be there by chance.
    """
    said = _WORD.findall(text.lower())
    words = set(said)
    found = set(words)
    for n in PREFIXES:
        for begin, held in beginnings(words, n).items():
            found.update(begin + mark for mark in marks(held, len(said)))
    return found


@dataclass(frozen=True)
class ToxicityModel:
    """Voters in order and the classifier's weights: one each, one for no vote, and the constant."""

    voters: tuple[str, ...]
    weights: np.ndarray

    def votes(self, rows: list[str]) -> list[list[int]]:
        """For each text the voters that fire."""
        number = {v: i for i, v in enumerate(self.voters)}
        lengths = [n for n in PREFIXES if any(v[-1] == "*" and len(v.rstrip("*")) == n for v in self.voters)]
        out = []
        for text in rows:
            said = _WORD.findall(text.lower())
            words = set(said)
            fired = {number[w] for w in words & number.keys()}
            for n in lengths:
                for begin, held in beginnings(words, n).items():
                    fired.update(number[v] for mark in marks(held, len(said)) if (v := begin + mark) in number)
            out.append(sorted(fired))
        return out

    def scores(self, rows: list[str]) -> np.ndarray:
        w = self.weights
        raw = np.array([w[-1] + (w[v].sum() if v else w[-2]) for v in self.votes(rows)])
        return 1.0 / (1.0 + np.exp(-np.clip(raw, -30, 30)))


def labelled_sample(docs: DataFrame, labels: DataFrame, train: Column, max_toxic: int, max_clean: int) -> DataFrame:
    """`(text, toxic, weight)` of the bounded training sample, one row per distinct text."""
    marked = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & train)
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    # Two counts, whatever the size of the table.
    sizes = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    shares = {c: min(1.0, most / max(1, sizes.get(c, 0))) for c, most in ((1, max_toxic), (0, max_clean))}
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    chosen = marked.where(drawn < F.when(F.col("toxic") == 1, shares[1] * (1 << 20)).otherwise(shares[0] * (1 << 20)))
    weight = F.when(F.col("toxic") == 1, 1 / shares[1]).otherwise(1 / shares[0])
    # About max_toxic + max_clean rows of 12 bytes, so the broadcast is bounded by the parameters.
    return (
        docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .select("text", "toxic", weight.alias("weight"))
        .dropDuplicates(["text", "toxic"])
    )


def _candidates(sample: DataFrame) -> list[tuple[str, int, int]]:
    """Features that go with toxic texts beyond chance, the most telling first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            seen = (Counter(), Counter())
            for text, toxic in zip(texts(piece).to_pylist(), piece.column("toxic").to_pylist()):
                seen[toxic].update(features_of(text))
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.record_batch(
                [pa.array(names, pa.string()), *(pa.array([s[n] for n in names], pa.int64()) for s in seen)],
                names=["feature", "clean", "toxic"],
            )

    counted = (
        sample.select("text", "toxic")
        .mapInArrow(count, "feature string, clean bigint, toxic bigint")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return []
    k, n, p = F.col("toxic"), F.col("toxic") + F.col("clean"), n1 / (n1 + n0)
    part = lambda x, expected: F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)
    gain = 2 * (part(k, n * p) + part(n - k, n * (1 - p)))
    rated = counted.select("feature", "toxic", "clean", gain.alias("gain")).where((k / n > max(0.5, 2 * p)) & (k >= 3))
    found = rated.orderBy(F.desc("gain"), "feature").limit(CANDIDATES).collect()
    distinct = counted.agg(F.approx_count_distinct("feature")).head()[0]
    least = 2 * np.log(max(10, distinct))  # one false voter is expected among all features
    return [(r["feature"], r["toxic"], r["clean"]) for r in found if r["gain"] >= least]


def _choose(fired: list[list[int]], toxic: np.ndarray, voters: int, cover: int = 3, least: int = 3) -> list[int]:
    """Greedily the candidates that reach the most toxic texts, each text counting until reached `cover` times."""
    holders: list[list[int]] = [[] for _ in range(voters)]
    for row, votes in enumerate(fired):
        for v in votes:
            holders[v].append(row)
    owned = [np.array(h, dtype=np.int64) for h in holders]
    clean = np.array([int((toxic[h] == 0).sum()) for h in owned])
    left = np.where(toxic == 1, cover, 0)
    gains = np.array([int((left[h] > 0).sum()) for h in owned])
    chosen: list[int] = []
    while len(chosen) < MAX_VOTERS and voters:
        best = int(np.argmax(gains - 3.0 * clean))
        now = int((left[owned[best]] > 0).sum())
        if now < gains[best]:  # gains only fall, so a stale one is brought up to date when it leads
            gains[best] = now
            continue
        if now < least or now <= 3 * clean[best]:
            break
        chosen.append(best)
        left[owned[best]] = np.maximum(0, left[owned[best]] - 1)
        gains[best] = -1
    return sorted(chosen)


def label_model(votes: np.ndarray, toxic: np.ndarray, weight: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Posterior probability of toxic per row, from the votes and the row's own label, which may be wrong.

    The label is one more voter: how often it is given to toxic and to clean texts is
    estimated along with the rates of the others, from a start of one error in
    fifty, with as much prior weight as a tenth of the rows. Voters' evidence is
    divided by one plus the sum of their positive correlations with other voters of
    the same class, so copies of one voter count about once.
    """
    start = 0.02
    posterior = np.where(toxic == 1, 1 - start, start)
    for _ in range(rounds):
        rates, marked, spread = [], [], np.zeros((votes.shape[1], votes.shape[1]))
        for q, usual in ((posterior * weight, 1 - start), ((1 - posterior) * weight, start)):
            total = q.sum()
            rate = (q @ votes + 0.05) / (total + 1.0)
            marked.append(np.clip((q @ toxic + usual * total / 10) / (total * 1.1 + 1e-9), 1e-4, 1 - 1e-4))
            centred = votes - rate
            cov = (centred * q[:, None]).T @ centred / max(total, 1e-9)
            scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            spread = np.maximum(spread, np.clip(cov / scale[:, None] / scale, 0, 1) * (rate > 1e-4)[:, None])
            rates.append(np.clip(rate, 1e-6, 1 - 1e-6))
        np.fill_diagonal(spread, 0)
        share = 1.0 / (1.0 + spread.sum(axis=1))
        on, off = np.log(rates[0] / rates[1]), np.log((1 - rates[0]) / (1 - rates[1]))
        prior = np.average(posterior, weights=weight)
        own = np.where(toxic == 1, np.log(marked[0] / marked[1]), np.log((1 - marked[0]) / (1 - marked[1])))
        raw = np.log(prior / (1 - prior)) + own + votes @ (share * (on - off)) + (share * off).sum()
        posterior = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
    return posterior


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 0.05) -> np.ndarray:
    """Weights of a penalised logistic regression on soft labels, by Newton steps; the last is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.full(x.shape[1], penalty)
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = weight * np.maximum(p * (1 - p), 1e-4)
        step = np.linalg.solve((x * curve[:, None]).T @ x + np.diag(ridge), x.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def calibrated(weights: np.ndarray, votes: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The classifier with its scores stretched and shifted to the shares of toxic labels (Platt 1999).

    Voters are trusted together where one alone is not: the posterior of few votes
    rests on the model's independence, the labels say how far that holds.
    """
    raw = votes @ weights[:-1] + weights[-1]
    fired = votes[:, -1] == 0
    if len(np.unique(toxic[fired])) < 2:
        return weights
    stretch, shift = _logistic(raw[fired, None], toxic[fired].astype(float), weight[fired], penalty=1e-3)
    if stretch <= 0:
        return weights
    moved = np.append(weights[:-1] * stretch, weights[-1] * stretch + shift)
    # A text without votes keeps its score.
    moved[-2] = weights[-2] + weights[-1] - moved[-1]
    return moved


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    max_toxic: int = MAX_TOXIC,
    max_clean: int = MAX_CLEAN,
) -> ToxicityModel:
    """Learn from the labelled rows where `train`, a condition on doc_id, holds."""
    sample = labelled_sample(docs, labels, train, max_toxic, max_clean)
    candidates = [c[0] for c in _candidates(sample)]
    if not candidates:
        any_row = sample.agg(F.avg(F.col("toxic") * F.col("weight")), F.avg("weight")).head()
        share = (any_row[0] or 0.0) / any_row[1] if any_row[1] else 0.0
        share = min(max(share, 1e-6), 1 - 1e-6)
        return ToxicityModel((), np.array([0.0, np.log(share / (1 - share)) if share > 1e-6 else -30.0]))
    wide = ToxicityModel(tuple(candidates), np.zeros(len(candidates) + 2))

    def fire(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            fired = wide.votes(texts(piece).to_pylist())
            yield pa.record_batch(
                [piece.column("toxic"), piece.column("weight"), pa.array(fired, pa.list_(pa.int32()))],
                names=["toxic", "weight", "fired"],
            )

    # The sample is bounded by max_toxic + max_clean; only numbers of voters come back, not texts.
    rows = sample.mapInArrow(fire, "toxic int, weight double, fired array<int>").collect()
    rows.sort(key=lambda r: (r["toxic"], r["fired"]))
    toxic = np.array([r["toxic"] for r in rows])
    weight = np.array([r["weight"] for r in rows])
    chosen = _choose([r["fired"] for r in rows], toxic, len(candidates))
    place = {v: i for i, v in enumerate(chosen)}
    votes = np.zeros((len(rows), len(chosen) + 1))
    for i, r in enumerate(rows):
        own = [place[v] for v in r["fired"] if v in place]
        votes[i, own or -1] = 1.0
    posterior = label_model(votes, toxic, weight)
    weights = _logistic(votes, posterior, weight)
    return ToxicityModel(tuple(candidates[v] for v in chosen), calibrated(weights, votes, toxic, weight))


def score_toxicity(
    docs: DataFrame,
    model: ToxicityModel,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    out: tuple[str, str] = ("score", "predicted"),
) -> DataFrame:
    """The columns in `keep` of every row, and `out`: the score, and 1 from a score of 0.5."""
    body = text if text in keep else "__text"
    source = docs.select(*keep, *([] if text in keep else [F.col(text).alias(body)]))
    fields = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, body):
            scores = model.scores(texts(piece, body).to_pylist())
            columns = [*(piece.column(c) for c in keep), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.record_batch(columns, names=[*keep, *out])

    return source.mapInArrow(score, f"{fields}, `{out[0]}` double, `{out[1]}` int")
