"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. A trigram's vector is the
product of its letters' vectors, the first rotated by two places, the second by
one. A text's vector is the sum of its trigrams' vectors (those that are centred
on a letter; word ends count as a letter of their own). A language's prototype
is the sum of the unit vectors of its texts. A text belongs to the language
whose prototype has the largest cosine with it.

Null, empty and letterless texts are `und` with score 0. Texts of any length
are read whole. Ties between languages go to the smaller name. Repeated rows
are rows of their own. An empty table, or one without a language, learns
nothing and every text is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.text import slices, texts

UNDETERMINED = "und"
_CODES = 0x110000
_UNIT = 1 << 20
_BLOCK = 256
#: Distinct trigrams whose vectors are held at a time.
_GRAMS = 4096
#: Bytes of text at a time: a few dozen times as much memory is at work.
_SLICE = 2 << 20
#: Distinct languages that may be learned; prototypes are sent to every task, so more is an error.
MAX_LANGUAGES = 2048


@lru_cache(1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(_CODES)), dtype=bool, count=_CODES)


@lru_cache(8192)
def _letter(code: int, dims: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.Philox(key=[seed, code])).integers(0, 2, dims, dtype=np.int8) * 2 - 1


def _trigrams(rows: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, and three letter numbers, of every trigram; and the letters that the numbers stand for (0: word end)."""
    coded = [np.frombuffer(f" {t} ".lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in rows]
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(c) for c in coded])
    codes = np.concatenate(coded)
    alpha = _is_letter()[codes]
    kept = alpha.copy()
    kept[1:] |= alpha[:-1]  # the first of a run of other characters ends the word
    kept[:-1] |= alpha[1:]  # and the last begins the next one
    codes, row, alpha = np.where(alpha, codes, 0)[kept], row[kept], alpha[kept]
    seen = np.zeros(_CODES, dtype=bool)
    seen[codes] = True
    seen[0] = True
    letters = np.flatnonzero(seen)
    number = np.zeros(_CODES, dtype=np.int32)
    number[letters] = np.arange(len(letters))
    codes = number[codes]
    middle = np.flatnonzero(alpha[1:-1]) + 1 if len(codes) > 2 else np.zeros(0, dtype=np.int64)
    return row[middle], codes[middle - 1], codes[middle], codes[middle + 1], letters


def text_vectors(rows: list[str], dims: int, seed: int) -> np.ndarray:
    """The summed trigram vectors of texts, one row each; zeros without a letter."""
    out = np.zeros((len(rows), dims), dtype=np.float32)
    row, a, b, c, letters = _trigrams(rows)
    if not len(row):
        return out
    memory = np.stack([_letter(int(code), dims, seed) for code in letters])
    first, second = np.roll(memory, 2, axis=1), np.roll(memory, 1, axis=1)
    n = len(letters)
    grams = (a.astype(np.int64) * n + b) * n + c
    cuts = np.searchsorted(row, np.arange(0, len(rows) + _BLOCK, _BLOCK))
    for block, (begin, end) in enumerate(zip(cuts[:-1], cuts[1:])):
        if begin == end:
            continue
        own = grams[begin:end]
        if n**3 <= 1 << 20:
            used = np.flatnonzero(np.bincount(own, minlength=n**3))
            place = np.zeros(n**3, dtype=np.int64)
            place[used] = np.arange(len(used))
            place = place[own]
        else:
            used, place = np.unique(own, return_inverse=True)
        start = block * _BLOCK
        size = min(_BLOCK, len(rows) - start)
        # Distinct trigrams are bound and bundled a few thousand at a time, however many a text has.
        order = np.argsort(place, kind="stable") if len(used) > _GRAMS else np.arange(len(place))
        sorted_place, sorted_row = place[order], (row[begin:end] - start)[order]
        ends = np.searchsorted(sorted_place, np.arange(_GRAMS, len(used) + _GRAMS, _GRAMS)) if len(used) > _GRAMS else [len(place)]
        at = 0
        for k, stop in enumerate(ends):
            own = used[k * _GRAMS : (k + 1) * _GRAMS]
            counts = np.bincount(sorted_row[at:stop] * len(own) + sorted_place[at:stop] - k * _GRAMS, minlength=size * len(own))
            bound = first[own // (n * n)] * second[own // n % n] * memory[own % n]
            out[start : start + size] += counts.reshape(size, len(own)).astype(np.float32) @ bound.astype(np.float32)
            at = stop
    return out


def _units(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    norms = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    return vectors / np.where(norms > 0, norms, 1)


def learn_prototypes(
    docs: DataFrame, text: str = "text", lang: str = "lang", dims: int = 1024, seed: int = 7
) -> tuple[list[str], np.ndarray]:
    """Language names in order, and one unit prototype each, from the rows with a language.

    Tasks add up unit vectors in fixed point, so that the sum doesn't depend on
    the order of tasks; the partial sums are combined by (language, dimension).
    """

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def flush() -> pa.RecordBatch:
            return pa.record_batch(
                [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))],
                names=["lang", "sums"],
            )

        for piece in slices(batches, limit=_SLICE):
            units = np.rint(_units(text_vectors(texts(piece).to_pylist(), dims, seed)) * _UNIT).astype(np.int64)
            names = np.array(piece.column("lang").to_pylist(), dtype=object)
            for name in sorted(set(names)):
                total = units[names == name].sum(axis=0)
                sums[name] = sums.get(name, 0) + total
            if len(sums) > 256:
                yield flush()
                sums.clear()
        if sums:
            yield flush()

    known = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    partial = known.where("lang IS NOT NULL").mapInArrow(bundle, "lang string, sums array<bigint>")
    summed = (
        partial.select("lang", F.posexplode("sums").alias("dim", "part"))
        .groupBy("lang", "dim")
        .agg(F.sum("part").alias("part"))
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("dim", "part"))).alias("parts"))
        .select("lang", "parts.part")
    )
    rows = summed.limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    rows = sorted((r for r in rows if any(r["part"])), key=lambda r: r["lang"])
    if not rows:
        return [], np.zeros((0, dims))
    return [r["lang"] for r in rows], _units(np.array([r["part"] for r in rows]))


def predict_language(
    docs: DataFrame,
    names: list[str],
    prototypes: np.ndarray,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    out: tuple[str, str] = ("lang_pred", "score"),
    seed: int = 7,
) -> DataFrame:
    """The columns in `keep` of every row, and `out`: the language and the best cosine, 0 at least."""
    dims = prototypes.shape[1]
    shared = docs.sparkSession.sparkContext.broadcast((names, prototypes))  # at most MAX_LANGUAGES rows
    body = text if text in keep else "__text"
    source = docs.select(*keep, *([] if text in keep else [F.col(text).alias(body)]))
    fields = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bank = shared.value
        for piece in slices(batches, body, _SLICE):
            units = _units(text_vectors(texts(piece, body).to_pylist(), dims, seed))
            blank = ~units.any(axis=1)
            if known:
                cosines = units @ bank.T
                best = cosines.argmax(axis=1)
                score = np.where(blank, 0.0, np.clip(cosines.max(axis=1), 0.0, 1.0))
                chosen = np.where(blank, UNDETERMINED, np.array(known, dtype=object)[best])
            else:
                score, chosen = np.zeros(len(units)), np.full(len(units), UNDETERMINED, dtype=object)
            columns = [piece.column(c) for c in keep]
            yield pa.record_batch(
                [*columns, pa.array(chosen.tolist(), pa.string()), pa.array(score, pa.float64())], names=[*keep, *out]
            )

    return source.mapInArrow(predict, f"{fields}, `{out[0]}` string, `{out[1]}` double")


def length_class(text: Column) -> Column:
    """Texts of like length: the whole binary logarithm of their code points, 0 for a null."""
    return F.floor(F.log2(F.coalesce(F.length(text), F.lit(0)) + 1)).cast("int")


def least_likeness(scored: DataFrame, dims: int, share: float = 0.001, part: float = 0.6, deviations: float = 5.0) -> dict[int, float]:
    """By class of length, the cosine below which a text is like no learned language.

    `scored` has `(length, score)` of texts of the learned languages. The limit is `part`
    of the quantile that only a `share` of them stay below, so texts like those learned
    from are kept, and at most `deviations` of the cosine of unrelated vectors: short
    texts of a language may be no more like it than noise is, long ones are.
    """
    noise = deviations / dims**0.5
    rows = scored.groupBy("length").agg(F.percentile_approx("score", share, 10_000).alias("low")).collect()
    return {r["length"]: min(noise, part * r["low"]) for r in rows}


def identify_language(
    docs: DataFrame, train: Column, keep: tuple[str, ...] = ("doc_id",), dims: int = 1024, seed: int = 7
) -> DataFrame:
    """Learn from the rows where `train` holds, then predict every row."""
    names, prototypes = learn_prototypes(docs.where(train), dims=dims, seed=seed)
    return predict_language(docs, names, prototypes, keep=keep, seed=seed)
