"""Greedy soft alignment of token vectors (the BERTScore form, Zhang et al. 2020)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from pairloom.operators.pairing import normalize_pairs
from pairloom.session import checkpointed

BLOCK = 512
#: Characters that an encoder gets at once; a longer text is given to it alone.
BATCH_CHARS = 1 << 18
PARTS = ("precision", "recall", "f1")

#: From texts to one (tokens x dimensions) matrix each.
Encoder = Callable[[list[str]], Sequence[np.ndarray]]


def _unit_rows(table: pa.Table) -> np.ndarray:
    """The vectors as a matrix of unit rows; a zero vector stays zero."""
    vectors = table["vec"].combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = flat.reshape(len(vectors), -1)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _best_in_block(table: pa.Table) -> pa.Table:
    """Each vector's best cosine against the other side of one block; 0 when that side is empty."""
    is_pred = table["side"].to_numpy() == "prediction"
    pred, ref = table.filter(pa.array(is_pred)), table.filter(pa.array(~is_pred))
    if pred.num_rows and ref.num_rows:
        cosine = _unit_rows(pred) @ _unit_rows(ref).T
        best = [cosine.max(axis=1), cosine.max(axis=0)]
        seen = True
    else:
        best = [np.zeros(pred.num_rows), np.zeros(ref.num_rows)]
        seen = False
    both = pa.concat_tables([pred, ref]).select(["id", "side", "pos"])
    score = pa.array(np.concatenate(best)) if seen else pa.nulls(both.num_rows, pa.float64())
    return both.append_column("best", score)


def soft_alignment(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """`(id, precision, recall, f1)` from `(id, side, pos, vec)`, side `prediction` or `reference`.

    The comparison is cut into blocks of at most `block` x `block` vectors, each
    a matrix product in its own task group that returns one maximum per vector.
    A sequence within one block is shuffled once; a longer one is repeated per
    block of the other side and spread over as many groups. `pos` counts from 0.
    """
    has = lambda side: F.max(F.when(F.col("side") == side, F.col("pos")))
    blocks_of = lambda side: F.floor(F.coalesce(has(side), F.lit(0)) / block).cast("int")
    long_ids = checkpointed(
        vectors.groupBy("id")
        .agg(blocks_of("prediction").alias("__p_last"), blocks_of("reference").alias("__r_last"))
        .where((F.col("__p_last") > 0) | (F.col("__r_last") > 0))
    )
    own = F.floor(F.col("pos") / block).cast("int")
    other_last = F.when(F.col("side") == "prediction", F.col("__r_last")).otherwise(F.col("__p_last"))
    placed = (
        vectors.select("id", "side", "pos", "vec").join(long_ids, "id", "left")
        .withColumn("__other", F.explode(F.sequence(F.lit(0), F.coalesce(other_last, F.lit(0)))))
        .select(
            "id",
            "side",
            "pos",
            "vec",
            F.when(F.col("side") == "prediction", own).otherwise(F.col("__other")).alias("p_block"),
            F.when(F.col("side") == "prediction", F.col("__other")).otherwise(own).alias("r_block"),
        )
    )
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    best = placed.groupBy("id", "p_block", "r_block").applyInArrow(
        _best_in_block, f"id {kinds['id']}, side string, pos {kinds['pos']}, best double"
    )
    side_mean = lambda side: F.coalesce(
        F.avg(F.when(F.col("side") == side, F.coalesce("best", F.lit(0.0)))), F.lit(0.0)
    )
    return (
        best.groupBy("id", "side", "pos")
        .agg(F.max("best").alias("best"))
        .groupBy("id")
        .agg(side_mean("prediction").alias("precision"), side_mean("reference").alias("recall"))
        .withColumn("f1", harmonic(F.col("precision"), F.col("recall")))
    )


def _unit(matrix: np.ndarray) -> np.ndarray:
    matrix = np.asarray(matrix, dtype=np.float64)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True) if matrix.size else np.ones((len(matrix), 1))
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def greedy_scores(prediction: np.ndarray, reference: np.ndarray, tile: int = BLOCK) -> tuple[float, float, float]:
    """Precision, recall and F1 of two matrices of token vectors, holding at most `tile` x `tile` cosines at a time."""
    if not len(prediction) or not len(reference):
        return 0.0, 0.0, 0.0
    pred, ref = _unit(prediction), _unit(reference)
    best = [np.full(len(pred), -np.inf), np.full(len(ref), -np.inf)]
    for i in range(0, len(pred), tile):
        for j in range(0, len(ref), tile):
            cosine = pred[i : i + tile] @ ref[j : j + tile].T
            for side, at, axis in ((0, i, 1), (1, j, 0)):
                own = best[side][at : at + tile]
                np.maximum(own, cosine.max(axis=axis), out=own)
    precision, recall = (float(b.mean()) for b in best)
    total = precision + recall
    return precision, recall, 2 * precision * recall / total if total else 0.0


def _chunks(sides: tuple[list[str], list[str]], batch_size: int, batch_chars: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `batch_size` texts and `batch_chars` characters, or one pair."""
    first, held = 0, 0
    for at, (p, r) in enumerate(zip(*sides)):
        own = len(p) + len(r)
        if at > first and (2 * (at + 1 - first) > batch_size or held + own > batch_chars):
            yield first, at
            first, held = at, 0
        held += own
    if first < len(sides[0]):
        yield first, len(sides[0])


def soft_scores(
    make_encoder: Callable[[], Encoder], batch_size: int = 32, tile: int = BLOCK, batch_chars: int = BATCH_CHARS
) -> Callable[[Column, Column], Column]:
    """A column function of two texts to `struct<precision, recall, f1>`, encoded and compared in one map pass.

    `make_encoder` runs once per task. Each distinct text of a batch is encoded
    once, and its vectors are given up as soon as its pairs are scored: none
    leaves the worker. A null text is encoded as the empty one.
    """
    shape = StructType([StructField(part, DoubleType()) for part in PARTS])

    @F.arrow_udf(shape)
    def scores(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        encode = make_encoder()
        for batch in batches:
            sides = tuple([t or "" for t in side.to_pylist()] for side in batch)
            rows: list[tuple[float, float, float]] = []
            for first, end in _chunks(sides, batch_size, batch_chars):
                pairs = list(zip(sides[0][first:end], sides[1][first:end]))
                texts = list(dict.fromkeys(t for both in pairs for t in both))
                vectors = {}
                for at in range(0, len(texts), batch_size):
                    given = texts[at : at + batch_size]
                    matrices = encode(given)
                    if len(matrices) != len(given):
                        raise ValueError(f"the encoder returned {len(matrices)} matrices for {len(given)} texts")
                    vectors.update(zip(given, matrices))
                rows += [greedy_scores(vectors[p], vectors[r], tile) for p, r in pairs]
            columns = zip(*rows) if rows else [()] * len(PARTS)
            yield pa.StructArray.from_arrays([pa.array(c, pa.float64()) for c in columns], names=list(PARTS))

    return lambda prediction, reference: scores(prediction, reference)


def bert_score_pairs(
    pairs: DataFrame, make_encoder: Callable[[], Encoder], batch_size: int = 32, tile: int = BLOCK, on_null: str = "error"
) -> DataFrame:
    """`(id, precision, recall, f1)` of the normalised texts of `(id, prediction, reference)`; nothing is shuffled."""
    score = soft_scores(make_encoder, batch_size, tile)
    texts = normalize_pairs(pairs, on_null)
    return texts.select("id", score(F.col("prediction"), F.col("reference")).alias("soft")).select("id", "soft.*")


def harmonic(precision, recall):
    total = precision + recall
    return F.when(total == 0, F.lit(0.0)).otherwise(
        2.0 * precision * recall / F.when(total == 0, F.lit(1.0)).otherwise(total)
    )


def embed_pairs(
    pairs: DataFrame,
    make_encoder: Callable[[], Encoder],
    batch_size: int = 32,
    on_null: str = "error",
) -> DataFrame:
    """Token vectors of both normalised texts of each pair, from an encoder the user supplies.

    `make_encoder` runs once per task and returns a function from a list of texts
    to one (tokens x dimensions) matrix per text. The vectors are checkpointed, as
    they are read twice and encoding is the dear part.
    """
    texts = normalize_pairs(pairs, on_null).select("id", "prediction", "reference").unpivot(
        ["id"], ["prediction", "reference"], "side", "text"
    )
    id_type = pairs.schema["id"].dataType.simpleString()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = make_encoder()
        for rows in batches:
            for at in range(0, len(rows), batch_size):
                chunk = rows.iloc[at : at + batch_size]
                matrices = encoder(chunk["text"].tolist())
                sizes = [len(m) for m in matrices]
                yield pd.DataFrame(
                    {
                        "id": np.repeat(chunk["id"].to_numpy(), sizes),
                        "side": np.repeat(chunk["side"].to_numpy(), sizes),
                        "pos": np.concatenate([np.arange(n, dtype=np.int32) for n in sizes]),
                        "vec": pd.Series([row.astype(np.float32) for m in matrices for row in np.asarray(m)], dtype=object),
                    }
                )

    return checkpointed(texts.mapInPandas(encode, f"id {id_type}, side string, pos int, vec array<float>"))
