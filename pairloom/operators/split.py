"""Reproducible train/test splits."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.operators.ordered import file_positions
from pairloom.session import checkpointed

HASH_DIGITS = 32
RADIX_DIGITS = 4


def split_hash(key: str | list[str], seed: int) -> Column:
    """md5 of seed and key. Several columns are told apart by their lengths, and null from any text."""
    keys = [F.col(k).cast("string") for k in ([key] if isinstance(key, str) else key)]
    if len(keys) == 1:
        return F.md5(F.concat(F.lit(str(seed)), F.coalesce(F.concat(F.lit(":"), keys[0]), F.lit(""))))
    parts = [F.coalesce(F.concat(F.length(k).cast("string"), F.lit("="), k), F.lit("null")) for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def _cutoff_hash(hashes: DataFrame, wanted: int) -> tuple[str, int, int]:
    """The `wanted`-th smallest hash, how many rows with it are wanted, and how many there are.

    Counts prefixes instead of sorting: each pass counts at most 16**4 of them,
    inside the bucket that holds the answer.
    """
    prefix = ""
    while True:
        inside = hashes.where(F.col("h").startswith(prefix)) if prefix else hashes
        digits = len(prefix) + RADIX_DIGITS
        counts = inside.groupBy(F.substring("h", 1, digits).alias("p")).agg(
            F.count("*").alias("n"), F.min("h").alias("least"), F.max("h").alias("most")
        )
        seen = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("p"))
        bucket = counts.withColumn("seen", seen).where(F.col("seen") >= wanted).orderBy("p").head()
        wanted -= bucket["seen"] - bucket["n"]
        prefix = bucket["p"]
        if digits >= HASH_DIGITS or bucket["least"] == bucket["most"]:
            return bucket["least"], wanted, bucket["n"]


def train_test_split(
    df: DataFrame,
    key: str | list[str],
    test_size: float | int | None = None,
    seed: int = 42,
    mode: str = "threshold",
) -> DataFrame:
    """Add a `split` column, `train` or `test`, that depends only on `key` and `seed`.

    `threshold` compares the key's hash with `test_size`: one pass, size
    approximate, and rows that share a key stay together. `exact` puts the
    `ceil(n * test_size)` smallest hashes in test. Of the rows that share the last
    key to go in, as many as are wanted go, in the order of the frame's partitions.
    An integer `test_size` is a row count and needs `exact`. A share or count that
    leaves no row for training is an error.
    """
    if mode not in ("threshold", "exact"):
        raise ValueError(f"mode must be 'threshold' or 'exact', not {mode!r}")
    if test_size is None:
        return df.withColumn("split", F.lit("train"))
    is_count = isinstance(test_size, int) and not isinstance(test_size, bool)
    if not is_count and not 0 < test_size < 1:
        raise ValueError("test_size must be a fraction between 0 and 1 or a row count")
    hashed = split_hash(key, seed)
    if mode == "threshold":
        if is_count:
            raise ValueError("a row count needs mode='exact'")
        is_test = hashed < F.lit(f"{int(test_size * 16**13):013x}")
    else:
        # 16 bytes a row, written once for all passes.
        hashes = checkpointed(df.select(hashed.alias("h")))
        total = hashes.count()
        if total == 0:
            return df.withColumn("split", F.lit("train"))
        wanted = test_size if is_count else ceil(total * test_size)
        if not 0 < wanted < total:
            raise ValueError(f"test_size {test_size} leaves no row of {total} on one side")
        cutoff, left, ties = _cutoff_hash(hashes, wanted)
        if left < ties:
            label = lambda test: F.when(test, "test").otherwise("train")
            last = file_positions(df.where(hashed == F.lit(cutoff)))
            others = df.where(hashed != F.lit(cutoff)).withColumn("split", label(hashed < F.lit(cutoff)))
            return others.unionByName(last.withColumn("split", label(F.col("pos") < left)).drop("pos"))
        is_test = hashed <= F.lit(cutoff)
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))
