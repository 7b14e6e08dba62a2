"""Connected components by minimum label and pointer jumping, every round a join and an aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.session import checkpointed, free_unused


#: Tasks over which a node that very many rows name is dealt.
_SALTS = 8


def meet(rows: DataFrame, spread_by: str, labels: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join `labels`, one row per node, to rows of which any share may name one node."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(spread_by), F.lit(_SALTS)).cast("int"))
    repeated = labels.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return salted.join(repeated, [on, "salt"], how).drop("salt")


def connected_components(edges: DataFrame) -> DataFrame:
    """`(node, root)` for each node of `edges(a, b)`; the root is the smallest node that can be reached.

    A node of any degree is reduced map-side first, and joins on it are dealt over
    several tasks. Null ends and loops are ignored.
    No edges give an empty frame.
    """
    real = edges.select("a", "b").where("a <> b")
    both = checkpointed(real.unionByName(real.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")))
    while True:
        heard = (
            meet(both, "a", labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        )
        told = checkpointed(
            labels.join(heard, "node").select("node", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        )
        # Only nodes that are someone's label, and have a smaller one themselves, move others on.
        target = told.where("node <> root").select(F.col("node").alias("root"), F.col("root").alias("far"))
        named = target.join(told.select("root").distinct(), "root", "left_semi")
        moved = meet(told, "node", named, "root", "left")
        labels = checkpointed(moved.select("node", "was", F.coalesce("far", "root").alias("root")))
        if labels.where("was <> root").isEmpty():
            del both, heard, told, target, named, moved
            free_unused(labels.sparkSession)
            return labels.select("node", "root")
        labels = labels.select("node", "root")
