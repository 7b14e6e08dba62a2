"""Mixing sources to target weights by systematic sampling.

Sources in code point order, null last, get the weights in turn and share the
words of all documents; a target above `max_repeats` times its source's size is
cut there and the excess shared again by weight. A document is expected as often
as its source's target over its source's size. Within a source documents are
ordered by size, their expected copies summed up, one random offset is added, and a
document is emitted once for each whole number that its stretch crosses. As
neighbours are of like size, the words taken come within about one long document
of the target.

Where one document is much of a target, that isn't near. So documents of at least
`certain` of their source's target, and a thousandth of its size, are expected in
whole copies: from the largest down each is rounded, with what the ones before took
too little or too much, and the rest of the source is expected as often as what is
left of the target wants. The whole copies go through the same sums and the same
offset, which can't change them. A source misses its target by no more than about
`certain` of it, or a thousandth of its size. `certain=None` rounds none, and every
document's expected copies are its source's rate.

A null text has size 0, and so has an empty one; a source of size 0 has target 0.
Rows that repeat a doc_id or a whole row are rows of their own. Documents of
equal size are ordered by a hash. An empty table gives an empty result. Columns
that aren't asked for are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.operators.ordered import running_total
from pairloom.session import checkpointed

#: Parts of one expected copy.
_UNIT = 1 << 24
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sized: DataFrame, weights: tuple[int, ...], max_repeats: int) -> DataFrame:
    """`(source, source_size, target)` from `(source, size)` rows."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = sizes.withColumn("nameless", F.col("source").isNull()).withColumn("name", F.coalesce("source", F.lit("")))
    placed = running_total(named, ["nameless", "name"], F.lit(1), keep=("source", "source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("before") % len(weights) + 1).cast("int"))
    placed = checkpointed(
        placed.select("source", "source_size", weight.cast("double").alias("weight"), (F.col("source_size") * max_repeats).alias("most"))
    )
    total = placed.agg(F.sum("source_size")).head()[0] or 0
    level, capped = 0.0, -1
    while True:
        # Sources above their limit stay there, as the level only rises.
        above = F.col("weight") * level > F.col("most")
        held, free, count = placed.agg(
            F.sum(F.when(above, F.col("most")).otherwise(0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
            F.count(F.when(above, 1)),
        ).head()
        if count == capped or not free:
            break
        level, capped = (total - held) / free, count
    target = F.least(F.col("weight") * level, F.col("most").cast("double"))
    return placed.select("source", "source_size", target.alias("target"))


def _whole_copies(large: DataFrame, max_repeats: int) -> DataFrame:
    """`(source, taken, mass, dealt)` of `(source, source_size, target, size, tie)` rows of large documents.

    `dealt` has the units of each document, `mass` and `taken` the words of all before and after. A source
    has at most a thousand large documents, as each has a thousandth of its words; equal rows share one entry.
    """
    rate = F.col("target") / F.col("source_size")
    entries = large.groupBy("source", "source_size", "target", "size", "tie").agg(F.count("*").alias("n"))
    listed = entries.groupBy("source", "source_size", "target").agg(
        F.sort_array(F.collect_list(F.struct("size", "tie", "n")), asc=False).alias("entries")
    )

    def deal(state: Column, entry: Column) -> Column:
        n, size = entry["n"], entry["size"]
        copies = F.least(F.greatest(F.round(rate * n + state["owed"] / size), F.lit(0.0)), n * F.lit(float(max_repeats)))
        units = F.round(copies / n * _UNIT).cast("long")
        one = F.struct(size.alias("size"), entry["tie"].alias("tie"), units.alias("units"))
        return F.struct(
            (state["owed"] + (rate * n - copies) * size).alias("owed"),
            (state["taken"] + copies * size).alias("taken"),
            (state["mass"] + n * size).alias("mass"),
            F.concat(state["dealt"], F.array(one)).alias("dealt"),
        )

    start = F.struct(
        F.lit(0.0).alias("owed"),
        F.lit(0.0).alias("taken"),
        F.lit(0).cast("long").alias("mass"),
        F.array().cast("array<struct<size:bigint,tie:bigint,units:bigint>>").alias("dealt"),
    )
    done = listed.select("source", F.aggregate("entries", start, deal).alias("done"))
    return done.select("source", "done.taken", "done.mass", "done.dealt")


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    max_repeats: int = 3,
    seed: int = 42,
    keep: tuple[str, ...] = ("doc_id",),
    certain: float | None = 0.02,
    columns: tuple[str, str, str] = ("doc_id", "text", "source"),
) -> DataFrame:
    """`keep` of every row with `__size, __source_size, __target, __copies`."""
    carried = tuple(f"__keep_{i}" for i in range(len(keep)))
    key, text, source = F.col(columns[0]), F.col(columns[1]).cast("string"), F.col(columns[2]).cast("string")
    # Read and counted once; no text goes further.
    sized = checkpointed(
        docs.select(
            *(F.col(c).alias(k) for c, k in zip(keep, carried)),
            source.alias("source"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(F.lit(seed), key, text).alias("tie"),
        )
    )
    targets = checkpointed(source_targets(sized.select("source", "size"), weights, max_repeats))

    def of_source(rows: DataFrame, table: DataFrame, *on: str) -> DataFrame:
        named = table.withColumnsRenamed({c: f"__{c}" for c in ("source", *on)})
        same = F.col("source").eqNullSafe(F.col("__source"))
        for c in on:
            same = same & (F.col(c) == F.col(f"__{c}"))
        return rows.join(named, same, "left").drop("__source", *(f"__{c}" for c in on))

    least = F.greatest(F.lit(certain or 0.0) * F.col("target"), F.col("source_size") / 1000)
    is_large = F.lit(certain is not None) & (F.col("size") > 0) & (F.col("size") >= least)
    large = of_source(sized.select("source", "size", "tie"), targets).where(is_large)
    whole = checkpointed(_whole_copies(large, max_repeats))
    left = F.col("target") - F.coalesce("taken", F.lit(0.0))
    small = F.col("source_size") - F.coalesce("mass", F.lit(0))
    rate = F.when(small > 0, F.least(F.greatest(left / small, F.lit(0.0)), F.lit(float(max_repeats)))).otherwise(0.0)
    table = of_source(targets, whole.select("source", "taken", "mass")).select(
        "source", "source_size", "target", F.round(rate * _UNIT).cast("long").alias("units")
    )
    expected = of_source(sized, table)
    dealt = whole.select("source", F.inline("dealt"))
    ample = of_source(expected.where(is_large).drop("units"), dealt, "size", "tie")
    summed = running_total(
        expected.where(~is_large).unionByName(ample),
        ["size", "tie"],
        F.col("units"),
        partition_by=["source"],
        keep=(*carried, "source_size", "target"),
        unique=False,
    )
    begin = F.col("before") + F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(_UNIT))
    copies = F.floor((begin + F.col("amount")) / _UNIT) - F.floor(begin / _UNIT)
    return summed.select(
        *(F.col(k).alias(c) for c, k in zip(keep, carried)),
        F.col("size").alias("__size"),
        F.col("source_size").alias("__source_size"),
        F.col("target").alias("__target"),
        copies.cast("long").alias("__copies"),
    )


def emit_mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_repeats: int = 3, seed: int = 42) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of `docs`.

    Copies are counted for hashes of the rows; the rows themselves meet their counts in
    one join. Rows with equal id, text and source are emitted as often as all of them
    together, as copies of one of them.
    """
    plain = [f"c{i}" for i in range(len(docs.columns))]
    doc_id, text, source = (dict(zip(docs.columns, plain))[c] for c in ("doc_id", "text", "source"))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    key = ["a", "b"]
    named = docs.toDF(*plain).withColumns({"a": F.xxhash64(body), "b": F.xxhash64(F.lit(1), body, doc_id, source)})
    mixed = mix_sources(named, weights, max_repeats, seed, tuple(key), columns=(doc_id, text, source))
    taken = checkpointed(
        mixed.groupBy(*key).agg(F.sum("__copies").alias("copies"), F.count("*").alias("rows")).where("copies > 0")
    )
    held = named.join(taken, key)
    once = held.where("rows = 1").unionByName(held.where("rows > 1").dropDuplicates(key))
    return once.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*plain).toDF(*docs.columns)
