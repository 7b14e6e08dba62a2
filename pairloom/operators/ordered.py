"""Running totals and row positions over a global order, without a single-task window."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from pairloom.session import checkpointed


def partition_count(df: DataFrame, parts: int | None) -> int:
    return parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def unlike(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before; nulls are alike."""
    a, b = column[1:], column[:-1]
    differs = pc.fill_null(pc.not_equal(a, b), pc.xor(pc.is_null(a), pc.is_null(b)))
    # A null operand leaves null also where both are null: alike.
    return pc.fill_null(differs, False).to_numpy(zero_copy_only=False)


def _inside(by: list[str], order_by: list[str], unique: bool):
    """An in-partition pass over sorted rows: adds `before`, the group's sum so far in this partition."""

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [*by, *order_by]
            rows = batch.select(keys)
            if last is not None:
                rows = pa.Table.from_batches([last, rows]).combine_chunks().to_batches()[0]
            changed = {c: unlike(rows.column(c)) for c in keys}
            new = np.logical_or.reduce([np.zeros(rows.num_rows - 1, dtype=bool), *(changed[c] for c in by)])
            if unique and rows.num_rows > 1:
                alike = ~np.logical_or.reduce([new, *(changed[c] for c in order_by)])
                if alike.any():
                    raise ValueError("the order is not unique")
            if last is None:
                new = np.append(True, new)
            amount = batch.column("amount").to_numpy(zero_copy_only=False).astype(np.int64)
            before = np.cumsum(amount) - amount + carried
            starts = np.flatnonzero(new)
            if len(starts):
                group = np.cumsum(new)
                base = np.append(0, before[starts])
                before = before - base[group]
            carried = int(before[-1] + amount[-1])
            last = batch.select(keys).slice(batch.num_rows - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before)], names=[*batch.schema.names, "before"])

    return pass_


def running_total(
    df: DataFrame,
    order_by: list[str],
    value: Column,
    partition_by: list[str] | None = None,
    parts: int | None = None,
    keep: tuple[str, ...] = (),
    unique: bool = True,
) -> DataFrame:
    """`partition_by + order_by + keep + (amount, before)`; `before` sums `value` over earlier rows.

    Range partitions over the whole order split even a group that owns most of
    the rows. Rows are shuffled once, with the columns in `keep`, and summed up
    in place by a pass over each sorted partition. Each range partition can
    continue at most one group, so the carried-in bases number at most one per
    partition and are broadcast.

    A null in an order column is an error, and so is a repeated order within a
    group unless `unique` is off; then equal rows follow each other in any order.
    """
    by = list(partition_by or [])
    missing = F.lit(False)
    for c in order_by:
        missing = missing | F.col(c).isNull()
    amount = F.when(missing, F.raise_error(F.lit("null in an order column"))).otherwise(value).cast("long")
    # Range bounds come from a sample: checkpoint, so both passes see the same ones.
    ranged = checkpointed(
        df.select(*by, *order_by, *keep, F.coalesce(amount, F.lit(0)).alias("amount"))
        .repartitionByRange(partition_count(df, parts), *by, *order_by)
        .sortWithinPartitions(*by, *order_by)
        .withColumn("__part", F.spark_partition_id())
    )
    carried = Window.partitionBy(*(by or [F.lit(0)])).orderBy("__part")
    bases = (
        ranged.groupBy(*by, "__part")
        .agg(F.sum("amount").alias("__total"))
        .withColumn("__base", F.sum("__total").over(carried.rowsBetween(Window.unboundedPreceding, -1)))
        .where(F.col("__base").isNotNull())
        .select(*[F.col(c).alias(f"__by_{c}") for c in by], F.col("__part").alias("__base_part"), "__base")
    )
    same_group = F.col("__part") == F.col("__base_part")
    for c in by:
        same_group = same_group & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    schema = StructType([*ranged.schema.fields]).add("before", LongType())
    return (
        ranged.mapInArrow(_inside(by, list(order_by), unique), schema)
        .join(F.broadcast(bases), same_group, "left")
        .select(*by, *order_by, *keep, "amount", (F.col("before") + F.coalesce("__base", F.lit(0))).alias("before"))
    )


_NEVER = np.iinfo(np.int64).max


def _measured(by: list[str], order_by: list[str], sums: list[str], mins: list[str], lasts: list[str]):
    """An in-partition pass over sorted rows: every measure so far in the group, `lasts` without the row's own."""

    def filled(batch: pa.RecordBatch, name: str) -> np.ndarray:
        return pc.fill_null(batch.column(name), int(_NEVER)).to_numpy(zero_copy_only=False).astype(np.int64)

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: pa.RecordBatch | None = None
        carried = {**dict.fromkeys(sums, 0), **dict.fromkeys([*mins, *lasts], int(_NEVER))}
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.select([*by, *order_by])
            if last is not None:
                rows = pa.Table.from_batches([last, rows]).combine_chunks().to_batches()[0]
            changed = {c: unlike(rows.column(c)) for c in (*by, *order_by)}
            new = np.logical_or.reduce([np.zeros(rows.num_rows - 1, dtype=bool), *(changed[c] for c in by)])
            if rows.num_rows > 1 and not np.logical_or.reduce([new, *(changed[c] for c in order_by)]).all():
                raise ValueError("the order is not unique")
            if last is None:
                new = np.append(True, new)
            last = batch.select([*by, *order_by]).slice(batch.num_rows - 1)
            n = batch.num_rows
            group = np.cumsum(new)  # 0 goes on from the batch before
            starts = np.flatnonzero(new)
            begin = np.concatenate([[0], starts])[group]
            ongoing = group == 0
            columns = {}
            for name in sums:
                value = batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)
                total = np.cumsum(value)
                own = total - (total - value)[begin]
                own[ongoing] += carried[name]
                columns[name] = own
            for name in mins:
                # Ranks fall by a whole range from group to group, so one accumulation starts anew in each.
                distinct, rank = np.unique(filled(batch, name), return_inverse=True)
                least = np.minimum.accumulate(rank - group * len(distinct)) + group * len(distinct)
                own = distinct[least]
                own[ongoing] = np.minimum(own[ongoing], carried[name])
                columns[name] = own
            for name in lasts:
                value = filled(batch, name)
                at = np.maximum.accumulate(np.where(value != _NEVER, np.arange(n), -1))
                upto = np.where(at >= begin, value[np.maximum(at, 0)], np.where(ongoing, carried[name], _NEVER))
                columns[name] = np.where(begin == np.arange(n), np.where(ongoing, carried[name], _NEVER), np.append(_NEVER, upto[:-1]))
                carried[name] = int(upto[-1])
            for name in (*sums, *mins):
                carried[name] = int(columns[name][-1])
            made = [pa.array(columns[c], mask=None if c in sums else columns[c] == _NEVER) for c in (*sums, *mins, *lasts)]
            others = [c for c in batch.schema.names if c not in columns]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), *made], names=[*others, *columns])
    return pass_


def running_measures(
    df: DataFrame,
    order_by: list[str],
    partition_by: list[str],
    sums: dict[str, Column] | None = None,
    mins: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    keep: tuple[str, ...] = (),
    parts: int | None = None,
) -> DataFrame:
    """`partition_by + order_by + keep` and whole-number measures over each group's rows so far, all in one scan.

    `sums` and `mins` include the row's own value; `lasts` is the last value before
    the row that isn't null. The three combine associatively, so rows go through one
    range shuffle and one checkpoint, a pass within each partition, and what a group
    brings from earlier partitions, at most one row per partition, is broadcast.
    A null or repeated order within a group is an error; a null group is a group.
    """
    sums, mins, lasts = dict(sums or {}), dict(mins or {}), dict(lasts or {})
    missing = F.lit(False)
    for c in order_by:
        missing = missing | F.col(c).isNull()
    key = F.when(missing, F.raise_error(F.lit("null in an order column")).cast(df.schema[order_by[0]].dataType)).otherwise(F.col(order_by[0]))
    values = [c.cast("long").alias(name) for name, c in {**mins, **lasts}.items()]
    amounts = [F.coalesce(c.cast("long"), F.lit(0)).alias(name) for name, c in sums.items()]
    by, kept = list(partition_by), [c for c in keep if c not in order_by]
    ranged = checkpointed(
        df.select(*by, key.alias(order_by[0]), *order_by[1:], *kept, *amounts, *values)
        .repartitionByRange(partition_count(df, parts), *by, *order_by)
        .sortWithinPartitions(*by, *order_by)
        .withColumn("__part", F.spark_partition_id())
    )
    order = F.struct(*order_by)
    latest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), order))
    carried = Window.partitionBy(*(F.col(f"__by_{c}") for c in by)).orderBy("__base_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*[F.col(c).alias(f"__by_{c}") for c in by], F.col("__part").alias("__base_part")).agg(
        *(F.sum(c).alias(f"__b_{c}") for c in sums), *(F.min(c).alias(f"__b_{c}") for c in mins), *(latest(c).alias(f"__b_{c}") for c in lasts)
    )
    bases = totals.select(
        *(f"__by_{c}" for c in by),
        "__base_part",
        F.count("*").over(carried).alias("__earlier"),
        *(F.sum(f"__b_{c}").over(carried).alias(f"__b_{c}") for c in sums),
        *(F.min(f"__b_{c}").over(carried).alias(f"__b_{c}") for c in mins),
        *(F.last(f"__b_{c}", ignorenulls=True).over(carried).alias(f"__b_{c}") for c in lasts),
    ).where("__earlier > 0")
    same = F.col("__part") == F.col("__base_part")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    measures = [*sums, *mins, *lasts]
    fields = {f.name: f for f in ranged.schema.fields}
    others = [c for c in fields if c not in measures]
    schema = StructType([fields[c] for c in others])
    for c in measures:
        schema = schema.add(c, LongType())
    done = ranged.mapInArrow(_measured(by, list(order_by), list(sums), list(mins), list(lasts)), schema)
    return done.join(F.broadcast(bases), same, "left").select(
        *by,
        *order_by,
        *kept,
        *((F.col(c) + F.coalesce(f"__b_{c}", F.lit(0))).alias(c) for c in sums),
        *(F.least(c, f"__b_{c}").alias(c) for c in mins),
        *(F.coalesce(c, f"__b_{c}").alias(c) for c in lasts),
    )


def ordered_positions(
    df: DataFrame,
    order_by: list[str],
    partition_by: list[str] | None = None,
    parts: int | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """`partition_by + order_by + keep + pos`, `pos` counting from 0 in each group."""
    ranked = running_total(df, order_by, F.lit(1), partition_by, parts, keep)
    return ranked.drop("amount").withColumnRenamed("before", "pos")


def file_places(df: DataFrame) -> list[Column] | None:
    """File and offset of the split that each row was read from, or None for a frame that isn't read from files."""
    places = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block")]
    try:
        df.select(*places).schema  # noqa: B018
    except AnalysisException:
        return None
    return places


def file_positions(df: DataFrame) -> DataFrame:
    """Add `pos`, the row's place from 0 in the order of the frame's files, by path, and of the lines in them.

    Spark reads splits of files in an order of its own; they are put in order of path
    and offset, and rows count on within them. The frame must be as it was read but for
    projections and filters; a split whose rows were dealt to several partitions since
    is an error. A frame that isn't read from files counts in the order of its partitions.
    """
    places = file_places(df) or [F.lit("").alias("__file"), F.lit(0).cast("long").alias("__block")]
    held = checkpointed(
        df.select("*", *places, F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__row"))
    )
    split = ["__file", "__block", "__part"]
    earlier = Window.partitionBy(F.lit(0)).orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    # One row per split that was read: the driver lists as many to plan the reading, which bounds the broadcast.
    bases = (
        held.groupBy(*split)
        .agg(F.count("*").alias("__n"), F.min("__row").alias("__first"))
        .select(
            *split,
            "__first",
            F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__base"),
            F.lag(F.struct("__file", "__block")).over(Window.partitionBy(F.lit(0)).orderBy(*split)).alias("__last"),
        )
    )
    torn = (F.col("__file") != "") & (F.col("__last") == F.struct("__file", "__block"))
    checked = F.when(torn, F.raise_error(F.lit("rows are no longer in the order of their files"))).otherwise(F.col("__base"))
    bases = bases.select(*split, "__first", checked.cast("long").alias("__base"))
    return (
        held.join(F.broadcast(bases), split)
        .withColumn("pos", F.col("__base") + F.col("__row") - F.col("__first"))
        .select(*df.columns, "pos")
    )
