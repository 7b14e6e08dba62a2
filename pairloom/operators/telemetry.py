"""Throughput and resource series from tables of step events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.operators.ordered import running_measures

GIB = 1024**3


def seconds_between(begin: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", begin, end) / F.lit(1_000_000.0)


def _rate(tokens: Column, seconds: Column) -> Column:
    """Null where no time has passed."""
    return tokens / F.when(seconds > 0, seconds)


def throughput(
    steps: DataFrame,
    every: int,
    batch: int,
    max_len: int,
    accum: int = 1,
    world: int = 1,
    run: str = "run",
    tokens: str | None = None,
) -> DataFrame:
    """`(run, step, throughput, elapsed_time)` at every N-th step of `(run, step, ts)`, steps from 1.

    Throughput is cumulative since the run's start, from the nominal token count,
    or from the `tokens` column. Elapsed time goes back to the run's logged step
    before, whether or not it is N steps earlier, and from the first one to the
    run's start: the earliest time among its steps so far. Start, logged step before
    and tokens come from one scan in order of (run, step), so a run of any length
    spreads over tasks and nothing is joined to itself. A null run is a run; a null
    or repeated step of a run is an error; null tokens are none.
    """
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    sums = {} if tokens is None else {"__done": F.col(tokens)}
    scanned = running_measures(
        steps.select(run, F.col("step").cast("long").alias("step"), micros.alias("__at"), *([tokens] if tokens else [])),
        ["step"],
        [run],
        sums=sums,
        mins={"__start": F.col("__at")},
        lasts={"__before": F.when(F.col("step") % every == 0, F.col("__at"))},
        keep=("__at",),
    ).where(F.col("step") % every == 0)
    done = F.col("__done") if tokens else F.col("step") * F.lit(batch * max_len * accum * world)
    since = lambda begin: (F.col("__at") - begin) / F.lit(1_000_000.0)
    return scanned.select(
        run,
        "step",
        _rate(done, since(F.col("__start"))).alias("throughput"),
        since(F.coalesce("__before", "__start")).alias("elapsed_time"),
    )


def epoch_throughput(
    steps: DataFrame,
    every: int,
    batch: int,
    max_len: int,
    accum: int = 1,
    world: int = 1,
    run: str = "run",
    epoch: str = "epoch",
) -> DataFrame:
    """One row per epoch end: `(run, epoch, step, throughput, elapsed_time)`.

    The token count is the cumulative one of the N-step windows finished by then.
    An epoch lasts from the end of the one before, the first from the run's start.
    A null run is a run, and a null epoch one before all others.
    """
    # One row per epoch; a run has few.
    whole = Window.partitionBy(run)
    ends = (
        steps.groupBy(run, epoch)
        .agg(F.min("ts").alias("__first"), F.max("ts").alias("__end"), F.max("step").alias("step"))
        .withColumn("__begin", F.lag("__end").over(whole.orderBy(epoch)))
        .withColumn("__start", F.min("__first").over(whole))
    )
    done = F.floor(F.col("step") / every) * F.lit(every * batch * max_len * accum * world)
    return ends.select(
        run,
        epoch,
        "step",
        _rate(done, seconds_between(F.col("__start"), F.col("__end"))).alias("throughput"),
        seconds_between(F.coalesce("__begin", "__start"), F.col("__end")).alias("elapsed_time"),
    )


def sample_metrics(samples: DataFrame, every: int, keys: tuple[str, ...] = ("run", "step")) -> DataFrame:
    """Every N-th step's counters as `(run, step, metric, value)`; byte counters in GiB.

    `gpus` is an array of `(utilization, allocated, reserved)`, one series per device.
    """
    def line(name, value: Column) -> Column:
        return F.struct((F.lit(name) if isinstance(name, str) else name).alias("metric"), value.cast("double").alias("value"))

    gib = lambda c: c / F.lit(float(GIB))
    host = F.array(
        line("cpu_utilization", F.col("cpu_utilization")),
        line("ram_usage_gib", gib(F.col("ram_used"))),
        line("ram_available_gib", gib(F.col("ram_available"))),
        line("disk_read_gib", gib(F.col("disk_read"))),
        line("disk_write_gib", gib(F.col("disk_write"))),
    )

    def device(gpu: Column, i: Column) -> Column:
        name = lambda what: F.concat(F.lit("gpu_"), i.cast("string"), F.lit(what))
        return F.array(
            line(name("_utilization"), gpu["utilization"]),
            line(name("_memory_allocated_gib"), gib(gpu["allocated"])),
            line(name("_memory_reserved_gib"), gib(gpu["reserved"])),
        )

    no_lines = F.array().cast("array<struct<metric:string,value:double>>")
    devices = F.coalesce(F.flatten(F.transform("gpus", device)), no_lines)
    return (
        samples.where(F.col("step") % every == 0)
        .select(*keys, F.explode(F.concat(host, devices)).alias("line"))
        .select(*keys, "line.metric", "line.value")
    )
