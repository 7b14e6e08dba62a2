"""Token rates over a stream of step events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_STATE = "start bigint, before bigint, steps array<bigint>, times array<bigint>"


def throughput_stream(
    events: DataFrame,
    tokens_per_step: int,
    window: str = "1 hour",
    delay: str = "10 minutes",
    run: str = "run",
) -> DataFrame:
    """`(run, window_start, window_end, steps, first_ts, last_ts, tokens_per_second)` per tumbling window.

    Works on streams and on tables. On a stream a window is emitted once the
    watermark passes its end; events later than `delay` are dropped. The rate is
    over the window's length. `ts` may be a zone-less timestamp; it is read in the
    session's zone.
    """
    stamped = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    counted = stamped.groupBy(F.window("ts", window), run).agg(
        F.count("*").alias("steps"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
    seconds = F.unix_timestamp("window.end") - F.unix_timestamp("window.start")
    return counted.select(
        run,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "steps",
        "first_ts",
        "last_ts",
        (F.col("steps") * F.lit(tokens_per_step) / seconds).alias("tokens_per_second"),
    )


def _closed_steps(every: int, tokens_per_step: int, run: str):
    """The keyed pass: holds a run's logged steps until the watermark has passed them."""

    def rows(key: object, closed: list[tuple[int, int, int, int]]) -> pd.DataFrame:
        seconds = [(at - start) / 1e6 for _, at, start, _ in closed]
        return pd.DataFrame(
            {
                run: pd.Series([key] * len(closed), dtype=object),
                "step": [step for step, *_ in closed],
                "throughput": [step * tokens_per_step / s if s > 0 else None for (step, *_), s in zip(closed, seconds)],
                "elapsed_time": [(at - begin) / 1e6 for _, at, _, begin in closed],
            }
        )

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start, before, steps, times = state.get if state.exists else (None, None, [], [])
        held = dict(zip(steps, times))
        for frame in frames:
            if frame.empty:  # the state was called for its timeout
                continue
            own = int(frame["__at"].min())
            start = own if start is None else min(start, own)
            logged = frame[frame["step"] % every == 0]
            for number, at in zip(logged["step"].tolist(), logged["__at"].tolist()):
                held[number] = min(at, held.get(number, at))
        passed = state.getCurrentWatermarkMs() * 1000
        closed = []
        for number in sorted(n for n, at in held.items() if at <= passed):
            at = held.pop(number)
            closed.append((number, at, start, start if before is None else before))
            before = at
        state.update((start, before, list(held), list(held.values())))
        if held:
            # Fires as soon as the watermark, in whole milliseconds, has reached the earliest step held.
            state.setTimeoutTimestamp(-(-min(held.values()) // 1000) - 1)
        if closed:
            yield rows(key[0], closed)

    return step


def running_throughput_stream(
    events: DataFrame,
    every: int,
    tokens_per_step: int,
    delay: str = "10 minutes",
    run: str = "run",
) -> DataFrame:
    """`(run, step, throughput, elapsed_time)` at every N-th step of a stream of `(run, step, ts)`, while runs go on.

    The rows are those of `telemetry.throughput`: tokens since the run's first event
    over the time since, and the time since the logged step before. A step is emitted
    once the watermark has passed it, so that events may arrive up to `delay` late and
    in any order; later ones are dropped and counted (`late_rows`). A run's state is
    its start, its last emitted step and the logged steps younger than `delay`; it is
    kept in the checkpoint, and for good. Steps of a run happen in the order of their
    numbers. A repeated step counts once, by its earliest time. A null run is a run, a
    null step or time is an error.
    """
    missing = F.col("step").isNull() | F.col("ts").isNull()
    checked = F.when(missing, F.raise_error(F.lit("null step or time")).cast("long")).otherwise(F.col("step").cast("long"))
    stamped = events.select(run, checked.alias("step"), F.col("ts").cast("timestamp").alias("ts")).withWatermark("ts", delay)
    kind = events.schema[run].dataType.simpleString()
    return (
        stamped.withColumn("__at", F.unix_micros("ts"))
        .groupBy(run)
        .applyInPandasWithState(
            _closed_steps(every, tokens_per_step, run),
            f"`{run}` {kind}, step bigint, throughput double, elapsed_time double",
            _STATE,
            "append",
            GroupStateTimeout.EventTimeTimeout,
        )
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after their watermark, over the batches whose progress the session remembers."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Drain what the source holds now into a parquet folder, each row exactly once; the ended query."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
