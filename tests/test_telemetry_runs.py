"""Throughput by one scan and on a stream: null runs, restarts, late and unordered events."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from pairloom.operators import telemetry
from pairloom.streaming.throughput import late_rows, run_to_parquet, running_throughput_stream

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "run string, step long, ts timestamp"


def runs(seed=5):
    """Runs of one step to many, one of them null, one that owns most events, with lost steps."""
    rng = random.Random(seed)
    rows = []
    for run, n in ((None, 40), ("a", 1), ("b", 7), ("hot", 900), ("c", 120)):
        at = START + timedelta(seconds=rng.randrange(5000))
        for step in range(1, n + 1):
            at += timedelta(milliseconds=rng.randrange(0, 9000))
            if rng.random() < 0.9:
                rows.append((run, step, at))
    return rows


def brute(rows, every, tokens):
    out, seen = [], {}
    for run, step, at in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        start, before = seen.setdefault(run, [at, None])
        if step % every == 0:
            gone = (at - start).total_seconds()
            out.append((run, step, pytest.approx(step * tokens / gone) if gone else None, pytest.approx((at - (before or start)).total_seconds())))
            seen[run][1] = at
    return out


def listed(frame):
    return sorted(map(tuple, frame.collect()), key=lambda r: (r[0] is not None, r[0] or "", r[1]))


def test_throughput_of_all_runs(spark):
    rows = runs()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert listed(telemetry.throughput(frame, 5, 2, 10)) == brute(rows, 5, 20)
    tokens = telemetry.throughput(frame.withColumn("n", F.lit(3)), 5, 1, 1, tokens="n")
    assert {r["run"] for r in tokens.collect()} == {None, "b", "hot", "c"}
    epochs = telemetry.epoch_throughput(frame.withColumn("epoch", F.floor(F.col("step") / 50)), 5, 1, 1).collect()
    assert {r["run"] for r in epochs} == {None, "a", "b", "hot", "c"} and all(r["elapsed_time"] is not None for r in epochs)


def test_throughput_reads_and_shuffles_once(spark):
    frame = spark.createDataFrame(runs(), SCHEMA).withColumn("n", F.lit(3))
    plan = telemetry.throughput(frame, 5, 1, 1, tokens="n")._jdf.queryExecution().executedPlan().toString()
    # The rows lie in one checkpoint; what is shuffled after it is a total per run and partition.
    assert plan.count("MapInArrow") == 1 and "SortMergeJoin" not in plan and plan.count("BroadcastExchange") == 1


def test_null_and_repeated_steps_are_errors(spark):
    frame = spark.createDataFrame([("a", 1, START), ("a", None, START)], SCHEMA)
    with pytest.raises(Exception, match="null in an order column"):
        telemetry.throughput(frame, 1, 1, 1).collect()
    with pytest.raises(Exception, match="not unique"):
        telemetry.throughput(spark.createDataFrame([("a", 1, START)] * 2, SCHEMA), 1, 1, 1).collect()
    assert telemetry.throughput(frame.where("false"), 1, 1, 1).collect() == []


def write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_running_stream_equals_throughput(spark, tmp_path):
    """Shuffled arrival within the delay, over restarts from the checkpoint; an event far later closes all steps."""
    rows = sorted(runs(), key=lambda r: r[2])
    rng = random.Random(2)
    jittered = sorted(rows, key=lambda r: r[2] + timedelta(seconds=rng.randrange(60)))
    events, out, checkpoint = (str(tmp_path / n) for n in ("events", "out", "checkpoint"))
    cuts = [0, 1, len(rows) // 3, len(rows) // 2, len(rows)]
    total = 0
    for a, b in zip(cuts, cuts[1:]):
        write(spark, events, jittered[a:b])
        stream = spark.readStream.schema(SCHEMA).parquet(events)
        query = run_to_parquet(running_throughput_stream(stream, 5, 20, "2 minutes"), out, checkpoint)
        total += late_rows(query)
        closed = listed(spark.read.parquet(out))
        assert len({(r[0], r[1]) for r in closed}) == len(closed)
    assert total == 0 and len(closed) < len(brute(rows, 5, 20))
    write(spark, events, [("end", 1, START + timedelta(days=2))])
    stream = spark.readStream.schema(SCHEMA).parquet(events)
    run_to_parquet(running_throughput_stream(stream, 5, 20, "2 minutes"), out, checkpoint)
    assert listed(spark.read.parquet(out)) == brute(rows, 5, 20)
    batch = telemetry.throughput(spark.createDataFrame(rows, SCHEMA), 5, 2, 10)
    assert [r[:2] for r in listed(batch)] == [r[:2] for r in listed(spark.read.parquet(out))]


def test_late_events_are_counted(spark, tmp_path):
    events, out, checkpoint = (str(tmp_path / n) for n in ("events", "out", "checkpoint"))
    at = lambda s: START + timedelta(seconds=s)
    late = 0
    for rows in ([("a", 1, at(0)), ("a", 3, at(600))], [("a", 2, at(5)), ("a", 4, at(700)), (None, 2, at(650))], [("a", 5, at(5000))]):
        write(spark, events, rows)
        stream = spark.readStream.schema(SCHEMA).parquet(events)
        late += late_rows(run_to_parquet(running_throughput_stream(stream, 2, 1, "1 minute"), out, checkpoint))
    assert late == 1
    # The late step 2 of run a is lost; step 4 goes back to the run's start.
    assert listed(spark.read.parquet(out)) == [(None, 2, None, 0.0), ("a", 4, 4 / 700, 700.0)]
