"""Readers, writers, the file-to-file jobs, batch scoring, telemetry and streaming."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from pairloom.operators import chat, telemetry
from pairloom.operators.generate import batch_generate
from pairloom.plans import jobs
from pairloom.sources import tables as io
from pairloom.streaming.throughput import run_to_parquet, throughput_stream

HARD = [
    ('say "hi"\nthere', " padded ", 1),
    ("a,b\\n", 'ends with "', 2),
    ("۱۲؟\r\nx", "back\\slash\\", 3),
    ("", "empty left", 4),
]


def hard_frame(spark):
    return spark.createDataFrame(HARD, "inputs string, targets string, id long")


def test_csv_round_trip(spark, tmp_path):
    io.write_responses_csv(hard_frame(spark), str(tmp_path / "csv"))
    back = io.read_pairs_csv(spark, str(tmp_path / "csv"), na_values=())
    assert back.columns == ["inputs", "targets", "id"]
    assert sorted((r["inputs"], r["targets"], int(r["id"])) for r in back.collect()) == sorted(HARD)


def test_csv_missing_values_and_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text('extra,inputs,targets\n1,NA,x\n2,"multi\nline ""q""",null\n3,,y\n', encoding="utf-8")
    read = io.read_pairs_csv(spark, str(tmp_path / "a.csv"), ["targets", "inputs"])
    assert sorted(read.collect(), key=str) == sorted(
        [("x", None), (None, 'multi\nline "q"'), ("y", None)], key=str
    )
    kept = io.read_pairs_csv(spark, str(tmp_path / "a.csv"), ["inputs"], na_values=())
    assert ("NA",) in kept.collect()


def test_jsonl_dir(spark, tmp_path):
    write = lambda name, *rows: (tmp_path / name).write_text(
        "".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows), encoding="utf-8"
    )
    write("a.jsonl", {"x": 1, "y": "é"}, {"x": 2, "y": None})
    write("b.jsonl", {"x": 3})
    write("c.jsonl", {"x": 4, "y": "z"})
    write("ignored.json", {"x": 5, "y": "no"})
    (tmp_path / "deeper").mkdir()
    (tmp_path / "deeper" / "d.jsonl").write_text('{"x": 6, "y": "no"}\n')
    for schema in (None, "x long, y string"):
        rows = io.read_jsonl_dir(spark, str(tmp_path), schema).select("x", "y").collect()
        assert sorted(rows) == [(1, "é"), (4, "z")]
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(Exception):
        io.read_jsonl_dir(spark, str(empty))
    with pytest.raises(FileNotFoundError):
        io.read_jsonl_dir(spark, str(empty), "x long")


def test_split_folders(spark, tmp_path):
    frame = hard_frame(spark).withColumn("prompt", F.when(F.col("id") > 1, "پ"))
    path = str(tmp_path / "s")
    io.write_splits_jsonl(frame.withColumn("split", F.when(F.col("id") < 3, "train").otherwise("test")), path)
    raw = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "s").rglob("*.json"))
    assert '"prompt":"پ"' in raw and '"prompt":null' in raw
    train, test = io.load_splits(spark, path, frame.schema)
    assert sorted(train.collect(), key=str) == sorted(frame.where("id < 3").collect(), key=str)
    assert test.count() == 2
    io.write_splits_jsonl(frame.withColumn("split", F.lit("train")), path)
    train, test = io.load_splits(spark, path, frame.schema)
    assert train.count() == 4 and test.count() == 0


def test_split_files_with_optional_test(spark, tmp_path):
    (tmp_path / "train_dataset.json").write_text('{"prompt": "p", "inputs": "i", "targets": "t"}\n')
    train, test = io.load_split_files(spark, str(tmp_path))
    assert train.collect() == [("i", "t", "p")] and test.count() == 0


def test_preprocess_job(spark, tmp_path):
    io.write_responses_csv(hard_frame(spark).where("inputs <> ''"), str(tmp_path / "in"))
    jobs.preprocess(spark, str(tmp_path / "in"), str(tmp_path / "out"), system="S", test_size=1, mode="exact")
    train, test = io.load_splits(spark, str(tmp_path / "out"))
    assert train.count() == 2 and test.count() == 1
    want = {chat_of(i, t) for i, t, _ in HARD if i}
    assert {r["prompt"] for r in train.unionByName(test).collect()} == want


def chat_of(inputs, targets):
    turn = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    return turn("system", "S") + turn("user", inputs) + turn("assistant", targets)


def test_batch_generate(spark):
    def make_upper():
        return lambda prompts, keep: [p + p.upper()[:keep] for p in prompts]

    frame = spark.range(50).select("id", F.concat(F.lit("p"), "id").alias("prompt"))
    for size, parts in ((1, None), (7, 3), (1000, None)):
        out = batch_generate(frame, "prompt", make_upper, size, partitions=parts, keep=2).collect()
        assert {r["id"]: r["generated_text"] for r in out} == {i: f"p{i}" + f"P{i}"[:2] for i in range(50)}

    def make_short():
        return lambda prompts: prompts[1:]

    with pytest.raises(Exception, match="predictor returned"):
        batch_generate(frame, "prompt", make_short).collect()


def test_predictor_loads_once_per_task(spark):
    def make_counting():
        loads = [0]

        def predict(prompts):
            loads[0] += 1
            return [str(loads[0]) for _ in prompts]

        return predict

    out = batch_generate(spark.range(10, numPartitions=1).withColumn("p", F.lit("x")), "p", make_counting, 4)
    assert sorted(r["generated_text"] for r in out.collect()) == ["1"] * 4 + ["2"] * 4 + ["3"] * 2


def test_infer_and_evaluate_jobs(spark, tmp_path):
    data, out = str(tmp_path / "data"), str(tmp_path / "pred")
    frame = spark.createDataFrame([("one two", "ONE"), ("three", "THREE"), ("four", "no")], "inputs string, targets string")
    io.write_responses_csv(frame.coalesce(1), data)

    def make_model():
        return lambda prompts: [p + p.split("\n")[1].split("<")[0].split(" ")[0].upper() for p in prompts]

    jobs.infer(spark, data, out, "inputs", make_model, system=None, split_mode="tagged")
    replies = io.read_pairs_csv(spark, out).collect()
    assert [tuple(r) for r in replies] == [("one two", "ONE"), ("three", "THREE"), ("four", "FOUR")]
    report = jobs.evaluate_files(
        spark, data, out, "targets", "assistant", ("exact_match", "f1_score"), output_path=str(tmp_path / "scores")
    )
    assert {r["metric"]: round(r["score"], 4) for r in report.collect()} == {"exact_match": 0.6667, "f1_score": 0.6667}
    assert spark.read.parquet(str(tmp_path / "scores" / "examples")).count() == 6
    assert spark.read.json(str(tmp_path / "scores" / "averages")).count() == 2


def test_evaluate_by_key_and_by_position_with_unequal_sides(spark, tmp_path):
    preds = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, assistant string").coalesce(1)
    refs = spark.createDataFrame([(1, "a"), (2, "b")], "k long, targets string").coalesce(1)
    io.write_responses_csv(preds, str(tmp_path / "p"))
    io.write_responses_csv(refs, str(tmp_path / "r"))
    job = lambda **kw: jobs.evaluate_files(
        spark, str(tmp_path / "r"), str(tmp_path / "p"), "targets", "assistant", ("exact_match",), **kw
    ).head()["score"]
    assert job() == pytest.approx(2 / 3)
    assert job(on="k", output_path=str(tmp_path / "o")) == 1.0
    rows = spark.read.json(str(tmp_path / "o" / "unmatched")).collect()
    assert {r["side"]: r["n_unmatched"] for r in rows} == {"prediction": 1, "reference": 0}


def test_pack_job(spark, tmp_path):
    frame = spark.createDataFrame([(i, "a b c", "i", "t") for i in range(5)], "id long, prompt string, inputs string, targets string")
    io.write_splits_jsonl(frame.withColumn("split", F.lit("train")), str(tmp_path / "in"))
    jobs.pack_training_blocks(spark, str(tmp_path / "in"), str(tmp_path / "out"), 4)
    blocks = spark.read.parquet(str(tmp_path / "out" / "train")).orderBy("block_id").collect()
    assert [r["tokens"] for r in blocks] == [list("abca"), list("bcab"), list("cabc")]
    assert spark.read.parquet(str(tmp_path / "out" / "test")).count() == 0


START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def steps_frame(spark, seconds, run=1):
    rows = [(run, i + 1, START + timedelta(seconds=s), 10 * (i + 1)) for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, "run long, step long, ts timestamp, n long")


def test_throughput(spark):
    steps = steps_frame(spark, [0, 10, 20, 40, 50])
    rows = telemetry.throughput(steps, 2, batch=2, max_len=5, accum=3, world=4).orderBy("step").collect()
    assert [tuple(r) for r in rows] == [(1, 2, 240 / 10, 10.0), (1, 4, 480 / 40, 30.0)]
    actual = telemetry.throughput(steps, 2, 1, 1, tokens="n").orderBy("step").collect()
    assert [tuple(r) for r in actual] == [(1, 2, 30 / 10, 10.0), (1, 4, 100 / 40, 30.0)]
    assert telemetry.throughput(steps, 1, 1, 1).orderBy("step").head()["throughput"] is None


def test_epoch_throughput(spark):
    steps = steps_frame(spark, [0, 10, 20, 40, 50]).withColumn("epoch", F.floor((F.col("step") - 1) / 3))
    rows = telemetry.epoch_throughput(steps, 2, batch=1, max_len=7).orderBy("epoch").collect()
    assert [tuple(r) for r in rows] == [(1, 0, 3, 14 / 20, 20.0), (1, 1, 5, 28 / 50, 30.0)]  # from the end of the epoch before


def test_sample_metrics(spark):
    gib = 1024.0**3
    schema = (
        "run long, step long, cpu_utilization double, ram_used double, ram_available double, "
        "gpus array<struct<utilization double, allocated double, reserved double>>, disk_read double, disk_write double"
    )
    row = lambda step, gpus: (1, step, 50.0, gib, 2 * gib, gpus, 3 * gib, 4 * gib)
    frame = spark.createDataFrame([row(1, None), row(2, [(9.0, gib, 2 * gib)]), row(4, [])], schema)
    rows = telemetry.sample_metrics(frame, 2).collect()
    at = lambda step: {r["metric"]: r["value"] for r in rows if r["step"] == step}
    host = {"cpu_utilization": 50, "ram_usage_gib": 1, "ram_available_gib": 2, "disk_read_gib": 3, "disk_write_gib": 4}
    gpu = {"gpu_0_utilization": 9, "gpu_0_memory_allocated_gib": 1, "gpu_0_memory_reserved_gib": 2}
    assert at(1) == {} and at(2) == host | gpu and at(4) == host


def test_stream_equals_batch_over_closed_windows(spark, tmp_path):
    """Several files, one per trigger; an event later than the watermark is dropped."""
    files = [(0, [0, 5, 61]), (1, [62, 130, 200]), (1, [201, 202]), (0, [1, 203, 330])]
    schema = "run long, ts timestamp_ntz"
    src = tmp_path / "src"
    for run, file in files:
        rows = [(run, (START + timedelta(minutes=m)).replace(tzinfo=None)) for m in file]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    out = str(tmp_path / "out")
    run_to_parquet(throughput_stream(stream, 60), out, str(tmp_path / "cp"))
    got = {(r["run"], r["window_start"]): (r["steps"], r["tokens_per_second"]) for r in spark.read.parquet(out).collect()}
    # File 2 moved the watermark to minute 190, so minute 1 in the last file comes too late.
    in_time = spark.read.schema(schema).parquet(str(src)).where(~((F.minute("ts") == 1) & (F.hour("ts") == 0)))
    closed = START.replace(tzinfo=None) + timedelta(minutes=330 - 10)
    want = {
        (r["run"], r["window_start"]): (r["steps"], r["tokens_per_second"])
        for r in throughput_stream(in_time, 60).collect()
        if r["window_end"] <= closed
    }
    assert got == want and len(got) == 6


def test_restarted_stream_repeats_nothing(spark, tmp_path):
    schema = "run long, ts timestamp"
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    for hours in ([0, 1, 5], [6, 9]):
        rows = [(1, START + timedelta(hours=h)) for h in hours]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        run_to_parquet(throughput_stream(spark.readStream.schema(schema).parquet(src), 60), out, cp)
    starts = sorted(r["window_start"].hour for r in spark.read.parquet(out).collect())
    assert starts == [0, 1, 5, 6]


def test_chat_formats_are_data(spark):
    plain = chat.ChatFormat(bos="[", role_prefix="<", role_suffix=">", eot="/")
    frame = spark.createDataFrame([("a", "b")], "inputs string, targets string")
    assert chat.render_chat(frame, plain, None).head()["prompt"] == "[<user>a/<assistant>b/"
