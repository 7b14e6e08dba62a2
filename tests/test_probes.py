"""Cases in which rows or pairs could be lost or mixed up without notice."""

import itertools

import pytest
from pyspark.sql import functions as F

from pairloom.operators import generate, metrics, ordered, pairing, report, split, telemetry, tokens
from pairloom.operators.chat import split_responses
from pairloom.plans import jobs


def test_preprocess_then_pack_keeps_every_token(spark, tmp_path):
    rows = [(f"question {i}", f"answer {i} word") for i in range(20)]
    for name, columns in (("plain", "inputs string, targets string"), ("keyed", "inputs string, targets string, id string")):
        held = rows if name == "plain" else [(*r, str(100 - i)) for i, r in enumerate(rows)]
        spark.createDataFrame(held, columns).write.option("header", True).csv(f"{tmp_path}/{name}")
        jobs.preprocess(spark, f"{tmp_path}/{name}", f"{tmp_path}/{name}-splits", test_size=0.3)
        jobs.pack_training_blocks(spark, f"{tmp_path}/{name}-splits", f"{tmp_path}/{name}-blocks", 16, drop_last=False)
        for part in ("train", "test"):
            prompts = spark.read.json(f"{tmp_path}/{name}-splits/split={part}")
            wanted = tokens.count_tokens(prompts, "prompt").head()["n_tokens"]
            packed = spark.read.parquet(f"{tmp_path}/{name}-blocks/{part}")
            assert packed.agg(F.sum("n_tokens")).head()[0] == wanted > 0


def test_null_order_keys_are_errors(spark):
    held = spark.createDataFrame([(1, ["a"]), (None, ["b", "c"]), (2, ["d"])], "k long, tokens array<string>")
    with pytest.raises(Exception, match="null in an order column"):
        tokens.pack_sequences(held, "k", 4).collect()
    sides = spark.createDataFrame([(1, "a"), (None, "b")], "k long, prediction string")
    with pytest.raises(Exception, match="null in an order column"):
        pairing.pair_by_position(sides, sides.withColumnRenamed("prediction", "reference"), order_by="k").collect()


def test_positions_over_several_files_follow_paths_and_lines(spark, tmp_path):
    """Unequal files, which Spark reads largest first; without file names an order is still needed."""
    frame = spark.range(400).select("id", F.concat(F.lit("text "), "id").alias("t"))
    unequal = frame.withColumn("part", F.when(F.col("id") < 5, 0).when(F.col("id") < 300, 1).when(F.col("id") < 310, 2).otherwise(3))
    unequal.repartitionByRange(4, "part").sortWithinPartitions("id").drop("part").write.option("header", True).csv(f"{tmp_path}/p")
    frame.coalesce(1).write.option("header", True).csv(f"{tmp_path}/r")
    for how in ({}, {"order_by": "id"}, {"on": "id"}):
        found = jobs.evaluate_files(spark, f"{tmp_path}/r", f"{tmp_path}/p", "t", "t", ["exact_match"], **how).head()
        assert (found["score"], found["n"]) == (1.0, 400)
    # Texts that are cut into splits inside a file.
    frame.select("t").coalesce(1).write.text(f"{tmp_path}/t")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        lines = spark.read.text(f"{tmp_path}/t")
        placed = ordered.file_positions(lines)
        assert lines.rdd.getNumPartitions() > 3
        assert {r["pos"]: r["value"] for r in placed.collect()} == {i: f"text {i}" for i in range(400)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    shuffled = spark.read.option("header", True).csv(f"{tmp_path}/p").repartition(3)
    with pytest.raises(Exception, match="order of their files"):
        ordered.file_positions(shuffled).collect()
    assert ordered.file_places(frame) is None


def test_inference_then_evaluation_by_key(spark, tmp_path):
    spark.range(200).select("id", F.concat(F.lit("q "), "id").alias("inputs")).coalesce(1).write.option("header", True).csv(f"{tmp_path}/in")
    jobs.infer(spark, f"{tmp_path}/in", f"{tmp_path}/out", "inputs", lambda: lambda prompts: prompts, key="id", partitions=4, system=None, split_mode="tagged")
    found = jobs.evaluate_files(spark, f"{tmp_path}/in", f"{tmp_path}/out", "inputs", "user", ["exact_match"], on="id").head()
    assert (found["score"], found["n"]) == (1.0, 200)


def test_exact_split_cuts_repeated_keys(spark):
    frame = spark.range(20).select("id", (F.col("id") % 2).alias("k"))
    counts = {r["split"]: r["count"] for r in split.train_test_split(frame, "k", 0.2, mode="exact").groupBy("split").count().collect()}
    assert counts == {"test": 4, "train": 16}
    with pytest.raises(ValueError, match="leaves no row"):
        split.train_test_split(spark.range(10), "id", 0.95, mode="exact")


def test_split_hash_tells_keys_apart(spark):
    frame = spark.createDataFrame([("a:b", "c"), ("a", "b:c"), (None, "x"), ("x", None)], "k string, j string")
    assert frame.select(split.split_hash(["k", "j"], 1)).distinct().count() == 4
    one = spark.createDataFrame([("",), (None,)], "k string")
    assert one.select(split.split_hash("k", 1)).distinct().count() == 2


def test_keys_that_are_null_or_repeat(spark):
    p = spark.createDataFrame([(1, "a"), (None, "b")], "id long, prediction string")
    r = spark.createDataFrame([(1, "a"), (None, "c")], "id long, reference string")
    assert {x["side"]: x["n_unmatched"] for x in pairing.unmatched(p, r).collect()} == {"prediction": 1, "reference": 1}
    assert pairing.pair(p, r).count() == 1
    twice = p.unionByName(p)
    with pytest.raises(Exception, match="repeated key"):
        pairing.pair(twice, r).collect()
    assert pairing.pair(twice, r, allow_repeats=True).count() == 2


def test_pairs_without_vectors_are_not_scored(spark):
    pairs = spark.createDataFrame([(1, "a", "a"), (2, "b", "b")], "id long, prediction string, reference string")
    vectors = spark.createDataFrame(
        [(1, side, 0, [1.0, 0.0]) for side in ("prediction", "reference")], "id long, side string, pos int, vec array<float>"
    )
    found = {(r["metric"], r["sub_metric"]): (r["score"], r["n"]) for r in report.evaluate(pairs, ["bert_score", "exact_match"], vectors=vectors).collect()}
    assert found["bert_score", "f1"] == (1.0, 1) and found["exact_match", "score"] == (1.0, 2)


def test_missing_steps_go_back_to_the_last_logged_one(spark):
    at = {5: 10, 15: 24, 20: 31}
    steps = spark.createDataFrame([(1, s, t) for s, t in {1: 2, **at}.items()], "run long, step long, s long")
    steps = steps.select("run", "step", F.timestamp_seconds("s").alias("ts"))
    rows = telemetry.throughput(steps, 5, 1, 1).orderBy("step").collect()
    assert [(r["step"], r["elapsed_time"]) for r in rows] == [(5, 8.0), (15, 14.0), (20, 7.0)]
    one = telemetry.epoch_throughput(steps.withColumn("epoch", F.col("step")), 5, 1, 1).orderBy("epoch").collect()
    assert [r["elapsed_time"] for r in one] == [0.0, 8.0, 14.0, 7.0]


def test_a_sampled_answer_is_drawn_once(spark):
    counter = itertools.count

    def make():
        drawn = counter()
        return lambda prompts: [f"{p}-{next(drawn)}" for p in prompts]

    made = generate.batch_generate(spark.range(10, numPartitions=1).select(F.col("id").cast("string").alias("p")), "p", make)
    plan = made.where(F.col("generated_text") != "x")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") + plan.count("BatchEvalPython") <= 2 and plan.count("generate(") <= 2
    rows = split_responses(made.where("generated_text <> 'x'"), "generated_text").collect()
    assert len(rows) == 10


def test_columns_and_names_that_are_taken(spark):
    frame = spark.createDataFrame([("t", "u")], "generated_text string, user string")
    with pytest.raises(ValueError, match="already"):
        split_responses(frame)
    with pytest.raises(ValueError, match="built-in"):
        metrics.register_metric("rouge", lambda p, r: F.lit(1.0))


def test_running_totals_survive_any_partitioning(spark):
    frame = spark.range(500).select((F.col("id") % 3).alias("g"), F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    wanted = {}
    for k in range(500):
        wanted[k] = sum(j % 7 for j in range(k) if j % 3 == k % 3)
    for n in (1, 17):
        rows = ordered.running_total(frame.repartition(n), ["k"], F.col("v"), ["g"], parts=9).collect()
        assert {r["k"]: r["before"] for r in rows} == wanted
    ties = spark.createDataFrame([(1, 5), (1, 7), (2, 1)], "k long, v long")
    assert sorted(r["before"] for r in ordered.running_total(ties, ["k"], F.col("v"), unique=False).collect())[-1] == 12
