"""Global order, lookups, splits and packing under skew; all against brute force."""

import hashlib
import random
from math import ceil

import pytest
from pyspark.sql import functions as F

from pairloom.functions.tokens import python_tokenizer
from pairloom.operators import ordered, split, tokens
from pairloom.operators.ordered import running_measures


def skewed(spark, n=900, seed=1):
    """Half of the rows in one group."""
    rnd = random.Random(seed)
    rows = [(0 if rnd.random() < 0.5 else rnd.randrange(1, 40), i, rnd.randrange(0, 50)) for i in range(n)]
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(rows, "g long, k long, v long").repartition(6)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_running_total_in_groups(spark, parts):
    rows, frame = skewed(spark)
    seen, want = {}, {}
    for g, k, v in sorted(rows):
        want[g, k] = seen.get(g, 0)
        seen[g] = want[g, k] + v
    total = ordered.running_total(frame, ["k"], F.col("v"), ["g"], parts)
    assert {(r["g"], r["k"]): r["before"] for r in total.collect()} == want


@pytest.mark.parametrize("parts", [1, 7])
def test_running_total_over_everything(spark, parts):
    rows, frame = skewed(spark)
    want, before = {}, 0
    for g, k, v in sorted(rows, key=lambda r: r[1]):
        want[k] = before
        before += v
    assert {r["k"]: r["before"] for r in ordered.running_total(frame, ["k"], F.col("v"), parts=parts).collect()} == want
    positions = {r["k"]: r["pos"] for r in ordered.ordered_positions(frame, ["k"], parts=parts).collect()}
    assert positions == {k: i for i, k in enumerate(sorted(want))}


def test_running_total_splits_the_hot_group(spark):
    _, frame = skewed(spark)
    sizes = (
        frame.repartitionByRange(8, "g", "k").withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    )
    assert max(r["count"] for r in sizes) < 900 / 8 * 2


def test_running_total_null_group_and_ties(spark):
    frame = spark.createDataFrame([(None, i) for i in range(20)], "g long, k long")
    positions = ordered.ordered_positions(frame, ["k"], ["g"], parts=4).collect()
    assert {r["k"]: r["pos"] for r in positions} == {i: i for i in range(20)}
    with pytest.raises(Exception, match="not unique"):
        ordered.ordered_positions(spark.createDataFrame([(1,), (1,)], "k long"), ["k"]).collect()


def test_file_positions(spark):
    frame = spark.range(100, numPartitions=7).select((F.col("id") * 3).alias("v"))
    assert {r["v"]: r["pos"] for r in ordered.file_positions(frame).collect()} == {3 * i: i for i in range(100)}


def hash_of(key, seed):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


@pytest.mark.parametrize("size", [0.2, 0.333, 7, 0.001])
def test_exact_split(spark, size):
    """The prefix counts find the same rows as sorting every hash."""
    n = 1000
    wanted = size if isinstance(size, int) else ceil(n * size)
    want = set(sorted(range(n), key=lambda k: hash_of(k, 5))[:wanted])
    for parts in (1, 9):
        frame = split.train_test_split(spark.range(n, numPartitions=parts), "id", size, 5, "exact")
        assert {r["id"] for r in frame.where("split = 'test'").collect()} == want
        assert frame.count() == n


def test_threshold_split(spark):
    frame = split.train_test_split(spark.range(5000), "id", 0.2, seed=3)
    test = {r["id"] for r in frame.where("split = 'test'").collect()}
    assert test == {k for k in range(5000) if int(hash_of(k, 3), 16) < 0.2 * 16**32}
    assert 800 < len(test) < 1200
    other = split.train_test_split(spark.range(5000), "id", 0.2, seed=4).where("split = 'test'")
    assert {r["id"] for r in other.collect()} != test
    assert split.train_test_split(spark.range(9), "id").where("split = 'train'").count() == 9


@pytest.mark.parametrize("size, mode", [(1.5, "threshold"), (0.0, "exact"), (3, "threshold"), (99, "exact"), (0.5, "odd")])
def test_split_arguments(spark, size, mode):
    with pytest.raises(ValueError):
        split.train_test_split(spark.range(9), "id", size, mode=mode)


def lists(spark, lengths):
    rows = [(i, [f"{i}.{k}" for k in range(n)]) for i, n in enumerate(lengths)]
    return [t for _, ts in rows for t in ts], spark.createDataFrame(rows, "id long, tokens array<string>").repartition(5)


@pytest.mark.parametrize(
    "lengths, max_len, blocks, dropped",
    [([3, 5, 4], 4, 3, 0), ([3, 5, 5], 4, 3, 1), ([0, 1, 0], 4, 0, 1), ([30, 0, 1], 4, 7, 3), ([4, 4], 4, 2, 0)],
)
def test_pack_micro_cases(spark, lengths, max_len, blocks, dropped):
    stream, frame = lists(spark, lengths)
    packed = tokens.pack_sequences(frame, "id", max_len).orderBy("block_id").collect()
    assert len(packed) == blocks and all(r["n_tokens"] == max_len for r in packed)
    assert [t for r in packed for t in r["tokens"]] == stream[: len(stream) - dropped]


@pytest.mark.parametrize("parts", [1, 6])
def test_pack_property(spark, parts):
    """Blocks in order concatenate back to the input, whatever the partitioning."""
    rnd = random.Random(8)
    stream, frame = lists(spark, [rnd.choice([0, 1, 2, 7, 30, 400]) for _ in range(150)])
    packed = tokens.pack_sequences(frame, "id", 64, drop_last=False, parts=parts).orderBy("block_id").collect()
    assert [t for r in packed for t in r["tokens"]] == stream
    assert [r["block_id"] for r in packed] == list(range(ceil(len(stream) / 64)))
    joined = frame.select("id", F.array_join("tokens", " ").alias("t"))
    texts = tokens.pack_sequences(joined, "id", 64, drop_last=False, parts=parts, text="t")
    assert texts.orderBy("block_id").collect() == packed
    for r in packed:
        assert r["n_docs"] == len({t.split(".")[0] for t in r["tokens"]})


def test_pack_arguments(spark):
    with pytest.raises(ValueError, match="positive"):
        tokens.pack_sequences(spark.range(1).withColumn("tokens", F.array(F.lit("a"))), "id", 0)


def test_count_tokens(spark):
    frame = spark.createDataFrame([("x", "a b"), ("x", None), ("y", " ")], "g string, t string")
    assert {r["g"]: r["n_tokens"] for r in tokens.count_tokens(frame, "t", "g").collect()} == {"x": 2, "y": 0}
    assert tokens.count_tokens(frame, "t").collect() == [(2,)]
    assert tokens.count_tokens(frame.limit(0), "t").collect() == [(0,)]


def shuffles(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_row_operators_do_not_shuffle(spark):
    """Plans of the map-only operators hold no exchange."""
    from pairloom.catalog import spark_queries as q

    sf = "/root/testdata/sf0.001"
    for name in ("normalize_text", "drop_marked", "unpivot_targets", "flatten_qa", "mrc_pairs", "split_threshold",
                 "split_exact", "tokenize"):
        assert shuffles(q.registered()[name](spark, sf)) == 0, name
    assert shuffles(q.registered()["summary_pairs"](spark, sf)) == 0


def test_packing_tokenises_once_and_shuffles_fragments(spark):
    """Each text is tokenised once; after the pages only what is left at the ends of partitions is shuffled."""
    texts = spark.createDataFrame([(i, " ".join(f"{i}.{k}" for k in range(i % 23))) for i in range(400)], "id long, t string")
    calls = spark.sparkContext.accumulator(0)

    def split(text):
        calls.add(1)
        return text.split()

    packed = tokens.pack_sequences(texts, "id", 16, drop_last=False, text="t", tokenizer=python_tokenizer(split), parts=4)
    found = packed.orderBy("block_id").collect()
    assert calls.value == 400
    assert [t for r in found for t in r["tokens"]] == [f"{i}.{k}" for i in range(400) for k in range(i % 23)]
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "split(" not in plan
    rows = {
        n: sorted(map(tuple, tokens.pack_sequences(texts.repartition(n), "id", 16, False, text="t", parts=n).collect()), key=lambda r: r[0])
        for n in (1, 17)
    }
    assert rows[1] == rows[17] == [tuple(r) for r in found]


def test_pack_pages_and_blocks_of_any_size(spark, monkeypatch):
    """Pages smaller than a block, blocks longer than a partition, a row longer than all, and rows without tokens."""
    monkeypatch.setattr(tokens, "PAGE_TOKENS", 7)  # goes to the workers with the pass
    stream, frame = lists(spark, [0, 3, 900, 0, 5, 1, 0])
    for max_len in (1, 2, 300, 2000):
        got = tokens.pack_sequences(frame, "id", max_len, drop_last=False, parts=5).orderBy("block_id").collect()
        assert [r["tokens"] for r in got] == [stream[i : i + max_len] for i in range(0, len(stream), max_len)]
    none = frame.select("id", F.when(F.col("id") < 3, F.col("tokens")).alias("tokens"))
    assert sum(r["n_tokens"] for r in tokens.pack_sequences(none, "id", 4, False).collect()) == 903
    assert tokens.pack_sequences(frame.where("false"), "id", 4, False).collect() == []
    with pytest.raises(Exception, match="null in an order column"):
        tokens.pack_sequences(frame.withColumn("id", F.lit(None).cast("long")), "id", 4).collect()
    with pytest.raises(Exception, match="not unique"):
        tokens.pack_sequences(frame.withColumn("id", F.lit(1)), "id", 4).collect()


def test_pages_round_trip():
    import pyarrow as pa

    held = [["a", "b"], ["é" * 9], ["b", "b", "a"]]
    back, sizes = tokens._page(tokens._page_bytes(pa.array([[], *held], pa.list_(pa.string())).slice(1)))
    assert back.to_pylist() == [t for own in held for t in own] and sizes.tolist() == [2, 1, 3]


def brute_measures(rows):
    """(group, order, value): sums and minima so far, and the last value before that isn't null."""
    out, sums, mins, lasts = [], {}, {}, {}
    for g, o, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        before = lasts.get(g)
        sums[g] = sums.get(g, 0) + (v or 0)
        if v is not None:
            mins[g] = min(mins.get(g, v), v)
            lasts[g] = v
        out.append((g, o, sums[g], mins.get(g), before))
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_running_measures(spark, parts):
    """A group that owns a third, many small ones, a null one, nulls and wide values."""
    rnd = random.Random(3)
    rows = [(rnd.choice([None, 1, 1, 1, *range(60)]), i, rnd.choice([None, None, rnd.randrange(-(10**15), 10**15), 5])) for i in range(4000)]
    frame = spark.createDataFrame(rows, "g long, o long, v long").repartition(5)
    with_conf = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 97)
    try:
        got = running_measures(frame, ["o"], ["g"], {"s": F.col("v")}, {"m": F.col("v")}, {"l": F.col("v")}, parts=parts).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", with_conf)
    assert sorted(map(tuple, got), key=repr) == sorted(brute_measures(rows), key=repr)


def test_filters_and_columns_reach_the_scan(spark):
    from pairloom.catalog import spark_queries as q

    plan = q.registered()["token_f1"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,user)" in plan
    assert "ReadSchema: struct<conv_id:bigint,turn:bigint,role:string>" in plan
