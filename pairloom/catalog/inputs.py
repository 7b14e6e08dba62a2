"""Operator inputs derived from the given tables. Each covers its whole table."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.constants import NO_ANSWER
from pairloom.functions.text import normalize_text
from pairloom.functions.tokens import whitespace_tokens
from pairloom.operators.ordered import ordered_positions


# An id is the conversation's number times this, plus the turn.
TURN_SPAN = 2**32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def training_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(id, inputs, targets)`: each user turn with the assistant turn right after it.

    A self-join on the unique (conversation, turn) key, so a conversation of any
    length spreads over tasks. The explicit repartition is the one a sort-merge
    join needs anyway; it keeps later Python stages parallel when the other side
    is small enough to be broadcast.
    """
    turns = table(spark, sf_dir, "conversations")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = (
        turns.where(F.col("role") == "user")
        .select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("inputs"))
        .repartition(parts, "conv_id", "turn")
    )
    answered = turns.where(F.col("role") == "assistant").select("conv_id", "turn", F.col("text").alias("targets"))
    return asked.join(answered, ["conv_id", "turn"]).select(
        (F.col("conv_id") * TURN_SPAN + F.col("turn") - 1).alias("id"), "inputs", "targets"
    )


def with_prediction(pairs: DataFrame) -> DataFrame:
    """`(id, prediction, reference)`: every third token of the reference is left out, unless id % 5 = 0."""
    kept = F.filter(whitespace_tokens(F.col("targets")), lambda t, i: i % 3 != 2)
    return pairs.select(
        "id",
        F.when(F.col("id") % 5 == 0, F.col("targets")).otherwise(F.array_join(kept, " ")).alias("prediction"),
        F.col("targets").alias("reference"),
    )


def eval_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_prediction(training_pairs(spark, sf_dir))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(id, messages)`: a pair's turns, preceded by the system turn when one comes right before."""
    turns = table(spark, sf_dir, "conversations")
    system = turns.where(F.col("role") == "system").select(
        (F.col("conv_id") * TURN_SPAN + F.col("turn") + 1).alias("id"), F.col("text").alias("system")
    )
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    pair = F.array(turn("user", "inputs"), turn("assistant", "targets"))
    return (
        training_pairs(spark, sf_dir)
        .join(system, "id", "left")
        .select(
            "id",
            F.when(F.col("system").isNull(), pair)
            .otherwise(F.concat(F.array(turn("system", "system")), pair))
            .alias("messages"),
        )
    )


def wide_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with four derived summaries; the one-line summary of a one-line document is null."""
    lines = F.split("text", "\n")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("text").alias("context"),
        F.when(F.size(lines) > 1, F.element_at(lines, -1)).alias("one_line_summary"),
        F.concat_ws(" / ", "lang", "source").alias("title_generation"),
        F.array_join(F.reverse(lines), "\n").alias("detailed_summary"),
        F.concat(F.lit("- "), F.replace(F.col("text"), F.lit("\n"), F.lit("\n- "))).alias("bullet_point_summary"),
    )


def nested_mrc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as contexts: the second line answers the first, the last one the one before it;
    the last line as a question has no answer.

    Spanish documents get a null list, one-line documents an empty one.
    """
    lines = F.split("text", "\n")
    qa = lambda q, a: F.struct(q.alias("question"), a.alias("answer"))
    follow = F.when(
        F.size(lines) > 1,
        F.array(
            qa(F.get(lines, F.lit(0)), F.get(lines, F.lit(1))),
            qa(F.try_element_at(lines, F.lit(-2)), F.element_at(lines, -1)),
        ),
    ).otherwise(F.array().cast("array<struct<question:string,answer:string>>"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("text").alias("context"),
        F.when(F.col("lang") != "es", follow).alias("factual_questions"),
        F.struct(F.element_at(lines, -1).alias("question"), F.lit(NO_ANSWER).alias("answer")).alias(
            "unanswerable_question"
        ),
    )


def choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in groups of five, the target being the (group % 5)-th of them."""
    group, place = F.floor(F.col("item_id") / 5).cast("long"), F.col("item_id") % 5
    candidate = lambda k: F.max(F.when(F.col("place") == k, F.col("text")))
    wanted = F.col("group_id") % 5
    return (
        table(spark, sf_dir, "benchmark")
        .select(group.alias("group_id"), place.alias("place"), "text")
        .groupBy("group_id")
        .agg(
            F.array(*[F.struct(candidate(k).alias("question")) for k in range(5)]).alias("inputs"),
            F.struct(F.max(F.when(F.col("place") == wanted, F.col("text"))).alias("formal")).alias("main_question"),
        )
        .withColumn("target", (F.col("group_id") % 5 + 1).cast("string"))
    )


def thesaurus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(word, syn)` from the words of all documents: each with its neighbours among those of the same first three letters."""
    said = F.explode(whitespace_tokens(F.lower(normalize_text("text"))))
    words = table(spark, sf_dir, "documents").select(said.alias("word")).distinct().where(F.length("word") > 3)
    alike = Window.partitionBy(F.left("word", F.lit(3))).orderBy("word")
    near = words.select("word", F.array(F.lag("word").over(alike), F.lead("word").over(alike)).alias("syns"))
    return near.select("word", F.explode("syns").alias("syn")).where(F.col("syn").isNotNull())


def subword_vocabularies() -> dict[str, tuple[Callable, Callable | None]]:
    """The given public vocabularies: a factory of encoders, and what cuts a text into independent words."""
    import public_tokenizers as given

    byte_file, word_file, piece_file = map(given.path, ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
    pattern = given.PATTERN

    def fast(path: str):
        def make():
            from tokenizers import Tokenizer

            vocabulary = Tokenizer.from_file(path)
            vocabulary.encode_special_tokens = True
            return lambda texts: [e.tokens for e in vocabulary.encode_batch(texts, add_special_tokens=False)]

        return make

    def pieces():
        import sentencepiece

        vocabulary = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        return lambda texts: vocabulary.encode(texts, out_type=str, num_threads=1)

    def byte_words(text: str) -> list[str]:
        import regex

        return regex.findall(pattern, text)

    return {"byte": (fast(byte_file), byte_words), "word": (fast(word_file), str.split), "piece": (pieces, None)}


#: Letters whose counts, with the length, are the vector of a token.
LETTERS = "aeiounst"


def make_letter_encoder():
    """An encoder that SQL can repeat: a token's length and how often it has certain letters."""

    def encode(texts: list[str]) -> list[np.ndarray]:
        known: dict[str, list[int]] = {}
        matrices = []
        for text in texts:
            rows = [known.setdefault(t, [len(t), *map(t.count, LETTERS)]) for t in text.split()]
            matrices.append(np.array(rows, dtype=np.float64).reshape(len(rows), len(LETTERS) + 1))
        return matrices

    return encode


VECTORS_PER_SIDE = 10


def token_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as token vectors: runs of twenty make one example, even ids predict, odd ids refer."""
    span = 2 * VECTORS_PER_SIDE
    place = F.col("vec_id") % span
    return table(spark, sf_dir, "embeddings").select(
        F.floor(F.col("vec_id") / span).cast("long").alias("id"),
        F.when(F.col("vec_id") % 2 == 0, "prediction").otherwise("reference").alias("side"),
        F.floor(place / 2).cast("int").alias("pos"),
        F.col("embedding").alias("vec"),
    )


def step_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as training steps: the user is the run, steps count from 1 by (ts, event_id)."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"), F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type", "value"
    )
    placed = ordered_positions(events, ["ts", "event_id"], ["run"], keep=("event_type", "value"))
    return placed.withColumn("step", F.col("pos") + 1).drop("pos")


def hardware_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Step events as resource samples; an error event has no device readings."""
    value = F.col("value")
    gpu = lambda k: F.struct(
        (value / k).alias("utilization"), (value * 1e9 / k).alias("allocated"), (value * 2e9 / k).alias("reserved")
    )
    return step_events(spark, sf_dir).select(
        "run",
        "step",
        value.alias("cpu_utilization"),
        (value * 1e8).alias("ram_used"),
        (value * 2e8).alias("ram_available"),
        F.when(F.col("event_type") != "error", F.array(gpu(1), gpu(2))).alias("gpus"),
        (value * 3e7).alias("disk_read"),
        (value * 4e7).alias("disk_write"),
    )
