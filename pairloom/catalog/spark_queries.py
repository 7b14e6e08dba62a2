"""The registered queries: operators applied to the derived inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.catalog import inputs as src
from pairloom.functions.pair_stats import OVERLAPS
from pairloom.functions.text import normalize_text, strip
from pairloom.functions.tokens import vocabulary_tokenizer
from pairloom.operators import chat, metrics, pairing, prompts, report, telemetry, tokens
from pairloom.operators.filters import drop_incomplete, drop_marked
from pairloom.operators.generate import batch_generate
from pairloom.operators.reshape import flatten_qa, unpivot_targets
from pairloom.operators.soft_align import bert_score_pairs, soft_alignment
from pairloom.operators.split import train_test_split
from pairloom.plans import datasets, jobs
from pairloom.session import scratch_path
from pairloom.sources import tables as io
from pairloom.streaming.throughput import run_to_parquet, running_throughput_stream, throughput_stream

TEXT_METRICS = ("exact_match", "f1_score", "bleu", "rouge", "meteor")
SYSTEM = "Answer briefly."
EVERY, BATCH, MAX_LEN, ACCUM, WORLD = 5, 2, 8192, 8, 3
BLOCK = 512
WINDOW, DELAY, TOKENS_PER_STEP = "6 hours", "1 hour", 49_152


def r6(c: Column) -> Column:
    return F.round(c, 6)


def _featured(spark: SparkSession, sf_dir: str, *features: str) -> DataFrame:
    pairs = pairing.normalize_pairs(src.eval_pairs(spark, sf_dir))
    return metrics.with_features(pairs, frozenset(features))


def _scores(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    chosen = metrics.metric(name)
    columns = {
        (name if part == metrics.SCORE else part.replace("-", "_")): score for part, score in chosen.scores().items()
    }
    return _featured(spark, sf_dir, *chosen.features).select("id", *[r6(c).alias(n) for n, c in columns.items()])


def q_normalize_text(spark, sf_dir):
    return src.table(spark, sf_dir, "documents").select(
        "doc_id", normalize_text("text").alias("normalized"), strip("text").alias("stripped")
    )


def q_exact_match(spark, sf_dir):
    return _scores(spark, sf_dir, "exact_match")


def q_token_f1(spark, sf_dir):
    return _scores(spark, sf_dir, "f1_score")


def q_bleu(spark, sf_dir):
    return _scores(spark, sf_dir, "bleu")


def q_rouge(spark, sf_dir):
    return _scores(spark, sf_dir, "rouge")


def q_meteor(spark, sf_dir):
    return _scores(spark, sf_dir, "meteor")


def q_ngram_overlap(spark, sf_dir):
    return _featured(spark, sf_dir, *OVERLAPS).select("id", "n_pred", "n_ref", "stats.*")


def q_soft_alignment(spark, sf_dir):
    soft = soft_alignment(src.token_vectors(spark, sf_dir))
    return soft.select("id", *[r6(F.col(c)).alias(c) for c in ("precision", "recall", "f1")])


def q_eval_report(spark, sf_dir):
    found = report.evaluate(src.eval_pairs(spark, sf_dir), TEXT_METRICS)
    return found.select("metric", "sub_metric", r6(F.col("score")).alias("score"), "n")


def q_score_examples(spark, sf_dir):
    found = report.score_examples(src.eval_pairs(spark, sf_dir), TEXT_METRICS)
    return found.select("id", "metric", "sub_metric", r6(F.col("score")).alias("score"))


def q_bert_score_texts(spark, sf_dir):
    """Soft alignment from texts: encoded and compared where the pairs are."""
    soft = bert_score_pairs(src.eval_pairs(spark, sf_dir), src.make_letter_encoder)
    return soft.select("id", *[r6(F.col(c)).alias(c) for c in ("precision", "recall", "f1")])


def q_mrc_report(spark, sf_dir):
    """The preset of a task, with soft alignment from the texts."""
    items = src.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("targets"))
    pairs = src.with_prediction(items)
    found = report.evaluate(pairs, metrics.metrics_for("mrc"), encoder=src.make_letter_encoder)
    return found.select("metric", "sub_metric", r6(F.col("score")).alias("score"), "n")


def plural_stem(word: str) -> str:
    """A stand-in stemmer: a last `s` goes."""
    return word[:-1] if len(word) > 3 and word.endswith("s") else word


def q_meteor_stem_synonyms(spark, sf_dir):
    """Questions against answers, by exact words, stems and a thesaurus of the documents' words."""
    pairs = src.training_pairs(spark, sf_dir).select(
        "id", F.col("inputs").alias("prediction"), F.col("targets").alias("reference")
    )
    featured = metrics.with_features(
        pairing.normalize_pairs(pairs), frozenset({"aligned"}), stem=plural_stem, synonyms=src.thesaurus(spark, sf_dir)
    )
    score = metrics.metric("meteor").scores()[metrics.SCORE]
    counts = [F.col(f"stats.{c}").cast("long").alias(c) for c in ("matches", "chunks")]
    return featured.select("id", *counts, r6(score).alias("meteor"))


def q_rouge_documents(spark, sf_dir):
    """Whole documents against their lines in reverse: pairs of any length."""
    wide = src.wide_summaries(spark, sf_dir)
    pairs = wide.select("doc_id", F.col("context").alias("prediction"), F.col("detailed_summary").alias("reference"))
    featured = metrics.with_features(pairs, metrics.metric("rouge").features)
    scores = {part.replace("-", "_"): score for part, score in metrics.metric("rouge").scores().items()}
    return featured.select("doc_id", "n_pred", "n_ref", *[r6(c).alias(n) for n, c in scores.items()])


def q_pair_by_key(spark, sf_dir):
    """All documents against all labels: only labelled documents pair up."""
    predictions = src.table(spark, sf_dir, "documents")
    references = src.table(spark, sf_dir, "labels").withColumn(
        "reference", F.when(F.col("quality") == 1, "good").otherwise("poor")
    )
    return pairing.pair(predictions, references, "doc_id", "text", "reference")


def q_unmatched(spark, sf_dir):
    return pairing.unmatched(
        src.table(spark, sf_dir, "documents"), src.table(spark, sf_dir, "labels"), "doc_id"
    )


def q_pair_by_position(spark, sf_dir):
    """All user turns against all assistant turns, by position; the sides differ in length."""
    turns = src.table(spark, sf_dir, "conversations")
    asked = turns.where(F.col("role") == "user").withColumnRenamed("text", "prediction")
    answered = turns.where(F.col("role") == "assistant").withColumnRenamed("text", "reference")
    return pairing.pair_by_position(asked, answered, order_by=["conv_id", "turn"])


def q_ensure_system(spark, sf_dir):
    full = src.messages(spark, sf_dir).select("id", chat.ensure_system("messages", SYSTEM).alias("m"))
    return full.select(
        "id",
        F.array_join(F.transform("m", lambda m: m["role"]), ",").alias("roles"),
        F.element_at("m", 1)["content"].alias("first_content"),
    )


def q_ensure_system_turns(spark, sf_dir):
    return chat.ensure_system_turns(src.table(spark, sf_dir, "conversations"), SYSTEM)


def q_render_messages(spark, sf_dir):
    full = src.messages(spark, sf_dir).select("id", chat.ensure_system("messages", SYSTEM).alias("m"))
    return full.select("id", chat.render_messages("m").alias("prompt"))


def q_render_chat(spark, sf_dir):
    return chat.render_chat(src.training_pairs(spark, sf_dir), chat.CHATML, SYSTEM)


def q_render_chat_headers(spark, sf_dir):
    return chat.render_chat(src.training_pairs(spark, sf_dir), chat.HEADERS, None).select("id", "prompt")


def q_generation_prompt(spark, sf_dir):
    return chat.render_generation_prompt(src.training_pairs(spark, sf_dir), chat.CHATML, SYSTEM).select("id", "prompt")


def q_split_response(spark, sf_dir):
    chats = chat.render_chat(src.training_pairs(spark, sf_dir), chat.CHATML, None)
    return chat.split_responses(chats.select("id", "prompt"), "prompt")


def q_split_response_tagged(spark, sf_dir):
    chats = chat.render_chat(src.training_pairs(spark, sf_dir), chat.CHATML, SYSTEM)
    return chat.split_responses(chats.select("id", "prompt"), "prompt", mode="tagged")


def q_drop_marked(spark, sf_dir):
    return drop_marked(src.table(spark, sf_dir, "documents"), "text").select("doc_id", "lang", "n_chars")


def q_drop_incomplete(spark, sf_dir):
    return drop_incomplete(src.wide_summaries(spark, sf_dir))


def q_training_pairs(spark, sf_dir):
    return src.training_pairs(spark, sf_dir)


def q_unpivot_targets(spark, sf_dir):
    return unpivot_targets(src.wide_summaries(spark, sf_dir).drop("context"), ["doc_id"])


def q_flatten_qa(spark, sf_dir):
    flat = flatten_qa(src.nested_mrc(spark, sf_dir), keep=("doc_id",))
    return flat.select("doc_id", F.col("question_no").cast("long").alias("question_no"), "question", "answer")


def q_summary_pairs(spark, sf_dir):
    return datasets.summary_pairs(src.wide_summaries(spark, sf_dir), layout="wide", keep=("doc_id",))


def q_summary_pairs_complete(spark, sf_dir):
    """Layout found by its column list; rows without a summary left out."""
    return datasets.summary_pairs(src.wide_summaries(spark, sf_dir).drop("doc_id"), drop_nulls=True)


def q_choice_pairs(spark, sf_dir):
    return datasets.choice_pairs(src.choices(spark, sf_dir), keep=("group_id",))


def q_mrc_pairs(spark, sf_dir):
    return datasets.mrc_pairs(src.nested_mrc(spark, sf_dir), layout="wide", keep=("doc_id",)).select(
        "doc_id", F.col("question_no").cast("long").alias("question_no"), "inputs", "targets"
    )


def q_mrc_prompts_flat(spark, sf_dir):
    """The flat layout: every training pair as question and answer over its own text."""
    flat = src.training_pairs(spark, sf_dir).select(
        F.col("inputs").alias("context"), F.col("targets").alias("question"), F.col("id").cast("string").alias("answer")
    )
    return datasets.mrc_pairs(flat)


def q_split_exact(spark, sf_dir):
    documents = src.table(spark, sf_dir, "documents")
    return train_test_split(documents, "doc_id", 0.2, seed=7, mode="exact").select("doc_id", "split")


def q_split_exact_repeats(spark, sf_dir):
    """Rows that share a key are cut where the wanted number is reached."""
    documents = src.table(spark, sf_dir, "documents").select("doc_id", "source")
    cut = train_test_split(documents, "source", 0.2, seed=7, mode="exact")
    return cut.groupBy("source", "split").agg(F.count("*").alias("n_rows"))


def q_split_threshold(spark, sf_dir):
    turns = src.table(spark, sf_dir, "conversations")
    return train_test_split(turns, ["conv_id", "turn"], 0.1, seed=7).select("conv_id", "turn", "split")


def q_tokenize(spark, sf_dir):
    split = tokens.tokenize(src.table(spark, sf_dir, "conversations"), "text")
    return split.select(
        "conv_id", "turn", F.size("tokens").cast("long").alias("n_tokens"), F.array_join("tokens", "|").alias("tokens")
    )


def q_tokenize_subwords(spark, sf_dir):
    """Turns in the tokens of three public vocabularies: how many, and a checksum of them."""
    split = src.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    for name, (make_encode, words) in src.subword_vocabularies().items():
        split = tokens.tokenize(split, "text", vocabulary_tokenizer(make_encode, words), name)
    told = lambda n: [F.size(n).cast("long").alias(f"n_{n}"), F.crc32(F.array_join(n, " ").cast("binary")).alias(f"{n}_crc32")]
    return split.select("conv_id", "turn", *(c for n in ("byte", "word", "piece") for c in told(n)))


def q_count_tokens(spark, sf_dir):
    return tokens.count_tokens(src.table(spark, sf_dir, "documents"), "text", "lang")


def q_count_tokens_total(spark, sf_dir):
    return tokens.count_tokens(src.table(spark, sf_dir, "documents"), "text")


def _packed(spark, sf_dir, drop_last):
    turns = src.table(spark, sf_dir, "conversations")
    blocks = tokens.pack_sequences(turns, ["conv_id", "turn"], BLOCK, drop_last, text="text")
    return blocks.select(
        "block_id",
        F.array_join("tokens", " ").alias("tokens"),
        F.col("n_docs").cast("long").alias("n_docs"),
        F.col("n_tokens").cast("long").alias("n_tokens"),
    )


def q_pack_sequences(spark, sf_dir):
    return _packed(spark, sf_dir, True)


def q_pack_sequences_tail(spark, sf_dir):
    return _packed(spark, sf_dir, False)


def make_echo():
    """A stand-in predictor: the prompt, then how long it was."""
    return lambda prompts, **sampling: [f"{p}{len(p)} at {sampling['temperature']}" for p in prompts]


def make_half():
    """A stand-in predictor: the prompt and then every second word of its question, as an answer."""
    return lambda prompts: [p + " ".join(p.split("\n", 1)[1].rsplit("<|im_end|>", 1)[0].split()[::2]) for p in prompts]


def q_batch_generate(spark, sf_dir):
    prompts_in = chat.render_generation_prompt(src.training_pairs(spark, sf_dir), chat.CHATML, SYSTEM)
    generated = batch_generate(prompts_in.select("id", "prompt"), "prompt", make_echo, temperature=0.5)
    return generated.select("id", "generated_text")


def q_generate_responses(spark, sf_dir):
    replies = jobs.generate_responses(
        src.training_pairs(spark, sf_dir).select("id", "inputs"), make_echo, system=None, temperature=0.5
    )
    return replies.select("id", "user", "assistant")


def q_throughput(spark, sf_dir):
    series = telemetry.throughput(src.step_events(spark, sf_dir), EVERY, BATCH, MAX_LEN, ACCUM, WORLD)
    return series.select("run", "step", *[r6(F.col(c)).alias(c) for c in ("throughput", "elapsed_time")])


def q_throughput_gaps(spark, sf_dir):
    """Runs whose failed steps were never logged."""
    steps = src.step_events(spark, sf_dir).where(F.col("event_type") != "error")
    series = telemetry.throughput(steps, EVERY, BATCH, MAX_LEN, ACCUM, WORLD)
    return series.select("run", "step", *[r6(F.col(c)).alias(c) for c in ("throughput", "elapsed_time")])


def q_throughput_actual(spark, sf_dir):
    """Tokens from a column instead of the nominal count."""
    steps = src.step_events(spark, sf_dir).withColumn("tokens", F.floor(F.col("value") * 100).cast("long"))
    series = telemetry.throughput(steps, EVERY, BATCH, MAX_LEN, tokens="tokens")
    return series.select("run", "step", *[r6(F.col(c)).alias(c) for c in ("throughput", "elapsed_time")])


def q_epoch_throughput(spark, sf_dir):
    steps = src.step_events(spark, sf_dir).withColumn("epoch", F.dayofmonth("ts").cast("long"))
    series = telemetry.epoch_throughput(steps, EVERY, BATCH, MAX_LEN, ACCUM, WORLD)
    return series.select("run", "epoch", "step", *[r6(F.col(c)).alias(c) for c in ("throughput", "elapsed_time")])


def q_sample_metrics(spark, sf_dir):
    series = telemetry.sample_metrics(src.hardware_samples(spark, sf_dir), EVERY)
    return series.select("run", "step", "metric", r6(F.col("value")).alias("value"))


def _rates(frame: DataFrame) -> DataFrame:
    epoch_second = lambda c: F.unix_timestamp(c).alias(c)
    return frame.select(
        "run",
        epoch_second("window_start"),
        "steps",
        r6(telemetry.seconds_between(F.col("first_ts"), F.col("last_ts"))).alias("span"),
        r6(F.col("tokens_per_second")).alias("tokens_per_second"),
    )


def q_throughput_windows(spark, sf_dir):
    """The windowed rate over the whole table."""
    events = src.table(spark, sf_dir, "events").withColumnRenamed("user_id", "run")
    return _rates(throughput_stream(events, TOKENS_PER_STEP, WINDOW, DELAY))


def q_throughput_stream(spark, sf_dir):
    """The same as a stream: windows the final watermark has closed."""
    schema = src.table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    rates = throughput_stream(stream.withColumnRenamed("user_id", "run"), TOKENS_PER_STEP, WINDOW, DELAY)
    out = scratch_path(spark, "rates")
    run_to_parquet(rates, out, scratch_path(spark, "rates-checkpoint"))
    return _rates(spark.read.parquet(out))


def q_throughput_running(spark, sf_dir):
    """Cumulative rates while runs go on: steps that the final watermark has passed."""
    path = scratch_path(spark, "steps")
    steps = src.step_events(spark, sf_dir).select("run", "step", "ts")
    steps.write.parquet(path)
    stream = spark.readStream.schema(steps.schema).parquet(path)
    rates = running_throughput_stream(stream, EVERY, BATCH * MAX_LEN * ACCUM * WORLD, DELAY)
    out = scratch_path(spark, "running")
    run_to_parquet(rates, out, scratch_path(spark, "running-checkpoint"))
    return spark.read.parquet(out).select("run", "step", *[r6(F.col(c)).alias(c) for c in ("throughput", "elapsed_time")])


def q_csv_round_trip(spark, sf_dir):
    """Multi-line texts with quotes through CSV."""
    path = scratch_path(spark, "pairs-csv")
    io.write_responses_csv(src.training_pairs(spark, sf_dir), path)
    back = io.read_pairs_csv(spark, path, ["id", "inputs", "targets"], na_values=())
    return back.withColumn("id", F.col("id").cast("long"))


def q_jsonl_dir(spark, sf_dir):
    """Documents written as JSON Lines, null summaries included; reading drops those rows."""
    path = scratch_path(spark, "docs-jsonl")
    wide = src.wide_summaries(spark, sf_dir).select("doc_id", "one_line_summary", "title_generation")
    wide.write.option("ignoreNullFields", False).json(path)
    return io.read_jsonl_dir(spark, path, wide.schema, pattern="*.json")


def q_jsonl_union(spark, sf_dir):
    """Files whose columns and types differ, and a folder beside them that isn't read, as one frame."""
    path = scratch_path(spark, "docs-union")
    docs = src.table(spark, sf_dir, "documents")
    named = docs.select("doc_id", F.col("n_chars").alias("size"), "lang", F.col("source").alias("origin"))
    halves = named.withColumn("size", F.col("size") + 0.5)
    io.write_jsonl_files(named.where("lang = 'en'"), path, "english")
    io.write_jsonl_files(halves.where("lang = 'fr'").withColumn("origin", F.length("origin")), path, "french")
    io.write_jsonl_files(named.where("lang = 'de'").withColumn("origin", F.lit(None).cast("string")), path, "nowhere")
    io.write_jsonl_files(named.where("lang = 'es'").drop("origin"), path, "spanish")
    io.write_jsonl_files(named, f"{path}/deeper", "again")
    return io.read_jsonl_dir(spark, path).select("doc_id", "size", "lang", "origin")


def q_infer_then_evaluate(spark, sf_dir):
    """Prompts in four unequal files through generation and evaluation, by key and by position."""
    pairs = src.training_pairs(spark, sf_dir)
    data = scratch_path(spark, "prompts")
    part = F.when(F.col("id") % 10 < 7, 0).when(F.col("id") % 10 < 9, 1).otherwise(2 + F.col("id") % 2)
    spread = pairs.withColumn("part", part).repartitionByRange(4, "part").sortWithinPartitions("part", "id").drop("part")
    io.write_responses_csv(spread, data)
    found = []
    for way, key in (("key", "id"), ("position", None)):
        out = scratch_path(spark, f"replies-{way}")
        jobs.infer(spark, data, out, "inputs", make_half, key=key, system=None, split_mode="tagged")
        means = jobs.evaluate_files(spark, data, out, "inputs", "assistant", ("f1_score", "exact_match"), on=key)
        found.append(means.select(F.lit(way).alias("way"), "metric", r6(F.col("score")).alias("score"), "n"))
    return found[0].unionByName(found[1])


def q_registered_metric(spark, sf_dir):
    """A metric of the caller's own, of two named scores, beside a built-in one."""

    def lengths(prediction: Column, reference: Column) -> dict[str, Column]:
        sides = (F.length(prediction), F.length(reference))
        return {"ratio": F.least(*sides) / F.greatest(F.lit(1), *sides), "longer": (sides[0] > sides[1]).cast("double")}

    metrics.register_metric("lengths", lengths)
    found = report.score_examples(src.eval_pairs(spark, sf_dir), ("lengths", "exact_match"))
    return found.select("id", "metric", "sub_metric", r6(F.col("score")).alias("score"))


def q_splits_round_trip(spark, sf_dir):
    """Rendered chats, split, written as JSON Lines and loaded again."""
    path = scratch_path(spark, "splits")
    chats = chat.render_chat(src.training_pairs(spark, sf_dir), chat.CHATML, SYSTEM)
    io.write_splits_jsonl(train_test_split(chats, "id", 0.2, seed=7), path)
    train, test = io.load_splits(spark, path, chats.schema)
    named = lambda df, name: df.select("id", "prompt", F.lit(name).alias("split"))
    return named(train, "train").unionByName(named(test, "test"))


def q_scores_round_trip(spark, sf_dir):
    """Per-example scores through Parquet, then their averages through JSON."""
    scores, averages = scratch_path(spark, "scores"), scratch_path(spark, "report")
    io.write_scores(report.score_examples(src.eval_pairs(spark, sf_dir), ("exact_match", "f1_score")), scores)
    means = report.average(spark.read.parquet(scores))
    io.write_report(means, averages)
    back = spark.read.schema("metric string, sub_metric string, score double, n long").json(averages)
    return back.select("metric", "sub_metric", r6(F.col("score")).alias("score"), "n")


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}
