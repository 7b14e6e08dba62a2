"""The file-to-file jobs: preprocess, generate, evaluate, pack."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.constants import SYSTEM_MESSAGE
from pairloom.functions.tokens import Tokenizer, whitespace_tokens
from pairloom.operators.chat import CHATML, ChatFormat, render_chat, render_generation_prompt, split_responses
from pairloom.operators.generate import Predictor, batch_generate
from pairloom.operators.ordered import file_positions
from pairloom.operators.pairing import pair, pair_by_position, several_files, unmatched
from pairloom.operators.report import average, evaluate, listed_scores, score_texts
from pairloom.operators.split import train_test_split
from pairloom.operators.tokens import pack_sequences
from pairloom.session import checkpointed
from pairloom.sources.tables import (
    load_splits,
    read_pairs_csv,
    write_blocks,
    write_report,
    write_responses_csv,
    write_scores,
    write_splits_jsonl,
)


def preprocess(
    spark: SparkSession,
    input_path: str,
    save_path: str,
    fmt: ChatFormat = CHATML,
    system: str | None = SYSTEM_MESSAGE,
    test_size: float | int | None = None,
    key: str | list[str] = ("inputs", "targets"),
    seed: int = 42,
    mode: str = "threshold",
    id_column: str = "id",
) -> None:
    """CSV pairs to rendered chats, as train and test JSON Lines.

    Rows keep their `id_column`, a whole number, or are numbered as they are read,
    so that packing has an order.
    """
    pairs = read_pairs_csv(spark, input_path)
    numbered = F.col(id_column).cast("long") if id_column in pairs.columns else F.monotonically_increasing_id()
    chats = render_chat(pairs.withColumn(id_column, numbered), fmt, system)
    keys = [key] if isinstance(key, str) else list(key)
    write_splits_jsonl(train_test_split(chats, keys, test_size, seed, mode), save_path)


def generate_responses(
    df: DataFrame,
    make_predictor: Callable[[], Predictor],
    prompt_column: str = "inputs",
    fmt: ChatFormat = CHATML,
    system: str | None = SYSTEM_MESSAGE,
    split_mode: str = "strict",
    batch_size: int = 16,
    partitions: int | None = None,
    **sampling,
) -> DataFrame:
    """Prompts to `user` and `assistant`; key columns of the input are carried."""
    prompts = render_generation_prompt(df, fmt, system, inputs=prompt_column)
    generated = batch_generate(prompts, "prompt", make_predictor, batch_size, partitions=partitions, **sampling)
    return split_responses(generated.drop("prompt"), "generated_text", split_mode, fmt)


def infer(
    spark: SparkSession,
    data_path: str,
    output_path: str,
    prompt_column: str,
    make_predictor,
    key: str | list[str] | None = None,
    **options,
) -> None:
    """CSV prompts to CSV responses, with the `key` columns that evaluation joins or orders by.

    Without a key a response is known by its place alone. Prompts of several files are
    then ordered by file and line before generation, so that the files written, by
    name, hold the responses in the order of the prompts.
    """
    keys = [key] if isinstance(key, str) else list(key or [])
    texts = read_pairs_csv(spark, data_path, [*keys, prompt_column])
    if not keys and several_files(texts):
        parts = options.pop("partitions", None) or int(spark.conf.get("spark.sql.shuffle.partitions"))
        placed = file_positions(texts)
        texts = placed.repartitionByRange(parts, "pos").sortWithinPartitions("pos").drop("pos")
    replies = generate_responses(texts, make_predictor, prompt_column, **options)
    write_responses_csv(replies.select(*keys, "user", "assistant"), output_path)


def evaluate_files(
    spark: SparkSession,
    data_path: str,
    pred_path: str,
    target_column: str,
    predict_column: str,
    metrics: Sequence[str],
    output_path: str | None = None,
    on: str | None = None,
    order_by: str | list[str] | None = None,
    **options,
) -> DataFrame:
    """Two CSV files to average scores.

    With `on`, rows meet by key. Without it they meet by position, in the order of
    `order_by` (as text) or of files and lines, and the average divides by the number
    of predictions. With a key and an output path the unmatched rows are written;
    without a path they are an error. `encoder` is a factory that scores soft
    alignment from the texts. The output has `texts` (both texts and all scores of
    an example), `examples` (a row per score) and `averages`.
    """
    keep = [on] if on else [order_by] if isinstance(order_by, str) else list(order_by or [])
    predictions = read_pairs_csv(spark, pred_path, [*keep, predict_column])
    references = read_pairs_csv(spark, data_path, [*keep, target_column])
    if on:
        pairs = pair(predictions, references, on, predict_column, target_column)
        n_predictions = None
    else:
        pairs = checkpointed(pair_by_position(predictions, references, predict_column, target_column, order_by))
        n_predictions = predictions.count()
    if not output_path:
        lone = {r["side"]: r["n_unmatched"] for r in unmatched(predictions, references, on).collect()} if on else {}
        if any(lone.values()):
            raise ValueError(f"rows without a partner: {lone}; give an output path to have them counted there")
        return evaluate(pairs, metrics, n_predictions=n_predictions, **options)
    # Scored once: the other tables are taken from the first, which has the texts beside their scores.
    write_scores(score_texts(pairs, metrics, **options), f"{output_path}/texts")
    write_scores(listed_scores(spark.read.parquet(f"{output_path}/texts")), f"{output_path}/examples")
    report = average(spark.read.parquet(f"{output_path}/examples"), n_predictions)
    write_report(report, f"{output_path}/averages")
    if on:
        write_report(unmatched(predictions, references, on), f"{output_path}/unmatched")
    return report


def pack_training_blocks(
    spark: SparkSession,
    dataset_path: str,
    output_path: str,
    max_len: int,
    tokenizer: Tokenizer = whitespace_tokens,
    order: str | list[str] = "id",
    schema=None,
    drop_last: bool = True,
) -> None:
    """Train and test JSON Lines to packed token blocks."""
    for name, part in zip(("train", "test"), load_splits(spark, dataset_path, schema)):
        blocks = pack_sequences(part, order, max_len, drop_last, text="prompt", tokenizer=tokenizer)
        write_blocks(blocks, f"{output_path}/{name}")
