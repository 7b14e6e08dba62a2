"""Token lists, token counts and fixed-length blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.tokens import Tokenizer, whitespace_tokens
from pairloom.operators.ordered import partition_count, unlike
from pairloom.session import checkpointed

#: Tokens that a page holds at most, or one row.
PAGE_TOKENS = 1 << 18


def tokenize(df: DataFrame, column: str, tokenizer: Tokenizer = whitespace_tokens, out: str = "tokens") -> DataFrame:
    return df.withColumn(out, tokenizer(F.col(column)))


def count_tokens(
    df: DataFrame, column: str, by: str | list[str] | None = None, tokenizer: Tokenizer = whitespace_tokens
) -> DataFrame:
    """Total tokens, overall or per group, combined before the shuffle."""
    by = [by] if isinstance(by, str) else list(by or [])
    counted = df.select(*by, F.size(tokenizer(F.col(column))).cast("long").alias("n"))
    return counted.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_tokens"))


def _page_bytes(lists: pa.ListArray) -> bytes:
    """Token lists of some rows, each distinct token once, compressed."""
    encoded = lists.flatten().dictionary_encode()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    batch = pa.record_batch([pa.ListArray.from_arrays(offsets, encoded)], names=["tokens"])
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd" if pa.Codec.is_available("zstd") else "lz4")
    with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _page(data: bytes) -> tuple[pa.Array, np.ndarray]:
    """The tokens of a page end to end, and the number of tokens of each row."""
    lists = pa.ipc.open_stream(pa.BufferReader(data)).read_next_batch().column(0)
    tokens = lists.flatten().dictionary_decode().cast(pa.string())
    return tokens, pc.list_value_length(lists).to_numpy(zero_copy_only=False)


def _pages(order: list[str]):
    """A pass over sorted `order + tokens` that returns pages `(part, n, data)`; a repeated order is an error."""

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.select(order)
            if last is not None:
                keys = pa.Table.from_batches([last, keys]).combine_chunks().to_batches()[0]
            if keys.num_rows > 1 and not np.logical_or.reduce([unlike(keys.column(c)) for c in order]).all():
                raise ValueError("the order is not unique")
            last = batch.select(order).slice(batch.num_rows - 1)
            lists = batch.column("tokens")
            lists = lists.filter(pc.greater(pc.fill_null(pc.list_value_length(lists), 0), 0))
            ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)
            at = 0
            while at < len(ends):
                before = int(ends[at - 1]) if at else 0
                end = max(at + 1, int(np.searchsorted(ends, before + PAGE_TOKENS, side="right")))
                data = _page_bytes(lists.slice(at, end - at))
                yield pa.record_batch(
                    [pa.array([part], pa.int32()), pa.array([int(ends[end - 1]) - before], pa.int64()), pa.array([data], pa.binary())],
                    names=["part", "n", "data"],
                )
                at = end

    return pass_


def _cut(first: dict[int, int], max_len: int, whole: bool):
    """A pass over pages, in order, that cuts blocks of `max_len` tokens.

    `first` gives the place of each part's first token. With `whole` it returns the
    blocks that lie within a part, else the fragments of blocks at its two ends.
    """

    def rows(blocks: list[int], begins: list[int], sizes: list[int], tokens: pa.Array, docs: list[int]) -> pa.RecordBatch:
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        return pa.record_batch(
            [
                pa.array(blocks, pa.int64()),
                pa.array(begins, pa.int64()),
                pa.ListArray.from_arrays(offsets, tokens),
                pa.array(docs, pa.int32()),
            ],
            names=["block_id", "begin", "tokens", "n_docs"],
        )

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seen = None, 0
        tokens, owner = pa.array([], pa.string()), np.zeros(0, dtype=np.int64)  # held back, from `at` on
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("data")):
                if at is None:
                    at = first[part]
                own, sizes = _page(data.as_py())
                tokens = pa.concat_arrays([tokens, own])
                owner = np.concatenate([owner, seen + np.repeat(np.arange(len(sizes)), sizes)])
                seen += len(sizes)
                stop = at + len(tokens)
                cuts = np.arange(-(-at // max_len), stop // max_len + 1) * max_len
                if not len(cuts):
                    continue
                head = int(cuts[0]) - at
                if head and not whole:
                    yield rows([at // max_len], [at], [head], tokens.slice(0, head), [int(owner[head - 1] - owner[0]) + 1])
                if len(cuts) > 1 and whole:
                    starts = cuts[:-1] - at
                    docs = owner[starts + max_len - 1] - owner[starts] + 1
                    body = tokens.slice(head, int(cuts[-1] - cuts[0]))
                    yield rows((cuts[:-1] // max_len).tolist(), cuts[:-1].tolist(), [max_len] * len(starts), body, docs.tolist())
                rest = int(cuts[-1]) - at
                at, tokens, owner = int(cuts[-1]), tokens.slice(rest), owner[rest:]
        if at is not None and len(tokens) and not whole:
            yield rows([at // max_len], [at], [len(tokens)], tokens, [int(owner[-1] - owner[0]) + 1])

    return pass_


def pack_sequences(
    df: DataFrame,
    order: str | list[str],
    max_len: int,
    drop_last: bool = True,
    tokens: str = "tokens",
    text: str | None = None,
    tokenizer: Tokenizer = whitespace_tokens,
    parts: int | None = None,
) -> DataFrame:
    """Concatenate token lists in `order` and cut blocks of `max_len` tokens.

    Returns `(block_id, tokens, n_docs, n_tokens)`. Rows are shuffled once, into
    range partitions of the whole order. There they are tokenised, once, into
    checkpointed pages; a partition's first place is the sum of the pages before it,
    one number per partition. Blocks that lie within a partition are cut where they
    are. Only the fragments at its two ends, less than a block each, are shuffled
    to meet their other parts. `order` must be unique and without nulls.

    Name a `text` column instead of `tokens` to have it tokenised after the shuffle:
    a text is several times smaller than its list. A row without tokens is in no block.
    """
    if max_len < 1:
        raise ValueError("max_len must be positive")
    order = [order] if isinstance(order, str) else list(order)
    missing = F.lit(False)
    for c in order:
        missing = missing | F.col(c).isNull()
    checked = F.when(missing, F.raise_error(F.lit("null in an order column"))).otherwise(F.col(text or tokens))
    keys = [f"__o{i}" for i in range(len(order))]
    listed = df.select(*[F.col(c).alias(k) for c, k in zip(order, keys)], checked.alias("held"))
    ranged = listed.repartitionByRange(partition_count(df, parts), *keys).sortWithinPartitions(*keys)
    held = (tokenizer(F.col("held")) if text else F.col("held")).cast("array<string>")
    paged = ranged.select(*keys, held.alias("tokens")).mapInArrow(_pages(keys), "part int, n bigint, data binary")
    # Range bounds come from a sample: checkpoint, so that all passes see the same ones.
    pages = checkpointed(paged)
    first, at = {}, 0
    for r in sorted(pages.groupBy("part").agg(F.sum("n").alias("n")).collect()):
        first[r["part"]], at = at, at + r["n"]
    shape = "block_id bigint, begin bigint, tokens array<string>, n_docs int"
    held_pages = pages.select("part", "data")
    within = held_pages.mapInArrow(_cut(first, max_len, True), shape).select("block_id", "tokens", "n_docs")
    joined = (
        held_pages.mapInArrow(_cut(first, max_len, False), shape)
        .groupBy("block_id")
        .agg(F.array_sort(F.collect_list(F.struct("begin", "tokens"))).alias("pieces"), F.sum("n_docs").cast("int").alias("n_docs"))
        .select("block_id", F.flatten(F.transform("pieces", lambda p: p["tokens"])).alias("tokens"), "n_docs")
    )
    blocks = within.unionByName(joined).withColumn("n_tokens", F.size("tokens"))
    return blocks.where(F.col("n_tokens") == max_len) if drop_last else blocks
