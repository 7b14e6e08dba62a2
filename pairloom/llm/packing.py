"""Packing documents into token windows: concatenate and cut.

A first pass writes every document's token ids. The token totals of its
partitions, summed up, give each partition its place in the one long sequence,
and so each document its own. A second pass cuts the documents at multiples of
the window in place, without a shuffle. A window that spans partitions is made
of their boundary pieces, which carry its number and their offset in it;
`assemble` joins the pieces of each window. Only the last window is short.

Null and empty texts are the end id alone. Repeated rows are documents of their
own. Texts are encoded whole, word by word, which gives the ids of the whole
text because the vocabulary's rules never reach across white space. The order is
that of the input's partitions. An empty table gives no pieces.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.text import release, slices, split_words, texts
from pairloom.session import checkpointed

#: Parts of words whose ids a worker remembers; it then starts afresh.
_REMEMBERED = 800_000
#: Bytes of text that are encoded at a time.
_SLICE = 2 << 20


#: Letters and the ASCII punctuation behind them, without the apostrophe that begins a contraction: two parts whose
#: ids don't depend on each other, as the vocabulary's rules split words there and fold case letter by letter.
_PARTS = r"^(?P<head>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[!-&(-/:-@\[-`{-~]*)$"


class WordEncoder:
    """Token ids of texts, encoding each distinct part of a word once."""

    def __init__(self, path: str) -> None:
        # Tasks are what runs side by side; each thread of the library would keep memory of its own for a worker's life.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        marks = self.tokenizer.get_added_tokens_decoder()
        self.mark = next(((i, t.content) for i, t in sorted(marks.items()) if t.special), None)
        self.forget()

    def forget(self) -> None:
        self.parts: dict[str, int] = {"": 0}
        self.ids = np.zeros(1 << 20, dtype=np.uint32)
        self.ends = np.zeros(1 << 18, dtype=np.int64)  # of parts; the first is empty

    def _encoded(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts end to end, and how many each has."""
        encode = lambda some: [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        if self.mark is None or any(self.mark[1] in p for p in parts):
            lists = encode(parts)
            return np.array([i for own in lists for i in own], dtype=np.uint32), np.array([len(own) for own in lists])
        # Many parts at once, told apart by a special token.
        joined = [self.mark[1].join(["", *parts[i : i + 64]]) for i in range(0, len(parts), 64)]
        flat = np.array([i for own in encode(joined) for i in own], dtype=np.uint32)
        marks = np.flatnonzero(flat == self.mark[0])
        return np.delete(flat, marks), np.diff(np.append(marks, len(flat))) - 1

    def _numbers(self, column: pa.Array) -> np.ndarray:
        """Numbers of parts, those not met before encoded first."""
        encoded = column.dictionary_encode()
        distinct = encoded.dictionary.to_pylist()
        known = self.parts
        new = [p for p in distinct if p not in known]
        if new:
            ids, lengths = self._encoded(new)
            n = len(known)
            begin = int(self.ends[n - 1])
            if begin + len(ids) > len(self.ids):
                self.ids = np.resize(self.ids, max(begin + len(ids), 2 * len(self.ids)))
            if n + len(new) > len(self.ends):
                self.ends = np.resize(self.ends, max(n + len(new), 2 * len(self.ends)))
            self.ids[begin : begin + len(ids)] = ids
            self.ends[n : n + len(new)] = begin + np.cumsum(lengths)
            known.update(zip(new, range(n, n + len(new))))
        numbers = np.fromiter((known[p] for p in distinct), dtype=np.int64, count=len(distinct))
        return numbers[encoded.indices.to_numpy(zero_copy_only=False)]

    def encode(self, text: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by `end_id`, and how many each has."""
        words = split_words(text)
        if len(self.parts) > _REMEMBERED:
            self.forget()
        split = pc.extract_regex(words.distinct, _PARTS)
        whole = pc.is_null(split)
        head = pc.if_else(whole, words.distinct, pc.utf8_lower(pc.fill_null(pc.struct_field(split, 0), "")))
        tail = pc.fill_null(pc.struct_field(split, 1), "")
        part = np.stack([self._numbers(head), self._numbers(tail)], axis=1).ravel()
        # Ids of the distinct words end to end, then of the text by words.
        begin = np.where(part > 0, self.ends[part - 1], 0)
        lengths = self.ends[part] - begin
        reach = np.cumsum(lengths)
        flat = self.ids[_ranges(begin, lengths)]
        word_length = lengths.reshape(-1, 2).sum(axis=1)
        word_begin = np.append(0, reach)[np.arange(0, len(part) + 1, 2)][:-1]
        counts = word_length[words.codes]
        out = flat[_ranges(word_begin[words.codes], counts)]
        ends = np.append(0, np.cumsum(counts))[words.ends]
        return np.insert(out, ends, np.uint32(end_id)), np.diff(ends, prepend=0) + 1


def _ranges(begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each begin on, `lengths` of them, end to end."""
    reach = np.cumsum(lengths)
    return np.arange(reach[-1] if len(reach) else 0) + np.repeat(begin - reach + lengths, lengths)


@lru_cache(2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def tokenised(docs: DataFrame, path: str, end_id: int, key: str = "doc_id") -> DataFrame:
    """`(key, ids, n)`; ids as little-endian numbers of 32 bits, or of 16 where all fit."""
    kind = docs.schema[key].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        narrow = max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16

        def encoded(piece: pa.RecordBatch) -> pa.RecordBatch:
            ids, counts = encoder.encode(texts(piece), end_id)
            ids = ids.astype("<u2" if narrow else "<u4")
            ends = np.cumsum(counts) * ids.itemsize
            offsets = pa.py_buffer(np.append(0, ends).astype(np.int64))
            packed = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, offsets, pa.py_buffer(ids)])
            return pa.record_batch(
                [piece.column(key), packed.cast(pa.binary()), pa.array(counts, pa.int64())], names=[key, "ids", "n"]
            )

        yield from map(encoded, slices(batches, limit=_SLICE))
        encoder.forget()
        release()

    source = docs.select(key, F.col("text").cast("string").alias("text"))
    return source.mapInArrow(encode, f"`{key}` {kind}, ids binary, n bigint")


def pack_documents(docs: DataFrame, path: str, end_id: int = 1, window: int = 2048, key: str = "doc_id") -> DataFrame:
    """Pieces `(key, start, length, ids, doc_tokens, sequence_id, offset)`; ids in 32 bits each.

    Every id of every document is in one piece; pieces fill windows without gaps.
    """
    kind = docs.schema[key].dataType.simpleString()
    # The written ids pin the order: a lost task's rows are read again, not made again.
    held = checkpointed(tokenised(docs, path, end_id, key).withColumn("part", F.spark_partition_id()))
    # One number per partition of the input.
    totals = sorted((r["part"], r["n"]) for r in held.groupBy("part").agg(F.sum("n").alias("n")).collect())
    before = np.cumsum([0, *(n for _, n in totals)])
    shared = docs.sparkSession.sparkContext.broadcast({part: int(b) for (part, _), b in zip(totals, before)})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in slices(batches, "ids"):
            if at is None:
                at = shared.value[batch.column("part")[0].as_py()]
            counts = batch.column("n").to_numpy()
            begin = at + np.cumsum(counts) - counts
            at = int(begin[-1] + counts[-1])
            first, last = begin // window, (begin + counts - 1) // window
            pieces = (last - first + 1).astype(np.int64)
            row = np.repeat(np.arange(len(counts)), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = first[row] + nth
            start = np.maximum(sequence * window, begin[row])
            length = np.minimum((sequence + 1) * window, (begin + counts)[row]) - start
            packed = batch.column("ids").cast(pa.large_binary())
            raw = b"".join(packed.to_pylist())
            flat = np.frombuffer(raw, dtype="<u2" if len(raw) == 2 * counts.sum() else "<u4").astype("<u4")
            ends = np.append(0, np.cumsum(length) * 4)  # pieces follow each other as their documents do
            ids = pa.Array.from_buffers(
                pa.large_binary(), len(length), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat)]
            )
            yield pa.record_batch(
                [
                    batch.column(key).take(pa.array(row)),
                    pa.array(start - begin[row]),
                    pa.array(length),
                    ids.cast(pa.binary()),
                    pa.array(counts[row]),
                    pa.array(sequence),
                    pa.array(start - sequence * window),
                ],
                names=[key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    return held.mapInArrow(
        cut,
        f"`{key}` {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint",
    )


def assemble(pieces: DataFrame) -> DataFrame:
    """`(sequence_id, ids, n)`: whole windows, at most a window's tokens gathered for each."""

    @F.arrow_udf("binary")
    def joined(lists: pa.Array) -> pa.Array:
        return pa.array([b"".join(p["ids"] for p in own) for own in lists.to_pylist()], pa.binary())

    gathered = pieces.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("held"), F.sum("length").alias("n")
    )
    return gathered.select("sequence_id", joined("held").alias("ids"), "n")
