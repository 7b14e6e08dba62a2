"""Words of Arrow text columns, and the id folds and slices the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of text that a task works on at a time; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20

_PRIME_A, _PRIME_B = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def release() -> None:
    """Give freed memory back: workers live on after a task, and the next one may be of another operator."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library alone
    if trim is not None:
        trim(0)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def texts(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """A text column with null as the empty text."""
    return pc.fill_null(batch.column(column).cast(pa.string()), "")


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most `limit` bytes of text, or one text."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = int(sizes[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, before + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end
    release()


@dataclass
class Words:
    """Words of a slice of texts: `codes` number the `distinct` words, text after text."""

    counts: np.ndarray
    codes: np.ndarray
    distinct: pa.Array

    @property
    def ends(self) -> np.ndarray:
        return np.cumsum(self.counts)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per distinct word."""
        digest = xxhash.xxh3_64_intdigest
        words = self.distinct.cast(pa.binary()).to_pylist()
        return np.fromiter((digest(w) for w in words), dtype=np.uint64, count=len(words))


def split_words(text: pa.Array, lower: bool = False) -> Words:
    """Runs of anything but the six ASCII white-space characters, A-Z folded on request."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text) if lower else text)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    encoded = lists.flatten().dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    empty = pc.index(encoded.dictionary, pa.scalar("", encoded.dictionary.type)).as_py()
    if empty >= 0:
        real = codes != empty
        counts = np.bincount(np.repeat(np.arange(len(counts)), counts)[real], minlength=len(counts))
        codes = codes[real]
    return Words(counts, codes, encoded.dictionary)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(32))) * _PRIME_A
    h = (h ^ (h >> np.uint64(29))) * _PRIME_B
    return h ^ (h >> np.uint64(32))
