"""Tokenisers: functions from a text column to an array<string> column."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

Tokenizer = Callable[[Column], Column]
#: From texts to the tokens of each.
Encode = Callable[[list[str]], list[list[str]]]

#: Characters of text that a vocabulary works on at a time; a longer text is a batch of its own.
BATCH_CHARS = 1 << 20

# The same 29 characters as WHITESPACE. Java scans its own Unicode class several
# times faster than a class that spells them out.
_WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def whitespace_tokens(c: Column) -> Column:
    """Split at runs of Unicode whitespace, no empty tokens; null text has no tokens."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), _WHITESPACE_RUN), "")


def python_tokenizer(encode: Callable[[str], list[str]]) -> Tokenizer:
    """Wrap a plain `str -> list[str]` function (a subword vocabulary, say) as a column tokeniser."""

    @F.pandas_udf("array<string>")
    def tokens(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [] if t is None else list(encode(t)))

    return lambda c: tokens(c)


def _encoded(texts: pa.Array, encode: Encode, split: Callable[[str], list[str]] | None) -> pa.ListArray:
    """Token lists of `texts`; each distinct text, or distinct word that `split` cuts, is encoded once."""
    pieces = [split(t) for t in texts.to_pylist()] if split else None
    flat = pa.array([w for own in pieces for w in own], pa.string()) if split else texts
    words = flat.dictionary_encode()
    lists = pa.array(encode(words.dictionary.to_pylist()) if len(words.dictionary) else [], pa.list_(pa.string()))
    if len(lists) != len(words.dictionary):
        raise ValueError(f"the vocabulary returned {len(lists)} lists for {len(words.dictionary)} texts")
    found = lists.take(words.indices)
    if pieces is None:
        return found
    sizes = pc.list_value_length(found).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum([len(own) for own in pieces], dtype=np.int64)])]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found.flatten())


def _token_lists(batches: Iterator[pa.Array], encode: Encode, split: Callable[[str], list[str]] | None) -> Iterator[pa.Array]:
    """Token lists of the texts in order, of at most `BATCH_CHARS` characters or one text at a time."""
    for batch in batches:
        texts = pc.fill_null(batch, "").cast(pa.string())
        sizes = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BATCH_CHARS, side="right")))
            lists = _encoded(texts.slice(at, end - at), encode, split)
            yield pc.if_else(pc.is_null(batch.slice(at, end - at)), pa.scalar([], pa.list_(pa.string())), lists)
            at = end


def vocabulary_tokenizer(make_encode: Callable[[], Encode], split: Callable[[str], list[str]] | None = None) -> Tokenizer:
    """A subword vocabulary as a column tokeniser, in Arrow batches.

    `make_encode` runs once per task and loads the vocabulary there. `split` cuts a
    text into words whose tokens don't depend on each other; then every distinct word
    of a batch is encoded once, and texts are put together from them. Without it every
    distinct text is encoded whole. A null text has no tokens. Tokens leave the worker
    slice by slice, so what it holds doesn't grow with the rows of a batch.
    """

    @F.arrow_udf("array<string>")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _token_lists(batches, make_encode(), split)

    return lambda c: tokens(c)
