"""Counts the text metrics are made of, one Arrow pass over two token arrays.

Spark has no multiset intersection, longest common subsequence or word
alignment over arrays, and the relational forms shuffle every n-gram. This pass
is map-only. A batch is worked on in slices of bounded token mass, a long pair
alone in its own. Tokens of a slice are numbered once; all but the bit-parallel
subsequence loop and the synonym stage is array arithmetic over the slice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

OVERLAPS = ("m1", "m2", "m3", "m4")
FIELDS = {**{m: (m,) for m in OVERLAPS}, "lcs": ("lcs",), "aligned": ("matches", "chunks")}
_KEY_LIMIT = 2**62
#: Tokens of both sides that are worked on at a time.
SLICE_TOKENS = 1 << 18


@dataclass
class _Side:
    """One side of a batch: token numbers end to end, and the row each belongs to."""

    codes: np.ndarray
    lengths: np.ndarray

    def __post_init__(self) -> None:
        self.ends = np.cumsum(self.lengths)
        self.row = np.repeat(np.arange(len(self.lengths)), self.lengths)
        # Tokens from this one to the end of its row.
        self.left = np.repeat(self.ends, self.lengths) - np.arange(len(self.codes))


def _numbered(p: pa.Array, r: pa.Array) -> tuple[_Side, _Side, pa.Array]:
    """Both sides over one token dictionary."""
    lengths = [pc.fill_null(pc.list_value_length(a), 0).to_numpy(zero_copy_only=False).astype(np.int64) for a in (p, r)]
    encoded = pa.concat_arrays([p.flatten(), r.flatten()]).dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    cut = int(lengths[0].sum())
    return _Side(codes[:cut], lengths[0]), _Side(codes[cut:], lengths[1]), encoded.dictionary


def _places_in(wanted: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where sorted `wanted` and sorted, distinct `known` hold the same value."""
    at = np.minimum(np.searchsorted(known, wanted), max(0, len(known) - 1))
    hit = known[at] == wanted if len(known) else np.zeros(len(wanted), dtype=bool)
    return np.flatnonzero(hit), at[hit]


def _clipped_overlaps(p: _Side, r: _Side, vocabulary: int, orders: int) -> list[np.ndarray]:
    """Per row, the size of the n-gram multiset intersection, for n = 1..orders."""
    rows = len(p.lengths)
    grams, span = [p.codes, r.codes], vocabulary
    found = []
    for n in range(1, orders + 1):
        places = [np.flatnonzero(side.left >= n) for side in (p, r)]
        if n > 1:
            # An n-gram is the (n-1)-gram at its start and the token at its end.
            if span * vocabulary * rows >= _KEY_LIMIT:
                used, dense = np.unique(np.concatenate(grams), return_inverse=True)
                grams, span = np.split(dense, [len(grams[0])]), len(used)
            wider = []
            for side, gram, at in zip((p, r), grams, places):
                full = np.zeros_like(gram)
                full[at] = gram[at] * vocabulary + side.codes[at + n - 1]
                wider.append(full)
            grams, span = wider, span * vocabulary
        keys = [
            np.unique(side.row[at] * span + gram[at], return_counts=True)
            for side, gram, at in zip((p, r), grams, places)
        ]
        (p_keys, p_counts), (r_keys, r_counts) = keys
        in_p, in_r = _places_in(p_keys, r_keys)
        shared = np.minimum(p_counts[in_p], r_counts[in_r])
        found.append(np.bincount(p_keys[in_p] // span, weights=shared, minlength=rows))
    return found


def lcs_length(a: Iterable[int], b: Iterable[int]) -> int:
    """LCS length with one bit per token of `a` (Crochemore et al. 2001, Hyyrö 2004)."""
    where: dict[int, int] = {}
    size = 0
    for size, token in enumerate(a, 1):
        where[token] = where.get(token, 0) | (1 << (size - 1))
    full = (1 << size) - 1
    row = full
    for token in b:
        hit = row & where.get(token, 0)
        row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def _lcs_lengths(p: _Side, r: _Side) -> list[int]:
    pieces = [np.split(side.codes, side.ends[:-1]) for side in (p, r)]
    return [lcs_length(a.tolist(), b.tolist()) for a, b in zip(*pieces)]


def _ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in order of key and place, the keys in that order, and how many equal ones follow each."""
    n = max(1, len(key))
    if int(key.max(initial=0)) < _KEY_LIMIT // n:
        # One sort of plain integers is several times faster than a stable argsort.
        packed = key * n + np.arange(len(key))
        packed.sort()
        ordered = packed // n
        order = packed - ordered * n
    else:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
    last = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], True)) if len(key) else order
    runs = np.diff(last, prepend=-1)
    return order, ordered, np.repeat(last, runs) - np.arange(len(key))


def _meet(p_key: np.ndarray, r_key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Match equal keys, last with last, next-to-last with next-to-last, and so on."""
    p_order, p_ordered, p_after = _ranked(p_key)
    r_order, r_ordered, r_after = _ranked(r_key)
    width = max(p_after.max(initial=0), r_after.max(initial=0)) + 1
    in_p, in_r = _places_in(p_ordered * width + width - 1 - p_after, r_ordered * width + width - 1 - r_after)
    return p_order[in_p], r_order[in_r]


@dataclass(frozen=True)
class Thesaurus:
    """Words and their synonyms as a sparse matrix: those of word i are `others[ends[i - 1] : ends[i]]`."""

    words: pa.Array
    ends: np.ndarray
    others: pa.Array

    @classmethod
    def of(cls, table: pa.Table) -> Thesaurus:
        """From `(word, syn)` rows; repeated rows and nulls add nothing."""
        rows = table.select(["word", "syn"]).drop_null().group_by(["word", "syn"]).aggregate([]).sort_by("word").combine_chunks()
        runs = pc.run_end_encode(rows["word"].combine_chunks() if rows.num_rows else pa.array([], pa.string()))
        return cls(runs.values.cast(pa.string()), runs.run_ends.to_numpy(zero_copy_only=False).astype(np.int64), pa.array(rows["syn"].to_pylist(), pa.string()))

    def codes(self, words: list[str]) -> dict[int, list[int]]:
        """For the numbers of `words` that have synonyms among them, the numbers of those synonyms."""
        own = pa.array(words, pa.string())
        row = pc.index_in(own, value_set=self.words).to_numpy(zero_copy_only=False)
        known = np.flatnonzero(~np.isnan(row.astype(np.float64)))
        rows = row[known].astype(np.int64)
        begins = np.where(rows > 0, self.ends[rows - 1], 0) if len(rows) else rows
        sizes = self.ends[rows] - begins if len(rows) else rows
        places = np.repeat(begins - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
        # Words that differ in case have one form, so a form may have several numbers.
        numbers: dict[str, list[int]] = {}
        for number, word in enumerate(words):
            numbers.setdefault(word, []).append(number)
        found: dict[int, list[int]] = {}
        for number, other in zip(np.repeat(known, sizes).tolist(), self.others.take(pa.array(places)).to_pylist()):
            if other in numbers:
                found.setdefault(number, []).extend(numbers[other])
        return found


def _synonym_stage(
    p: _Side, r: _Side, open_p: np.ndarray, open_r: np.ndarray, known: Callable[[int], Iterable[int]]
) -> tuple[list[int], list[int]]:
    """Among unmatched words, from the end: the last free reference word that is a synonym.

    `known` gives the numbers of the synonyms of the prediction word at a place.
    """
    free: dict[tuple[int, int], list[int]] = {}
    for j in open_r.tolist():
        free.setdefault((int(r.row[j]), int(r.codes[j])), []).append(j)
    matched: tuple[list[int], list[int]] = ([], [])
    for i in open_p.tolist()[::-1]:
        row = int(p.row[i])
        places = [free[row, w] for w in known(i) if free.get((row, w))]
        if places:
            matched[0].append(i)
            matched[1].append(max(places, key=lambda at: at[-1]).pop())
    return matched


def _alignments(
    p: _Side,
    r: _Side,
    dictionary: pa.Array,
    stem: Callable[[str], str] | None,
    synonyms: list | None,
    thesaurus: Thesaurus | None,
) -> tuple[np.ndarray, np.ndarray]:
    """Matched words and chunks per row (Banerjee & Lavie 2005): exact, stem, then synonym stage."""
    rows = len(p.lengths)
    words = [w.lower() for w in dictionary.to_pylist()]
    stages = [words] if stem is None else [words, [stem(w) for w in words]]
    open_p, open_r = np.arange(len(p.codes)), np.arange(len(r.codes))
    met_p, met_r = [], []

    def take(in_p: np.ndarray, in_r: np.ndarray) -> None:
        nonlocal open_p, open_r
        met_p.append(open_p[in_p])
        met_r.append(open_r[in_r])
        open_p, open_r = np.delete(open_p, in_p), np.delete(open_r, in_r)

    for forms in stages:
        number: dict[str, int] = {}
        form = np.array([number.setdefault(w, len(number)) for w in forms], dtype=np.int64)
        span = len(number) + 1
        key = lambda side, at: side.row[at] * span + form[side.codes[at]]  # noqa: E731, B023
        take(*_meet(key(p, open_p), key(r, open_r)))
    if synonyms is not None or thesaurus is not None:
        if thesaurus is not None:
            matrix = thesaurus.codes(words)
            # Only words with synonyms among the others are walked through.
            can = np.zeros(len(words) + 1, dtype=bool)
            can[list(matrix)] = True
            open_p = open_p[can[p.codes[open_p]]]
            known = lambda i: matrix[int(p.codes[i])]
        else:
            numbers: dict[str, list[int]] = {}
            for number, word in enumerate(words):
                numbers.setdefault(word, []).append(number)
            starts = p.ends - p.lengths

            def known(i: int) -> list[int]:
                row = int(p.row[i])
                return [n for w in synonyms[row][i - starts[row]] or () for n in numbers.get(w, ())]

        found_p, found_r = _synonym_stage(p, r, open_p, open_r, known)
        met_p.append(np.array(found_p, dtype=np.int64))
        met_r.append(np.array(found_r, dtype=np.int64))
    i, j = np.concatenate(met_p), np.concatenate(met_r)
    order = np.argsort(i)
    i, j = i[order], j[order]
    row = p.row[i]
    opens = np.ones(len(i), dtype=bool)
    opens[1:] = (row[1:] != row[:-1]) | (i[1:] != i[:-1] + 1) | (j[1:] != j[:-1] + 1)
    return np.bincount(row, minlength=rows), np.bincount(row[opens], minlength=rows)


def token_slices(p: pa.Array, r: pa.Array, limit: int = SLICE_TOKENS) -> Iterable[tuple[int, int]]:
    """Row ranges with at most `limit` tokens on both sides together, or one pair."""
    sizes = [pc.fill_null(pc.list_value_length(a), 0).to_numpy(zero_copy_only=False).astype(np.int64) for a in (p, r)]
    ends = np.cumsum(sizes[0] + sizes[1])
    at = 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield at, end
        at = end


def pair_counts(
    p: pa.Array,
    r: pa.Array,
    wanted: list[str],
    stem: Callable[[str], str] | None = None,
    synonyms: pa.Array | None = None,
    thesaurus: Thesaurus | None = None,
    limit: int = SLICE_TOKENS,
) -> pa.Array:
    """The counts of the `wanted` features of two columns of token lists, slice by slice."""
    orders = [n for n, m in enumerate(OVERLAPS, 1) if m in wanted]
    names = [name for f in wanted for name in FIELDS[f]]

    def counts(p: pa.Array, r: pa.Array, synonyms: list | None) -> pa.Array:
        left, right, dictionary = _numbered(p, r)
        columns = []
        if orders:
            overlaps = _clipped_overlaps(left, right, max(1, len(dictionary)), max(orders))
            columns += [overlaps[n - 1] for n in orders]
        if "lcs" in wanted:
            columns.append(_lcs_lengths(left, right))
        if "aligned" in wanted:
            columns += _alignments(left, right, dictionary, stem, synonyms, thesaurus)
        return pa.StructArray.from_arrays([pa.array(np.asarray(c).astype(np.int32), pa.int32()) for c in columns], names=names)

    cut = lambda a, at, end: a.slice(at, end - at)
    done = [
        counts(cut(p, at, end), cut(r, at, end), None if synonyms is None else cut(synonyms, at, end).to_pylist())
        for at, end in token_slices(p, r, limit)
    ]
    return pa.concat_arrays(done) if done else pa.array([], pa.struct([(n, pa.int32()) for n in names]))


def pair_stats(
    features: Iterable[str],
    stem: Callable[[str], str] | None = None,
    with_synonyms: bool = False,
    thesaurus: Broadcast | None = None,
) -> Callable[..., Column]:
    """A column function `(p_tokens, r_tokens[, p_synonyms]) -> struct` of the features' counts.

    m1..m4 are clipped n-gram overlaps, `lcs` the subsequence length, and `aligned`
    gives matches and chunks. Whole texts, no length cap. Synonyms come as a column,
    one list per prediction token, or from a broadcast `Thesaurus`.
    """
    wanted = [f for f in FIELDS if f in set(features)]
    shape = StructType([StructField(name, IntegerType()) for f in wanted for name in FIELDS[f]])

    if with_synonyms:

        @F.arrow_udf(shape)
        def stats(p: pa.Array, r: pa.Array, s: pa.Array) -> pa.Array:
            return pair_counts(p, r, wanted, stem, s)
    else:

        @F.arrow_udf(shape)
        def stats(p: pa.Array, r: pa.Array) -> pa.Array:
            return pair_counts(p, r, wanted, stem, thesaurus=thesaurus.value if thesaurus else None)

    return stats
