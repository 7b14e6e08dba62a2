"""Language-model scores from an n-gram trie in Elias-Fano form.

The model predicts each word, and at last the end of the text, from the `order`
- 1 words before it, level by level (after Witten and Bell): p = (c + 8 t * lower)
/ (n + 8 t), where c is how often the word follows the level's context, n how
often the context is followed at all, t by how many different words, and `lower`
is p of the next shorter context. Below the pairs are single words, p = (c + t *
spelt) / (n + t) over all words, and below these the chance of the word's letters
under a letter-trigram model. So every word has a probability. A text's score is
the sum of log10 p. All counts are exact; nothing depends on the partitions.

The trie's levels are single words, pairs and so on, each split into shards by
context. A level is a sequence of its contexts' node numbers in the level below,
pointers into their children, the children's words (as node numbers of the word
level; there, as hashes of 64 bits) and cumulative counts, all monotone and in
Elias-Fano form on memory-mapped files, with quantised chances beside them. A
child is found by successor search within its context's range, and its place and
shard make its node number, by which the next level knows it as a context.

Levels are built and asked one after the other. Texts are cut into slices once. A
slice asks for its distinct word sequences, packed by shard, with their uses in
training texts; a shard adds these up, builds its part of the level, and answers
each slice. A sequence whose context isn't in the trie isn't asked for any more.

A context with more than 1/512 of all training words would make a hot shard. Its
children are dealt over all shards, and the only number that then takes all of
them, how many there are, is added up for at most 512 such contexts a level and
broadcast. Chances are the same as without.

Null and empty texts are the end alone. Repeated rows are texts of their own.
Words of any length and texts of any length are scored whole. Without training
texts every word has its spelt probability under a flat letter model. An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.elias_fano import EliasFano
from pairloom.llm.text import Words, mix, release, slices, split_words, texts
from pairloom.session import checkpointed, checkpointed_by, free_unused

#: Contexts with more than this share of the training words are dealt over all shards.
_HOT = 512
#: Training words that make a shard.
_SHARD = 4_000_000
#: Weight of a word's chance in the next shorter context, for each different follower of the context.
_TRUST = 8.0
#: Nodes: 0 is none; the start of a text and its end; and from there on those of the levels.
_START, _END, _NODES = np.uint64(1), np.uint64(2), np.uint64(3)
#: What a slice holds besides its words' numbers, before and after the first level's answers.
_HELD = (("<u8", "<u2"), ("<u8", "<u8", "<u8", "<u2", "<f8", "<u4"))
#: Symbols of the letter model: byte classes, the mark before a word, the mark after it.
_SYMBOLS, _BEFORE, _AFTER = 64, 62, 63
_DOCS = 30_000
_SLICE = 8 << 20
_CLASS = np.array([b - 97 if 97 <= b <= 122 else 26 + b % 36 for b in range(256)], dtype=np.int64)


def _letters(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the distinct words: bytes end to end, and where each word begins and how long it is."""
    column = words.distinct.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[int(offsets[0]) : int(offsets[-1])]
    return raw, offsets[:-1] - offsets[0], np.diff(offsets)


def _trigrams(raw: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram number of every byte and word end, the byte (or -1), and where each word's first one is."""
    first = begin + 3 * np.arange(len(begin))
    symbols = np.full(len(raw) + 3 * len(begin), _BEFORE, dtype=np.int64)
    own = np.arange(len(raw)) + np.repeat(3 * np.arange(len(begin)) + 2, size)
    symbols[own] = _CLASS[raw]
    symbols[first + size + 2] = _AFTER
    byte = np.full(len(symbols), -1, dtype=np.int64)
    byte[own] = raw
    real = np.ones(len(symbols), dtype=bool)
    real[first] = real[first + 1] = False
    at = np.flatnonzero(real)
    number = (symbols[at - 2] * _SYMBOLS + symbols[at - 1]) * _SYMBOLS + symbols[at]
    return number, byte[at], begin + np.arange(len(begin))


class Speller:
    """log10 of a word's chance letter by letter, and by itself once its uses are known."""

    def __init__(self, trigrams: np.ndarray, letters: np.ndarray, words: int, ends: int) -> None:
        self.words, self.ends = words, ends
        self.end = np.log10((ends + 1) / (words + ends + 100))
        counts = trigrams.reshape(-1, _SYMBOLS) + 0.1
        counts[:, _BEFORE] = 0
        with np.errstate(divide="ignore"):
            self.next = np.log10(counts / counts.sum(axis=1, keepdims=True)).ravel()
        letters = letters + 0.1
        self.letter = np.append(np.log10(letters / np.bincount(_CLASS, weights=letters, minlength=_SYMBOLS)[_CLASS]), 0.0)

    def spelt(self, words: Words) -> np.ndarray:
        if not len(words.distinct):
            return np.zeros(0)
        number, byte, first = _trigrams(*_letters(words))
        return np.add.reduceat(self.next[number] + self.letter[byte], first)


# A word's -log10 in 16 bits: steps of 1/256 below 128, then of 1/2048 of a doubling.
_DECODED = np.append(np.arange(32768) / 256, 128 * 2.0 ** (np.arange(32768) / 2048))


def _encoded(log10: np.ndarray) -> np.ndarray:
    x = np.maximum(-log10, 0)
    high = 32768 + np.rint(2048 * np.log2(np.maximum(x, 128) / 128))
    return np.where(x < 127.9, np.rint(256 * x), np.minimum(high, 65535)).astype(np.uint16)


def _learn_letters(train: DataFrame) -> Speller:
    """The letter model, and the numbers of words and of texts."""
    size = _SYMBOLS**3

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = np.zeros(size + 258, dtype=np.int64)
        for piece in slices(batches, limit=_SLICE):
            letters[-1] += piece.num_rows
            words = split_words(texts(piece), lower=True)
            if not len(words.codes):
                continue
            uses = np.bincount(words.codes, minlength=len(words.distinct))
            raw, begin, length = _letters(words)
            number, byte, _ = _trigrams(raw, begin, length)
            letters[:size] += np.bincount(number, weights=np.repeat(uses, length + 1), minlength=size).astype(np.int64)
            letters[size:-1] += np.append(np.bincount(raw, weights=np.repeat(uses, length), minlength=256), len(words.codes)).astype(np.int64)
        used = np.flatnonzero(letters)
        yield pa.record_batch([pa.array(used.astype(np.int64)), pa.array(letters[used])], names=["item", "n"])

    # At most 64 ** 3 + 258 numbers, whatever the corpus.
    letters = np.zeros(size + 258)
    for r in train.mapInArrow(count, "item bigint, n bigint").groupBy("item").agg(F.sum("n").alias("n")).collect():
        letters[r["item"]] = r["n"]
    return Speller(letters[:size], letters[size:-2], int(letters[-2]), int(letters[-1]))


_SHIPPED = "slice bigint, shard int, body binary, docs array<struct<doc_id:{kind},train:boolean,tokens:bigint>>, context bigint, kinds bigint"


def _bytes(*arrays: np.ndarray) -> bytes:
    """Arrays behind their lengths, byte by byte of all numbers, compressed: checkpoints are not."""
    planes = (np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() for a in arrays)
    raw = b"".join(len(a).to_bytes(4, "little") + p for a, p in zip(arrays, planes))
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _arrays(raw: bytes, *kinds: str) -> list[np.ndarray]:
    raw = pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)
    out, at = [], 0
    for kind in kinds:
        n, width = int.from_bytes(raw[at : at + 4], "little"), np.dtype(kind).itemsize
        planes = np.frombuffer(raw, dtype=np.uint8, count=n * width, offset=at + 4).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += 4 + n * width
    return out


class Level:
    """One shard of a level: learnt children as (rank of their context, word) in order, with their counts."""

    def __init__(
        self, contexts: np.ndarray, total: np.ndarray, rank: np.ndarray, word: np.ndarray, counts: np.ndarray, folder: Path, last: bool
    ) -> None:
        self.bits = np.uint64(int(word.max()).bit_length() if len(word) else 0)
        self.contexts = EliasFano(contexts, folder, "contexts")
        self.pointers = EliasFano(np.append(0, np.cumsum(np.bincount(rank, minlength=len(contexts)))), folder, "pointers")
        self.children = EliasFano(self._key(rank, word), folder, "children")
        # Of the last level no counts are asked.
        self.cumulated = None if last else EliasFano(np.append(0, np.cumsum(counts)), folder, "counts")
        codes = np.minimum(1 + np.rint(-1024 * np.log2(counts / np.maximum(total[rank], 1))), 65535).astype(np.uint16)
        np.save(folder / "chances.npy", codes)
        self.chances = np.load(folder / "chances.npy", mmap_mode="r") if len(codes) else codes

    def _key(self, rank: np.ndarray, word: np.ndarray) -> np.ndarray:
        # Single words, hashes of all 64 bits, have one context alone, of rank 0.
        return (rank.astype(np.uint64) << self.bits) | word if self.bits < 64 else word

    def ask(self, contexts: np.ndarray, runs: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, ...]:
        """Children of each context; and of each word after it the coded chance, or 0, the count and the place."""
        none = np.zeros(len(word), dtype=np.int64)
        if not self.children.n:
            return np.zeros(len(contexts), dtype=np.int64), none, none, none
        rank, known = self.contexts.successor(contexts)
        rank = np.where(known, rank, 0)
        begin, end = self.pointers.get(rank).astype(np.int64), self.pointers.get(rank + 1).astype(np.int64)
        own = np.repeat(np.arange(len(contexts)), runs)
        # A word wider than those of this shard can't be among them.
        fits = known[own] & ((word >> self.bits) == 0) if self.bits < 64 else known[own]
        at, found = self.children.successor(self._key(rank[own], np.where(fits, word, 0)))
        found &= fits & (at >= begin[own]) & (at < end[own])
        at = np.where(found, at, 0)
        count = none if self.cumulated is None else np.where(found, (self.cumulated.get(at + 1) - self.cumulated.get(at)).astype(np.int64), 0)
        return np.where(known, end - begin, 0), np.where(found, self.chances[at], 0), count, at


_COLUMNS = ["slice", "shard", "body", "docs", "context", "kinds"]


def _table(rows: list[tuple], docs: pa.DataType) -> pa.Table:
    """Rows of `_SHIPPED`; what a row leaves out at its end is null."""
    kinds = (pa.int64(), pa.int32(), pa.binary(), docs, pa.int64(), pa.int64())
    columns = list(zip(*(r + (None,) * (6 - len(r)) for r in rows))) or [()] * 6
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=_COLUMNS)


class Asked:
    """What a slice asks a level for, by shard: which of its sequences, and the runs of equal contexts among them."""

    def __init__(self, context: np.ndarray, total: np.ndarray, word: np.ndarray, hot: np.ndarray, shards: int) -> None:
        self.context, self.total, self.word, self.hot, self.of = context, total, word, hot, shards
        real = np.flatnonzero((context > 0) & (total > 0))
        goal = mix(context[real] + np.where(hot[real], mix(word[real]), np.uint64(0))) % np.uint64(shards)
        goal = goal.astype(np.uint16 if shards <= 1 << 16 else np.uint64)
        line = np.argsort(goal, kind="stable")
        goal, self.line = goal[line], real[line]
        own = context[self.line]
        new = np.append(True, goal[1:] != goal[:-1])[: len(goal)]
        self.cuts = np.append(np.flatnonzero(new), len(goal))
        self.starts = np.flatnonzero(new | np.append(True, own[1:] != own[:-1])[: len(goal)])
        self.runs = np.diff(np.append(self.starts, len(goal)))
        self.firsts = np.searchsorted(self.starts, self.cuts)
        self.shards = goal[self.cuts[:-1]].astype(np.int64)

    def rows(self, number: int, uses: np.ndarray) -> list[tuple]:
        out = []
        for k, shard in enumerate(self.shards):
            some = self.line[self.cuts[k] : self.cuts[k + 1]]
            heads = self.line[self.starts[self.firsts[k] : self.firsts[k + 1]]]
            runs = self.runs[self.firsts[k] : self.firsts[k + 1]]
            body = _bytes(
                self.context[heads],
                self.total[heads].astype("<u8"),
                self.hot[heads].astype("<u1"),
                runs.astype("<u4"),
                self.word[some],
                uses[some].astype("<u4"),
            )
            out.append((number, int(shard), body))
        return out

    def answers(self, bodies: dict[int, bytes], kinds_of: dict[int, int], last: bool) -> tuple[np.ndarray, ...]:
        """Of all sequences: children of the context, chance after it, count and node; 0 where there is none."""
        n = len(self.context)
        kinds, chance, count, node = np.zeros(n), np.zeros(n), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.uint64)
        for k, shard in enumerate(self.shards):
            some = self.line[self.cuts[k] : self.cuts[k + 1]]
            t, code, *more = _arrays(bodies[int(shard)], "<u4", "<u2", *(() if last else ("<u8", "<u8")))
            kinds[some] = np.repeat(t, self.runs[self.firsts[k] : self.firsts[k + 1]])
            chance[some] = np.where(code > 0, _CHANCES[code], 0.0)
            if more:
                found, step = some[code > 0], more[1].astype(np.int64)
                place = np.cumsum((step >> 1) ^ -(step & 1)).astype(np.uint64)
                count[found] = more[0]
                node[found] = place * np.uint64(self.of) + np.uint64(shard) + _NODES
        for context, t in kinds_of.items():
            kinds[self.hot & (self.context == np.uint64(context))] = t
        return kinds, chance, count, node


#: A chance by its code: steps of 1/1024 of a halving.
_CHANCES = np.append(0.0, 2.0 ** (-np.arange(65535) / 1024))


def _interpolated(chance: np.ndarray, total: np.ndarray, kinds: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """log10 of (c + kinds * p) / (n + kinds), `lower` being log10 p, which may be too small for a double's p."""
    weight = np.where(kinds > 0, kinds / np.maximum(total + kinds, 1), 1.0)
    unseen = np.log10(weight) + lower
    seen = chance * total / np.maximum(total + kinds, 1) + weight * 10.0 ** np.maximum(lower, -300)
    return np.where(chance > 0, np.log10(np.maximum(seen, 1e-300)), unseen)


def _answer_shard(last: bool) -> Callable[[pa.Table], pa.Table]:
    """Build the shard's part of a level and answer each slice; and how many children its hot contexts have here."""

    def answer(table: pa.Table) -> pa.Table:
        docs = table.schema.field("docs").type
        numbers, shard, rows = table.column("slice").to_pylist(), table.column("shard")[0].as_py(), []
        held = [_arrays(b, "<u8", "<u8", "<u1", "<u4", "<u8", "<u4") for b in table.column("body").to_pylist()]
        sizes = [(len(h[0]), len(h[4])) for h in held]
        context, all_total, is_hot, runs, word, uses = (np.concatenate(x) for x in zip(*held))
        del held
        contexts, place = np.unique(context, return_inverse=True)
        total, hot = np.zeros(len(contexts)), np.zeros(len(contexts), dtype=bool)
        total[place], hot[place] = all_total, is_hot > 0
        # Slices ask much the same: each pair is looked up once for all.
        rank = np.repeat(place, runs)
        bits = np.uint64(int(word.max()).bit_length())
        keys, which = np.unique((rank.astype(np.uint64) << bits) | word if bits < 64 else word, return_inverse=True)
        counts = np.bincount(which, weights=uses, minlength=len(keys)).astype(np.int64)
        rank, word = np.zeros(len(keys), dtype=np.int64), keys
        if bits < 64:
            rank, word = (keys >> bits).astype(np.int64), keys & ((np.uint64(1) << bits) - np.uint64(1))
        learnt = counts > 0
        with tempfile.TemporaryDirectory() as folder:
            level = Level(contexts, total, rank[learnt], word[learnt], counts[learnt], Path(folder), last)
            kinds, code, count, at = level.ask(contexts, np.bincount(rank, minlength=len(contexts)), word)
            del level
        heads = pairs = 0
        for number, (n, m) in zip(numbers, sizes):
            some = which[pairs : pairs + m]
            told = [kinds[place[heads : heads + n]].astype("<u4"), code[some].astype("<u2")]
            if not last:
                found = some[code[some] > 0]
                step = np.diff(at[found], prepend=0)  # small, as words are asked in nearly the order of their nodes
                told += [count[found].astype("<u8"), ((step << 1) ^ (step >> 63)).astype("<u8")]
            rows.append((number, shard, _bytes(*told)))
            heads, pairs = heads + n, pairs + m
        rows += [(-1 - shard, shard, None, None, int(c), int(t)) for c, t in zip(contexts[hot], kinds[hot])]
        return _table(rows, docs)

    return answer


class Slice:
    """Words of a slice's texts, each text with its end, and the word sequences that end at each of them."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, n_words: int) -> None:
        counts = counts.astype(np.int64)
        # Words are numbered 0 and up, then the end and the start.
        self.width = n_words + 2
        self.word = np.insert(codes.astype(np.int64), np.cumsum(counts), n_words)
        self.doc = np.repeat(np.arange(len(counts)), counts + 1)
        self.first = np.append(True, self.doc[1:] != self.doc[:-1])[: len(self.doc)]
        self.grams, self.kinds = self.word, n_words + 1

    def lengthen(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """To sequences longer by a word: numbers of their contexts, last words and sequences without the first word."""
        before = np.where(self.first, self.kinds, np.append(0, self.grams[:-1])[: len(self.grams)])
        keys, longer = np.unique(before * self.width + self.word, return_inverse=True)
        lower = np.zeros(len(keys), dtype=np.int64)
        lower[longer] = self.grams
        self.grams, self.kinds = longer, len(keys)
        return keys // self.width, keys % self.width, lower


def score_texts(docs: DataFrame, train: Column, shards: int | None = None, order: int = 3) -> DataFrame:
    """`doc_id, n_tokens, n_known, train_tokens, base_score, score` of every row, learning from those where `train` holds.

    A word is predicted from up to `order` - 1 words before it.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    sc = docs.sparkSession.sparkContext
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    kind = source.schema["doc_id"].dataType.simpleString()
    speller = _learn_letters(source.where("train").select("text"))
    letters = sc.broadcast(speller)
    ends, train_tokens = speller.ends, speller.words + speller.ends
    shards = shards or max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), speller.words // _SHARD)
    least = train_tokens / _HOT
    schema = _SHIPPED.format(kind=kind)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slices: texts as numbers of words, and these by hash, so that numbers and nodes are in much the same order."""
        speller = letters.value
        number = TaskContext.get().partitionId() << 32
        few = (b.slice(i, _DOCS) for b in slices(batches, limit=_SLICE) for i in range(0, b.num_rows, _DOCS))
        for piece in few:
            number += 1
            words = split_words(texts(piece), lower=True)
            hashed, spelt = words.hashes(), speller.spelt(words)
            line = np.argsort(hashed)
            place = np.empty(len(line), dtype=np.uint32)
            place[line] = np.arange(len(line))
            trained = piece.column("train").to_numpy(zero_copy_only=False).astype(bool)
            header = [
                {"doc_id": i, "train": bool(t), "tokens": int(n) + 1}
                for i, t, n in zip(piece.column("doc_id").to_pylist(), trained, words.counts)
            ]
            body = _bytes(place[words.codes], words.counts.astype("<u4"), hashed[line], _encoded(spelt[line]))
            shape = pa.list_(pa.struct([("doc_id", piece.schema.field("doc_id").type), ("train", pa.bool_()), ("tokens", pa.int64())]))
            yield from _table([(number, -1, body, header)], shape).to_batches()

    def longest(depth: int, held: list[np.ndarray]) -> tuple[Slice, Asked, np.ndarray | None]:
        """The slice's sequences of `depth` words, what they ask their level, and those of them without the first word."""
        codes, counts = held[:2]
        if depth == 1:
            every = np.ones(len(held[2]), dtype=np.uint64)
            return Slice(codes, counts, len(every)), Asked(every, every * np.uint64(n_words), held[2], every > 0, shards), None
        words, node, total = held[2:5]
        node = node if len(node) else words  # the first level's sequences are the words
        own = Slice(codes, counts, len(words) - 2)
        for _ in range(depth - 2):
            own.lengthen()
        context, word, lower = own.lengthen()
        return own, Asked(node[context], total[context], words[word], total[context] > least, shards), lower

    def ask(depth: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """What slices ask level `depth`, by shard, with the uses in training texts."""

        def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for number, body, header in zip(*(batch.column(c) for c in ("slice", "body", "docs"))):
                    own, asked, _ = longest(depth, _arrays(body.as_py(), "<u4", "<u4", *_HELD[depth > 1]))
                    trained = np.array([d["train"] for d in header.as_py()], dtype=bool)[own.doc]
                    uses = np.bincount(own.grams[trained], minlength=own.kinds)
                    yield from _table(asked.rows(number.as_py(), uses), batch.schema.field("docs").type).to_batches()
            release()

        return requests

    def take(depth: int, kinds_of: dict[int, int]) -> Callable[[pa.Table, pa.Table], pa.Table]:
        """A slice with level `depth`'s answers or, after the last, sums by text."""

        def step(table: pa.Table, answers: pa.Table) -> pa.Table:
            bodies = dict(zip(answers.column("shard").to_pylist(), answers.column("body").to_pylist()))
            docs_type, header = table.schema.field("docs").type, table.column("docs")[0].as_py()
            held = _arrays(table.column("body")[0].as_py(), "<u4", "<u4", *_HELD[depth > 1])
            own, asked, lower = longest(depth, held)
            kinds, chance, uses, node = asked.answers(bodies, kinds_of, depth == order)
            counts = held[1]
            if depth == 1:
                chances = _interpolated(chance, asked.total.astype(np.float64), kinds, -_DECODED[held[3]])
                # The end and the start of texts are no words of the level.
                node, uses = np.append(node, [_END, _START]), np.append(uses, [ends, ends])
                words, chances = node, np.append(chances, [end_chance, 0.0])
                known = np.bincount(own.doc, weights=(uses > 0)[own.word], minlength=len(counts))
                base = np.bincount(own.doc, weights=np.log10(uses + 0.5)[own.word], minlength=len(counts)) - (counts + 1.0) * floor
            else:
                words, base, known = held[2], held[6], held[7]
                chances = _interpolated(chance, asked.total.astype(np.float64), _TRUST * kinds, -_DECODED[held[5][lower]])
                node, uses, chances = np.append(node, _START), np.append(uses, ends), np.append(chances, 0.0)
            if depth < order:
                body = _bytes(*held[:2], words, node if depth > 1 else node[:0], uses.astype("<u8"), _encoded(chances), base, known.astype("<u4"))
                return _table([(table.column("slice")[0].as_py(), -1, body, header)], docs_type)
            columns = [
                pa.array([d["doc_id"] for d in header], docs_type.value_type.field("doc_id").type),
                pa.array([d["tokens"] for d in header], pa.int64()),
                pa.array(known.astype(np.int64)),
                pa.array(np.full(len(counts), train_tokens, dtype=np.int64)),
                pa.array(base),
                pa.array(np.bincount(own.doc, weights=chances[own.grams], minlength=len(counts))),
            ]
            return pa.table(columns, names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        return step

    held = checkpointed(source.mapInArrow(read, schema))
    end_chance, n_words, floor = speller.end, speller.words, 0.0
    for depth in range(1, order + 1):
        answers = held.mapInArrow(ask(depth), schema).groupBy("shard").applyInArrow(_answer_shard(depth == order), schema)
        # Dealt by slice before they are written, so that they are on disk once when the slices come to them.
        answered = checkpointed_by(answers, "slice")
        del answers
        free_unused(docs.sparkSession)
        # At most _HOT contexts, and the one of all single words.
        counted = answered.where("slice < 0").groupBy("context").agg(F.sum("kinds").alias("kinds")).collect()
        kinds_of = {r["context"]: r["kinds"] for r in counted}
        if depth == 1:
            floor = np.log10(train_tokens + 0.5 * (kinds_of.get(1, 0) + int(ends > 0) + 1))
        told = held.groupBy("slice").cogroup(answered.where("slice >= 0").groupBy("slice"))
        if depth < order:
            held = checkpointed(told.applyInArrow(take(depth, kinds_of), schema))
            del answered, told
            free_unused(docs.sparkSession)
    return told.applyInArrow(
        take(order, kinds_of),
        f"doc_id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
