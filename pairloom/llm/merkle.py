"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections.

Paragraphs are lines. A paragraph's leaves are its clauses, cut after
punctuation; a clause of more than 256 bytes is cut after sentence marks of other
scripts, then after words chosen by their hash, and a long stretch without white
space after characters chosen by the hash of the three up to them. Sections end at
paragraphs chosen by their hash, so an insertion moves no other border. Nodes hash
their children; the root is the fingerprint. Equal texts have equal roots, and
texts that differ are compared from the top: sections are aligned in their order,
aligned ones count as a whole, and only what lies between them is opened, first to
paragraphs and then to leaves. The likeness of two trees is twice the bytes so
aligned over the bytes of both; text that moved counts once at most.

Every text is read whole. Null and empty texts have the fingerprint of the empty
text, and are like each other. In `edited_fingerprints` rows follow each other
by descending doc_id, null last; rows that repeat a doc_id are ordered by a hash
of their text. A single row is its own successor; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.text import mix, slices, texts

_CLAUSE = re.compile(rb"[^.!?;|]+[.!?;|]*\s*|[.!?;|]+\s*")
_TOKEN = re.compile(rb"\S+\s*|\s+")
#: Sentence marks of other scripts: ideographic, fullwidth, halfwidth, Devanagari, Arabic, Urdu, Ethiopic.
_MARK = re.compile("(?:[^{0}]*[{0}]+\\s*)|[^{0}]+".format("\u3002\uff01\uff1f\uff1b\uff61\u0964\u061f\u06d4\u1362"))
_LONG = 256
#: Stretches without white space of more bytes are cut by content, on average after _RUN characters and at least _LEAST.
_UNBROKEN, _RUN, _LEAST = 128, 24, 8
_SECTION = 4


def _unbroken(token: bytes) -> list[bytes]:
    """A long stretch cut after characters chosen by the hash of the last three, so that an edit moves few borders."""
    text = token.decode("utf-8", "surrogatepass")
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    chosen = np.flatnonzero(mix(points[:-2] + mix(points[1:-1] + mix(points[2:]))) % np.uint64(_RUN) == 0) + 3
    out, begin = [], 0
    for end in chosen.tolist():
        if end - begin >= _LEAST:
            out.append(text[begin:end].encode("utf-8", "surrogatepass"))
            begin = end
    if begin < len(text):
        out.append(text[begin:].encode("utf-8", "surrogatepass"))
    return out


def _pieces(paragraph: bytes) -> list[bytes]:
    out: list[bytes] = []
    for clause in _CLAUSE.findall(paragraph):
        if len(clause) <= _LONG:
            out.append(clause)
            continue
        marked = [clause] if clause.isascii() else _MARK.findall(clause.decode("utf-8", "surrogatepass"))
        for part in marked:
            part = part if isinstance(part, bytes) else part.encode("utf-8", "surrogatepass")
            if len(part) <= _LONG and len(marked) > 1:
                out.append(part)
                continue
            run: list[bytes] = []
            for token in _TOKEN.findall(part):
                if len(token) > _UNBROKEN:
                    out += [b"".join(run), *_unbroken(token)] if run else _unbroken(token)
                    run = []
                    continue
                run.append(token)
                if zlib.crc32(token.rstrip()) % 8 == 0:
                    out.append(b"".join(run))
                    run = []
            if run:
                out.append(b"".join(run))
    return out


@dataclass(frozen=True)
class Paragraph:
    digest: bytes
    leaves: tuple[tuple[bytes, int], ...]
    size: int


@dataclass(frozen=True)
class Tree:
    """Root, and sections of paragraphs of leaves, each leaf a digest and its bytes."""

    root: str
    sections: tuple[tuple[bytes, tuple[Paragraph, ...]], ...]
    size: int


def build(text: str) -> Tree:
    hashed = xxhash.xxh3_128_digest
    raw = text.encode("utf-8", "surrogatepass")
    sections, current = [], []
    for line in raw.split(b"\n"):
        leaves = tuple((hashed(p), len(p)) for p in _pieces(line))
        current.append(Paragraph(hashed(b"P" + b"".join(d for d, _ in leaves)), leaves, len(line)))
        if current[-1].digest[0] % _SECTION == 0:
            sections.append((hashed(b"S" + b"".join(p.digest for p in current)), tuple(current)))
            current = []
    if current:
        sections.append((hashed(b"S" + b"".join(p.digest for p in current)), tuple(current)))
    root = hashlib.sha256(b"".join(d for d, _ in sections)).hexdigest()
    return Tree(root, tuple(sections), len(raw))


def _aligned(x: Sequence[bytes], y: Sequence[bytes]) -> list[tuple[int, int]]:
    """Places of equal digests in the order of both: the common beginning and end, and between them a longest
    rising run of the k-th occurrence in one with the k-th in the other."""
    head, most = 0, min(len(x), len(y))
    while head < most and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < most - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    waiting: defaultdict[bytes, list[int]] = defaultdict(list)
    for j in range(len(y) - tail - 1, head - 1, -1):
        waiting[y[j]].append(j)
    # The end of the best run of each length, and for each pair the one before it.
    ends: list[int] = []
    held: list[int] = []
    pairs: list[tuple[int, int, int]] = []
    for i in range(head, len(x) - tail):
        places = waiting.get(x[i])
        if places:
            j = places.pop()
            length = bisect_left(ends, j)
            pairs.append((i, j, held[length - 1] if length else -1))
            ends[length : length + 1] = [j]
            held[length : length + 1] = [len(pairs) - 1]
    run, at = [], held[-1] if held else -1
    while at >= 0:
        i, j, at = pairs[at]
        run.append((i, j))
    return [(i, i) for i in range(head)] + run[::-1] + [(len(x) - k, len(y) - k) for k in range(tail, 0, -1)]


def _between(x: Sequence, y: Sequence, aligned: list[tuple[int, int]]) -> Iterator[tuple[range, range]]:
    """The stretches between aligned places."""
    i = j = 0
    for p, q in [*aligned, (len(x), len(y))]:
        if p > i or q > j:
            yield range(i, p), range(j, q)
        i, j = p + 1, q + 1


def _opened(a: Tree, b: Tree) -> tuple[list, list[tuple[list, list]]]:
    """Aligned sections of `a`, and the numbered paragraphs of both trees between them."""
    aligned = _aligned([d for d, _ in a.sections], [d for d, _ in b.sections])
    sides = []
    for tree in (a, b):
        numbered, at = [], 0
        for _, paragraphs in tree.sections:
            numbered.append([(at + k, p) for k, p in enumerate(paragraphs)])
            at += len(paragraphs)
        sides.append(numbered)
    gaps = [
        tuple([p for k in places for p in side[k]] for side, places in zip(sides, gap))
        for gap in _between(a.sections, b.sections, aligned)
    ]
    return [a.sections[i][1] for i, _ in aligned], gaps


def _differing(a: Tree, b: Tree) -> tuple[int, list[tuple[list, list]]]:
    """The bytes of aligned sections and paragraphs, and the numbered paragraphs that lie between them."""
    whole, gaps = _opened(a, b)
    shared, left = sum(p.size for section in whole for p in section), []
    for x, y in gaps:
        pairs = _aligned([p.digest for _, p in x], [p.digest for _, p in y])
        shared += sum(x[i][1].size for i, _ in pairs)
        left += [([x[i] for i in own], [y[j] for j in other]) for own, other in _between(x, y, pairs)]
    return shared, left


def likeness(a: Tree, b: Tree) -> float:
    """Twice the aligned bytes over the bytes of both, 1 for equal roots alone."""
    if a.root == b.root:
        return 1.0
    total = sum(p.size for tree in (a, b) for _, section in tree.sections for p in section)
    if not total:
        return 0.0
    shared, left = _differing(a, b)
    for x, y in left:
        if x and y:
            leaves = [leaf for _, p in x for leaf in p.leaves]
            pairs = _aligned([d for d, _ in leaves], [d for _, p in y for d, _ in p.leaves])
            shared += sum(leaves[i][1] for i, _ in pairs)
    return min(2.0 * shared / total, 1.0 - 1e-9)


def changed_paragraphs(a: Tree, b: Tree) -> tuple[list[int], list[int]]:
    """Numbers of the paragraphs of each tree that have no equal in the other, in the order of both."""
    _, left = _differing(a, b)
    return [i for x, _ in left for i, _ in x], [j for _, y in left for j, _ in y]


def fingerprints(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """`key, fingerprint, sections`: the root and, in order, each section's digest and number of paragraphs."""
    kind = docs.schema[key].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            trees = [build(t) for t in texts(piece).to_pylist()]
            listed = [[{"digest": d.hex(), "paragraphs": len(ps)} for d, ps in t.sections] for t in trees]
            shape = pa.list_(pa.struct([("digest", pa.string()), ("paragraphs", pa.int32())]))
            yield pa.record_batch(
                [piece.column(key), pa.array([t.root for t in trees]), pa.array(listed, shape)],
                names=[key, "fingerprint", "sections"],
            )

    source = docs.select(key, F.col("text").cast("string").alias("text"))
    return source.mapInArrow(
        sign, f"`{key}` {kind}, fingerprint string, sections array<struct<digest:string,paragraphs:int>>"
    )


def _in_turn(docs: DataFrame) -> DataFrame:
    """Rows in tasks of consecutive doc_ids, descending; each task ends with a copy of the row that follows.

    Borders are quantiles of doc_id, one number per task, so texts move once and
    nothing is sampled twice.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    body = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shares = [i / parts for i in range(1, parts)]
    borders = body.agg(F.percentile_approx("doc_id", shares or [0.5])).head()[0] or []
    borders = sorted(set(borders))
    above = F.size(F.filter(F.array(*(F.lit(b).cast("long") for b in borders)), lambda b: b >= F.col("doc_id"))) if borders else F.lit(0)
    part = F.when(F.col("doc_id").isNull(), len(borders)).otherwise(above)
    placed = body.withColumn("part", part.cast("int"))
    firsts = sorted((r["part"], r["first"]) for r in placed.groupBy("part").agg(F.max("doc_id").alias("first")).collect())
    # The first row of each task also closes the task before it; the very first closes the last.
    closing = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]
    table = docs.sparkSession.createDataFrame(closing, "first long, closes int")
    # One row per task bounds this broadcast.
    marked = placed.join(F.broadcast(table), F.col("doc_id").eqNullSafe(F.col("first")), "left")
    targets = F.array(F.struct("part", F.lit(False).alias("closing")), F.struct(F.col("closes").alias("part"), F.lit(True).alias("closing")))
    dealt = marked.select("doc_id", "text", F.explode(targets).alias("to")).where("to.part IS NOT NULL")
    return (
        dealt.select("doc_id", "text", "to.part", "to.closing")
        .repartitionById(max(1, len(borders) + 1), F.col("part"))
        .sortWithinPartitions("closing", F.desc_nulls_last("doc_id"), F.xxhash64("text"), "text")
        .select("doc_id", "text", "closing")
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, and that of the text whose last half is the head of the next document's."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compare(doc_id: int | None, text: str, tree: Tree, after: str, following: Tree) -> tuple:
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        other = build(edited)
        digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        return doc_id, len(text), digest, tree.root, other.root, likeness(tree, other), likeness(tree, following)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for piece in slices(batches):
            rows = []
            for doc_id, text, closing in zip(*(piece.column(c).to_pylist() for c in ("doc_id", "text", "closing"))):
                if closing and waiting is None:
                    break
                tree = build(text)
                if waiting is not None:
                    rows.append(compare(*waiting, text, tree))
                waiting = None if closing else (doc_id, text, tree)
            if rows:
                columns = list(zip(*rows))
                kinds = [piece.schema.field("doc_id").type, pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return _in_turn(docs).mapInArrow(
        sign,
        f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
