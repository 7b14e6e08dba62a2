"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions alone.

Every `window` consecutive words of a benchmark item are a window; an item with
fewer words is one. A window is the set of its shingles with their places. It
can only occur where all of its shingles do, so one of them is prefix enough: the
rarest, counted over all documents. Documents are cut into shingles in one pass
that keeps those of the benchmark, with the words around them. What they hold of
the windows' prefixes is joined; a window must begin within the document and fit
into it (place and length), and then its words are compared one by one with the
document's, so that a result never rests on a hash of shingles.

The benchmark's shingles are broadcast in blocks of at most `block_rows`; a larger
benchmark takes a pass over the documents per block. Documents are never shuffled:
a text leaves its row only as the few words around a benchmark shingle. Rows are
joined by their id and a 128-bit hash of the text, so repeated rows, ids and null
ids all get their own result, and hits of equal rows are combined before shuffles.
A passage that a third of the documents share makes as many rows as it has
occurrences, spread by adaptive execution.

A null or wordless text has no words and no hit; a null or wordless item has no
window. An item whose id is null goes by the empty id. Items of one id count once.
Texts may be of any length, an empty table on either side is no special case, and
columns that aren't asked for are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.session import checkpointed

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: All of ASCII but digits and lower-case letters.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ROW = ["id", "h1", "h2"]


def item_words(text: Column) -> Column:
    """A-Z folded, then runs of digits, letters a-z and everything beyond ASCII."""
    folded = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.array_remove(F.split(F.coalesce(folded, F.lit("")), _BETWEEN), "")


def _shingles(words: Column, last: Column, length: int) -> Column:
    """Hashes of the shingles that begin at 0 to `last`; null where one would pass the end."""

    def at(i: Column) -> Column:
        own = F.xxhash64(F.lit(length), *(F.get(words, i + j) for j in range(length)))
        return F.when(i <= F.size(words) - length, own)

    return F.transform(F.sequence(F.lit(0), last), at)


def benchmark_windows(items: DataFrame, window: int, shingle: int, id: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """`(item, wid)` and, for each distinct window, `(wid, words, length, k, shingle)` per shingle at place k."""
    worded = items.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("item"), item_words(F.col(text).cast("string")).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    cut = worded.where(F.size("w") > 0).select(
        "item", F.explode(F.transform(starts, lambda i: F.slice(F.col("w"), i + 1, F.lit(window)))).alias("words")
    )
    held = checkpointed(cut.withColumn("wid", F.unhex(F.sha2(F.array_join("words", " ").cast("binary"), 256))).distinct())
    windows = held.select("wid", "words").distinct().withColumn("length", F.size("words"))
    parts = []
    for length in range(1, shingle + 1):
        # Shorter windows are one shingle of their own length.
        own = F.col("length") == length if length < shingle else F.col("length") >= length
        hashes = _shingles(F.col("words"), F.col("length") - length, length)
        parts.append(windows.where(own).select("*", F.posexplode(hashes).alias("k", "shingle")))
    return held.select("item", "wid"), checkpointed(reduce(DataFrame.unionByName, parts))


def _found(docs: DataFrame, shingles: DataFrame, lengths: list[int], reach: int, id: str, text: str) -> DataFrame:
    """`_ROW + (n_words, pos, shingle, begin, near)` wherever a document holds one of `shingles(shingle)`.

    The shingle 0 stands at no word: rows of it have a null `pos` and are the documents themselves.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    worded = docs.select(
        F.col(id).alias("id"),
        F.xxhash64(body).alias("h1"),
        F.xxhash64(F.lit("second"), body).alias("h2"),
        item_words(body).alias("w"),
    )
    n = F.size("w")
    # One array as long as the text for each length of shingle, so that a place tells both.
    lists = [_shingles(F.col("w"), n - 1, k) for k in lengths]
    marker = F.array(F.lit(0).cast("bigint"))
    exploded = worded.select(*_ROW, "w", F.posexplode(F.when(n > 0, F.concat(marker, *lists)).otherwise(marker)).alias("at", "shingle"))
    met = exploded.join(F.broadcast(shingles), "shingle")
    place = F.when(F.col("at") > 0, (F.col("at") - 1) % F.greatest(n, F.lit(1)))
    begin = F.greatest(place - reach, F.lit(0))
    return met.select(
        *_ROW,
        n.cast("long").alias("n_words"),
        place.alias("pos"),
        "shingle",
        begin.alias("begin"),
        F.when(place.isNotNull(), F.slice(F.col("w"), begin + 1, F.lit(2 * reach + lengths[-1]))).alias("near"),
    )


def window_hits(
    docs: DataFrame,
    windows: DataFrame,
    window: int,
    shingle: int,
    id: str = "doc_id",
    text: str = "text",
    block_rows: int = 1_000_000,
) -> tuple[DataFrame, DataFrame]:
    """All documents as `_ROW + n_words`, and the windows they hold as `_ROW + (start, length, wid)`."""
    vocabulary = checkpointed(windows.select("shingle").distinct())
    blocks = max(1, -(-vocabulary.count() // block_rows))
    lengths = sorted(
        {r["n"] for r in windows.select(F.least("length", F.lit(shingle)).alias("n")).distinct().collect()} | {shingle}
    )
    passes = []
    for b in range(blocks):
        own = vocabulary.where(F.pmod("shingle", F.lit(blocks)) == b)
        if b == 0:
            own = own.unionByName(docs.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("shingle"))).distinct()
        passes.append(_found(docs, own, lengths, window - shingle, id, text))
    found = checkpointed(reduce(DataFrame.unionByName, passes))
    rows = found.where("pos is null").select(*_ROW, "n_words")
    found = found.where("pos is not null")

    counts = found.groupBy("shingle").agg(F.count("*").alias("n"))
    rarest = (
        windows.join(counts, "shingle", "left")
        .groupBy("wid", "words", "length")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "k")).alias("prefix"))
        .where("prefix.n > 0")
        .select("wid", "words", "length", "prefix.shingle", "prefix.k")
    )
    start = F.col("pos") - F.col("k")
    placed = found.join(rarest, "shingle").withColumn("start", start)
    fits = (F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words"))
    same = F.slice(F.col("near"), F.greatest(F.col("start") - F.col("begin"), F.lit(0)) + 1, F.col("length")) == F.col("words")
    return rows, placed.where(fits & same).select(*_ROW, "start", "length", "wid")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    shingle: int = 5,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_rows: int = 1_000_000,
) -> DataFrame:
    """`id, n_words, n_hit, items`: words, words inside any occurrence of a window, ids of the items found, as sorted texts."""
    if not 1 <= shingle <= window:
        raise ValueError("a shingle has at least one word and at most those of a window")
    members, windows = benchmark_windows(items, window, shingle, item_id, item_text)
    rows, hits = window_hits(docs, windows, window, shingle, id, text, block_rows)
    hits = checkpointed(hits.distinct())

    spans = hits.groupBy(*_ROW, "start").agg(F.max("length").alias("length"))
    earlier = Window.partitionBy(*_ROW).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    covered = F.greatest(end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(earlier), F.lit(0))), F.lit(0))
    counted = spans.select(*_ROW, covered.alias("own")).groupBy(*_ROW).agg(F.sum("own").cast("long").alias("n_hit"))
    named = (
        hits.select(*_ROW, "wid").distinct().join(members, "wid").groupBy(*_ROW).agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    found = counted.join(named, *_null_safe(counted, named)).select(*(counted[c] for c in _ROW), "n_hit", "items")
    return rows.join(found, *_null_safe(rows, found, "left")).select(
        rows["id"].alias(id),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _null_safe(left: DataFrame, right: DataFrame, how: str = "inner") -> tuple[Column, str]:
    return reduce(Column.__and__, (left[c].eqNullSafe(right[c]) for c in _ROW)), how
