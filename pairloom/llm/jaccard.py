"""N-gram Jaccard join with a token-group matrix.

Documents are sets of word shingles. Equal sets are one member. Members are put
in groups of similar ones: minhash buckets name a pivot each, verified members
of a pivot are linked to it, and members that share a pivot go to one group. The
token-group matrix holds which groups' token unions have a token. A member's
overlap with a group's union bounds its overlap with every member of it, and a
link needs an overlap of three quarters of its own tokens. Groups whose union
can't give that are never opened; the others are opened and their members
compared exactly, so no link is lost. All links together make the components.

The bound is taken twice. First coarsely, for all documents and before any
grouping, on the half of the tokens with the smaller hashes (all tokens of short
documents): tokens travel packed by bucket, a task sends a token of several
documents once, and a member is credited for each token that another has. Then
again among the survivors, with linked members counting as one, and at last for
each member and each group that has one of its rarest tokens, over all tokens, where
the group is opened. Token ids of 32 bits serve the first two bounds,
where a collision can only widen a bound; sets are compared on 64 bits.

Null, empty and wordless texts have no shingles, link with nothing and are their
own component. A text of fewer words than a shingle is one shingle. Rows that
repeat a doc_id are rows of their own. A component's id is its smallest doc_id,
null doc_ids aside. An empty table gives an empty result; other columns are
ignored. Very long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.components import connected_components, meet
from pairloom.llm.text import mix, release, slices, split_words, texts
from pairloom.session import checkpointed, free_unused

#: Up to so many shingles a document is probed with all of them, and a document that could link with it sends all.
_ALL_BELOW = 64
_HALF = np.uint64(1 << 63)
_BANDS, _ROWS, _AGREE = 16, 2, 4
#: Members of a group that is opened as a whole, and their mean tokens; longer ones count as several.
_GROUP, _MEAN = 512, 1024
#: Bytes of a group's rows from which its task gives freed memory back at once.
_LARGE = 1 << 22
#: Bits of the prefilter for survivors' texts; beyond its capacity it lets more through, never less.
_FILTER_BITS = 1 << 23


def shingle_sets(text: pa.Array, width: int) -> list[np.ndarray]:
    """For each text its sorted distinct shingle hashes."""
    words = split_words(text, lower=True)
    hashed = words.hashes()[words.codes] if len(words.codes) else np.zeros(0, dtype=np.uint64)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    full = max(0, len(hashed) - width + 1)
    windows = np.zeros(full, dtype=np.uint64)
    for j in range(width if full else 0):
        windows += hashed[j : j + full] * factors[j]
    windows = mix(windows)
    out = []
    for end, count in zip(words.ends, words.counts):
        begin = end - count
        if count >= width:
            out.append(np.unique(windows[begin : end - width + 1]))
        elif count:
            short = (hashed[begin:end] * factors[:count]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(short + np.uint64(count)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def _set_id(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def _short(ids: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(ids), dtype="<i8")[::2] if ids else np.zeros(0, dtype=np.int64)


def set_table(docs: DataFrame, width: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """`(doc_id, n_shingles, set_id, member, probed)` and the columns in `keep`; null set_id without shingles.

    `member` is a short form of set_id, `probed` the number of tokens the first bound looks at.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    kept = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            sets = shingle_sets(texts(piece), width)
            ids = [_set_id(s) for s in sets]
            probed = [len(s) if len(s) <= _ALL_BELOW else int(np.searchsorted(s, _HALF)) for s in sets]
            yield pa.record_batch(
                [
                    piece.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([i if len(s) else None for i, s in zip(ids, sets)], pa.binary()),
                    pa.array(_short(ids)),
                    pa.array(probed, pa.int64()),
                    *(piece.column(c) for c in keep),
                ],
                names=["doc_id", "n_shingles", "set_id", "member", "probed", *keep],
            )

    return docs.select("doc_id", "text", *keep).mapInArrow(
        sketch, f"doc_id {kind}, n_shingles bigint, set_id binary, member bigint, probed bigint{kept}"
    )


def _packed(owned: list[tuple[int, int, np.ndarray]], threshold: float, buckets: int) -> Iterator[pa.RecordBatch]:
    """Tokens of `(owner, member, sorted set)` by bucket; an owner of 0 stands for several owners."""
    if not owned:
        return
    sent_all = int(_ALL_BELOW / threshold)
    parts = [s if len(s) <= sent_all else s[: np.searchsorted(s, _HALF)] for *_, s in owned]
    lengths = [len(p) for p in parts]
    tokens = np.concatenate(parts)
    index = np.repeat(np.arange(len(owned), dtype=np.int32), lengths)
    longer = np.repeat([_ALL_BELOW < len(s) <= sent_all for *_, s in owned], lengths)
    owner = np.array([o for o, *_ in owned], dtype=np.int64)[index]
    # A document too long to be probed with all its tokens still sends them, but isn't credited for the upper half.
    member = np.where(longer & (tokens >= _HALF), 0, np.array([m for _, m, _ in owned], dtype=np.int64)[index])
    bucket = ((tokens >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
    short = tokens.astype(np.uint32)
    order = np.lexsort((short, bucket))
    bucket, short, owner, member = bucket[order], short[order], owner[order], member[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (short[1:] != short[:-1])
    start = np.flatnonzero(new)
    several = np.minimum.reduceat(owner, start) != np.maximum.reduceat(owner, start)
    run = np.cumsum(new) - 1
    # Known to be shared: credited here, and sent once.
    known = several[run]
    credited, credits = np.unique(member[known & (member != 0)], return_counts=True)
    if len(credited):
        yield pa.record_batch(
            [pa.array([-1], pa.int32()), *(pa.array([x], pa.binary()) for x in (b"", b"", credited.tobytes(), credits.astype(np.int64).tobytes()))],
            names=["bucket", "tokens", "owners", "members", "credits"],
        )
    kept = ~known | new
    owner = np.where(known, 0, owner)[kept]
    member = np.where(known, 0, member)[kept]
    bucket, short = bucket[kept], short[kept]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    columns = [np.split(x, cuts) for x in (bucket, short, owner, member)]
    same = [np.array_equal(o, m) for o, m in zip(columns[2], columns[3])]
    yield pa.record_batch(
        [
            pa.array([int(b[0]) for b in columns[0]], pa.int32()),
            pa.array([t.tobytes() for t in columns[1]], pa.binary()),
            pa.array([_listed(o) for o in columns[2]], pa.binary()),
            pa.array([b"" if s else _listed(m) for s, m in zip(same, columns[3])], pa.binary()),
            pa.array([b""] * len(cuts) + [b""], pa.binary()),
        ],
        names=["bucket", "tokens", "owners", "members", "credits"],
    )


def _listed(values: np.ndarray) -> bytes:
    """Distinct values once, then a number of two or four bytes for each place."""
    distinct, place = np.unique(values, return_inverse=True)
    kind = np.uint16 if len(distinct) <= 1 << 16 else np.uint32
    return len(distinct).to_bytes(4, "little") + distinct.tobytes() + place.astype(kind).tobytes()


def _unlisted(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:4], "little")
    distinct = np.frombuffer(packed, dtype=np.int64, count=n, offset=4)
    return distinct[np.frombuffer(packed, dtype=np.uint16 if n <= 1 << 16 else np.uint32, offset=4 + 8 * n)]


_PACKED = "bucket int, tokens binary, owners binary, members binary, credits binary"


def _by_part(member: np.ndarray, credit: np.ndarray, parts: int) -> pa.Table:
    """Members and credits packed by a part of the members' range, one row each."""
    part = (member.view(np.uint64) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    part, member, credit = part[order], member[order], credit[order]
    cuts = np.flatnonzero(np.diff(part)) + 1
    groups = [(int(p[0]), m.tobytes(), c.tobytes()) for p, m, c in zip(*(np.split(x, cuts) for x in (part, member, credit))) if len(p)]
    kinds = (pa.int32(), pa.binary(), pa.binary())
    return pa.table([pa.array([g[i] for g in groups], k) for i, k in enumerate(kinds)], names=["part", "members", "credits"])


def _summed(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    member = np.concatenate([np.frombuffer(b, dtype=np.int64) for b in table.column("members").to_pylist()])
    credit = np.concatenate([np.frombuffer(b, dtype=np.int64) for b in table.column("credits").to_pylist()])
    distinct, place = np.unique(member, return_inverse=True)
    return distinct, np.bincount(place, weights=credit, minlength=len(distinct)).astype(np.int64)


def _total(table: pa.Table) -> pa.Table:
    return pa.table(list(_summed(table)), names=["member", "credit"])


def _credits(table: pa.Table, parts: int) -> pa.Table:
    """For each member the tokens in this bucket that another owner has as well."""
    if table.column("bucket")[0].as_py() < 0:
        return _by_part(*_summed(table), parts)
    owners = [_unlisted(b) for b in table.column("owners").to_pylist()]
    members = [_unlisted(b) if b else o for b, o in zip(table.column("members").to_pylist(), owners)]
    token = np.concatenate([np.frombuffer(b, dtype=np.uint32) for b in table.column("tokens").to_pylist()])
    owner, member = np.concatenate(owners), np.concatenate(members)
    order = np.argsort(token)
    token, owner, member = token[order], owner[order], member[order]
    new = np.ones(len(token), dtype=bool)
    new[1:] = token[1:] != token[:-1]
    start = np.flatnonzero(new)
    low, high = np.minimum.reduceat(owner, start), np.maximum.reduceat(owner, start)
    none = np.logical_or.reduceat(owner == 0, start)
    shared = ((low != high) | none)[np.cumsum(new) - 1] & (member != 0)
    distinct, count = np.unique(member[shared], return_counts=True)
    del owners, members, token, owner, member, order, new, start, low, high, none, shared
    credited = _by_part(distinct, count.astype(np.int64), parts)
    release()
    return credited


def _buckets(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _shared_credits(packed: DataFrame) -> DataFrame:
    """`(member, credit)` from packed rows; credits given in the tasks are spread over the groups' tasks."""
    parts = _buckets(packed)
    spread = F.when(F.col("bucket") < 0, F.pmod(F.xxhash64("members"), F.lit(parts))).otherwise(F.lit(0))
    return (
        packed.withColumn("spread", spread)
        .groupBy("bucket", "spread")
        .applyInArrow(lambda table: _credits(table, parts), "part int, members binary, credits binary")
        .groupBy("part")
        .applyInArrow(_total, "member bigint, credit bigint")
    )


def _least_overlap(n: Column, percent: int) -> Column:
    """The smallest whole number of at least `percent` of n."""
    return F.floor((n * percent + 99) / 100).cast("bigint")


def _open(credit: Column, n: Column, probed: Column, percent: int) -> Column:
    """Whether so many shared tokens leave room for a link: the tokens not looked at may all be shared."""
    return credit >= probed - n + _least_overlap(n, percent)


def _minhash(tokens: np.ndarray) -> list[int]:
    seeds = mix(np.arange(1, _BANDS * _ROWS + 1, dtype=np.uint64))
    least = mix(tokens[None, :] ^ seeds[:, None]).min(axis=1).reshape(_BANDS, _ROWS)
    banded = mix(least[:, 0] + mix(least[:, 1] + np.arange(_BANDS, dtype=np.uint64)))
    return banded.view(np.int64).tolist()


def _survivor_sets(docs: DataFrame, survivors: DataFrame, width: int) -> DataFrame:
    """`(set_id, tokens, bands)` of the survivors, from one row's text each."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(_FILTER_BITS)) + 1
    # A bitmap of _FILTER_BITS bits in rows of 4 KB: a size of 1 MB, whatever the number of survivors.
    rows = (
        survivors.select(bit.alias("bit"))
        .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
        .collect()
    )
    wanted = np.zeros(_FILTER_BITS + (1 << 15) + 1, dtype=bool)
    for r in rows:
        own = np.unpackbits(np.frombuffer(r["bits"], dtype=np.uint8), bitorder="little").astype(bool)
        begin = (r["bucket"] - 1) * (1 << 15) + 1
        wanted[begin : begin + len(own)] = own
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing = np.unpackbits(shared.value)

        def held() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                chosen = passing[batch.column("bit").to_numpy()].astype(bool)
                if chosen.any():
                    yield batch.filter(pa.array(chosen))

        for piece in slices(held()):
            sets = [s for s in shingle_sets(texts(piece), width) if len(s)]
            yield pa.record_batch(
                [
                    pa.array([_set_id(s) for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([_minhash(s) for s in sets], pa.list_(pa.int64())),
                ],
                names=["set_id", "tokens", "bands"],
            )

    found = docs.select(bit.alias("bit"), "text").mapInArrow(sketch, "set_id binary, tokens binary, bands array<bigint>")
    return found.join(survivors.select("set_id"), "set_id", "left_semi").dropDuplicates(["set_id"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs `(a, b)` whose sets are similar enough, compared exactly."""

    @F.arrow_udf("boolean")
    def linked(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(left, right):
            a, b = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
            both = len(a) + len(b) - len(np.union1d(a, b))
            out.append(100 * both >= percent * (len(a) + len(b) - both))
        return pa.array(out, pa.bool_())

    own = sets.select(F.col("set_id").alias("a"), F.col("tokens").alias("left"))
    other = sets.select(F.col("set_id").alias("b"), F.col("tokens").alias("right"))
    return pairs.join(own, "a").join(other, "b").where(linked("left", "right")).select("a", "b")


def _pivot_pairs(sets: DataFrame) -> DataFrame:
    """`(a, b, agreeing)`: members, pivots that they meet in a bucket, and in how many.

    The pivot of a bucket is its member that meets the most others over all
    buckets, so the text that copies derive from draws them all.
    """
    banded = sets.select("set_id", F.explode("bands").alias("bucket"))
    crowded = banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    met = checkpointed(banded.join(crowded, "bucket"))
    drawn = met.groupBy("set_id").agg(F.sum("size").alias("met"))
    pivots = (
        met.join(drawn, "set_id")
        .groupBy("bucket")
        .agg(F.max_by("set_id", F.struct("met", "set_id")).alias("b"))
    )
    return (
        met.select("bucket", F.col("set_id").alias("a"))
        .join(pivots, "bucket")
        .where("a <> b")
        .groupBy("a", "b")
        .agg(F.count("*").alias("agreeing"))
    )


def _homes(pairs: DataFrame) -> DataFrame:
    """`(set_id, home)`: what members that meet often have in common.

    That is their component while it has few members; in a larger one it is the
    pivot that a member is most like, pivots being at home with themselves.
    """
    near = pairs.where(F.col("agreeing") >= _AGREE - 1)
    whole = connected_components(near.select("a", "b")).withColumnRenamed("node", "set_id")
    few = whole.groupBy("root").count().where(F.col("count") <= _GROUP).select("root", F.lit(True).alias("few"))
    best = near.groupBy(F.col("a").alias("set_id")).agg(F.max_by("b", F.struct("agreeing", "b")).alias("best"))
    pivots = near.select(F.col("b").alias("set_id")).distinct().withColumn("pivot", F.lit(True))
    own = F.when(F.col("few"), F.col("root")).when(F.col("pivot"), F.col("set_id")).otherwise(F.coalesce("best", "set_id"))
    joined = whole.join(few, "root", "left").join(best, "set_id", "left").join(pivots, "set_id", "left")
    return joined.select("set_id", own.alias("home"))


def _group_links(percent: int):
    """Roots linked by a group's own members (side 1) and visiting ones (side 0); of those that hang together
    already one link suffices."""

    def links(table: pa.Table) -> pa.Table:
        sides = table.column("side").to_numpy()
        roots = np.array(table.column("root").to_pylist(), dtype=object)
        sets = [np.frombuffer(t, dtype=np.uint64) for t in table.column("tokens").to_pylist()]
        sizes = np.array([len(s) for s in sets])
        number = {r: i for i, r in enumerate(dict.fromkeys(roots))}
        parent = list(range(len(number)))
        root = np.array([number[r] for r in roots])

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        distinct, code = np.unique(np.concatenate(sets), return_inverse=True)
        held = np.zeros((2, len(distinct)), dtype=bool)
        held[np.repeat(sides, sizes), code] = True
        common = held.all(axis=0)
        column = np.cumsum(common) - 1
        ends = np.cumsum(sizes)
        own = [column[c[common[c]]] for c in (code[e - n : e] for e, n in zip(ends, sizes))]
        width = int(common.sum())
        # The bound on whole sets: a visitor's overlap with the union of the group.
        need = (sizes * percent + 99) // 100
        left = np.array([i for i in np.flatnonzero(sides == 0) if len(own[i]) >= need[i]], dtype=np.int64)
        right = np.flatnonzero(sides == 1)
        # Two blocks of at most 32 MB, or two members.
        step = max(1, min(128, (1 << 23) // max(1, width)))

        def matrix(rows: np.ndarray) -> np.ndarray:
            out = np.zeros((len(rows), width), dtype=np.float32)
            for at, i in enumerate(rows):
                out[at, own[i]] = 1
            return out

        names = list(number)
        found: list[tuple[bytes, bytes]] = []
        for q in range(0, len(right), step):
            others = right[q : q + step]
            b = matrix(others).T
            for p in range(0, len(left), step):
                some = left[p : p + step]
                if len(set(root[some]) | set(root[others])) == 1:
                    continue
                both = matrix(some) @ b
                whole = sizes[some][:, None] + sizes[others][None, :] - both
                for i, j in zip(*np.nonzero(100 * both >= percent * whole)):
                    one, two = root[some[i]], root[others[j]]
                    x, y = find(one), find(two)
                    if x != y:
                        parent[x] = y
                        found.append((names[one], names[two]))
        del sets, distinct, code, held, own
        if table.nbytes > _LARGE:
            release()
        return pa.table({"a": pa.array([f[0] for f in found], pa.binary()), "b": pa.array([f[1] for f in found], pa.binary())})

    return links


def _half_says_nothing(n: Column, half: Column, percent: int) -> Column:
    """Whether a member's tokens of smaller hash may all be missing from a partner."""
    return half - n + _least_overlap(n, percent) < 1


def _visits(reaching: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """`(set_id, r, g)`, the group of each member `(set_id, root, home, tokens)`, and `(set_id, n, g)`, the groups it visits.

    Members that share a pivot stay together. A root or home with many members has
    groups of its own; the others are put with those of the same most common token.
    Groups hold about `_GROUP` members, fewer of many tokens. The matrix has a cell for each group and token
    of its union. A member looks up its rarest tokens there, and of two that link
    only the smaller one has to: a cell holds the sizes of its members too.
    """

    @F.arrow_udf("bigint")
    def below_half(packed: pa.Array) -> pa.Array:
        values = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in packed)
        return pa.array([int(np.searchsorted(v, _HALF)) for v in values], pa.int64())

    @F.arrow_udf("array<bigint>")
    def listed(packed: pa.Array, sent: pa.Array) -> pa.Array:
        values = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in packed)
        return pa.array([v[:k].view(np.int64) for v, k in zip(values, sent.to_pylist())], pa.list_(pa.int64()))

    n, half = F.col("n"), F.col("half")
    size = (F.octet_length("tokens") / 8).cast("bigint")
    counted = reaching.select("set_id", F.xxhash64("root").alias("r"), size.alias("n"), "tokens", below_half("tokens").alias("half"))
    # Where half may tell nothing a member asks with all its tokens, so all it could link with must send all of theirs.
    asking_all = (n <= _ALL_BELOW) | _half_says_nothing(n, half, percent)
    longest = counted.where(asking_all).agg(F.max("n")).head()[0] or _ALL_BELOW
    sends_all = n <= max(_ALL_BELOW, longest) * 100 // percent
    sent = counted.select(
        "set_id",
        "r",
        "n",
        F.when(asking_all, n).otherwise(half).alias("asks"),
        F.explode(listed("tokens", F.when(sends_all, n).otherwise(half))).alias("token"),
    )
    frequent = (
        sent.groupBy("token")
        .agg(F.min("r").alias("low"), F.max("r").alias("high"), F.count("*").alias("holders"))
        .where("low <> high")
        .select("token", "holders")
    )
    shared = checkpointed(sent.join(frequent, "token"))
    # Members of one pivot stay together, and small such units are put with others of the same most common token:
    # alike members that found no common pivot are in few groups, however many they are.
    leads = shared.groupBy("set_id").agg(F.max(F.struct("holders", "token")).alias("lead"))
    many = reaching.groupBy("root").count().where(F.col("count") >= _GROUP).select("root", F.lit(True).alias("pure"))
    unit = F.when(F.col("pure"), F.xxhash64("root", F.lit(1))).otherwise(F.xxhash64("home", F.lit(2)))
    placed = reaching.join(leads, "set_id").join(many, "root", "left").select(
        "set_id", "root", "lead", unit.alias("unit"), F.greatest(F.lit(1.0), size / _MEAN).alias("weight")
    )
    own = F.col("size") >= _GROUP
    units = checkpointed(
        placed.groupBy("unit")
        .agg(F.sum("weight").alias("size"), F.max("lead").alias("lead"))
        .select("unit", "size", own.alias("own"), F.when(own, F.col("unit")).otherwise(F.col("lead.token")).alias("pool"))
    )
    sizes = units.groupBy("own", "pool").agg(F.ceil(F.sum("size") / _GROUP).alias("groups"))
    within = F.pmod(F.when(F.col("own"), F.xxhash64("set_id")).otherwise(F.col("unit")), F.col("groups"))
    grouped = checkpointed(
        placed.join(units.join(sizes, ["own", "pool"]), "unit").select(
            "set_id", F.xxhash64("root").alias("r"), F.xxhash64("own", "pool", within).alias("g")
        )
    )
    # A group of one root is of no use to that root's members, and of two that link the smaller one visits.
    cells = checkpointed(
        shared.join(grouped.select("set_id", "g"), "set_id")
        .groupBy("token", "g")
        .agg(F.min("r").alias("low"), F.max("r").alias("high"), F.min("n").alias("least"), F.max("n").alias("most"))
    )
    other = (F.col("low") != F.col("high")) | (F.col("low") != F.col("r"))
    large = (F.col("most") >= n) & (F.col("least") * percent <= n * 100)
    asked = shared.where((F.col("asks") == n) | (F.col("token") >= 0))
    need = F.col("asks") - n + _least_overlap(n, percent)
    rare = asked.groupBy("set_id", "r", "n", "asks").agg(F.array_sort(F.collect_list(F.struct("holders", "token"))).alias("rare"))
    able = rare.where(F.size("rare") >= need).select(
        "set_id", "r", "n", F.explode(F.slice(F.col("rare.token"), F.lit(1), (F.size("rare") - need + 1).cast("int"))).alias("token")
    )
    visits = checkpointed(able.join(cells, "token").where(other & large).select("set_id", "n", "g").distinct())
    return grouped, visits


def _between_groups(reaching: DataFrame, percent: int) -> DataFrame:
    """Roots `(a, b)` that links between members `(set_id, root, home, tokens)` join, by the token-group matrix.

    A member goes to each group it visits once, with all its tokens, and is counted
    against the group's union there; only where that allows for a link is it compared.
    A group with many visitors is opened in several tasks.
    """
    grouped, visits = _visits(reaching, percent)
    free_unused(reaching.sparkSession)
    # Visitors of a group are dealt over tasks; its own members are repeated for each.
    weight = F.greatest(F.lit(1.0), 4 * F.col("n") / _MEAN)
    tasks = checkpointed(visits.groupBy("g").agg(F.ceil(F.sum(weight) / (8 * _GROUP)).cast("int").alias("tasks")))
    sets = reaching.select("set_id", "root", "tokens")
    visiting = visits.join(tasks, "g").select("set_id", "g", F.pmod(F.xxhash64("set_id"), "tasks").cast("int").alias("task"))
    hosting = grouped.join(tasks, "g").select("set_id", "g", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"))
    sides = [w.join(sets, "set_id").withColumn("side", F.lit(k)) for k, w in enumerate((visiting, hosting))]
    return sides[0].unionByName(sides[1]).groupBy("g", "task").applyInArrow(_group_links(percent), "a binary, b binary")


def _rooted(docs: DataFrame, width: int, percent: int, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """The set table of the rows, and `(set_id, doc_id, root)`: each set's smallest id and component."""
    threshold, buckets = percent / 100, _buckets(docs)

    def pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            sets = [s for s in shingle_sets(texts(piece), width) if len(s)]
            members = _short([_set_id(s) for s in sets]).tolist()
            yield from _packed([(m, m, s) for m, s in zip(members, sets)], threshold, buckets)

    def pack_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "tokens"):
            sets = [np.frombuffer(t, dtype=np.uint64) for t in piece.column("tokens").to_pylist()]
            members = _short(piece.column("set_id").to_pylist()).tolist()
            owners = _short(piece.column("root").to_pylist()).tolist()
            yield from _packed(list(zip(owners, members, sets)), threshold, buckets)

    rows = checkpointed(set_table(docs, width, keep))
    members = rows.where("set_id IS NOT NULL").groupBy("set_id").agg(
        F.min("doc_id").alias("doc_id"),
        F.count("*").alias("copies"),
        F.first("member").alias("member"),
        F.first("n_shingles").alias("n"),
        F.first("probed").alias("probed"),
    )
    credits = _shared_credits(docs.select("text").mapInArrow(pack_texts, _PACKED))
    # Every copy of a set was credited alike.
    credit = F.coalesce(F.col("credit"), F.lit(0)) / F.col("copies")
    survivors = checkpointed(
        members.join(credits, "member", "left").where(_open(credit, F.col("n"), F.col("probed"), percent)).select("set_id", "doc_id")
    )
    del credits, credit
    sets = checkpointed(_survivor_sets(docs, survivors, width))
    free_unused(docs.sparkSession)
    pairs = checkpointed(_pivot_pairs(sets))
    links = checkpointed(_verified(pairs.where(F.col("agreeing") >= _AGREE).select("a", "b"), sets, percent))
    groups = connected_components(links)
    grouped = checkpointed(
        sets.drop("bands")
        .join(groups.withColumnRenamed("node", "set_id"), "set_id", "left")
        .join(_homes(pairs), "set_id", "left")
        .select("set_id", "tokens", F.coalesce("root", "set_id").alias("root"), F.coalesce("home", "set_id").alias("home"))
    )
    del sets, pairs, links
    free_unused(docs.sparkSession)
    again = _shared_credits(grouped.mapInArrow(pack_groups, _PACKED))
    sized = rows.where("set_id IS NOT NULL").select("set_id", "member", F.col("n_shingles").alias("n"), "probed").dropDuplicates(["set_id"])
    reaching = (
        sized.join(again, "member", "left")
        .where(_open(F.coalesce(F.col("credit"), F.lit(0)), F.col("n"), F.col("probed"), percent))
        .select("set_id")
    )
    # Between roots only: what hangs together already is one node there.
    reached = checkpointed(grouped.join(reaching, "set_id", "left_semi"))
    del grouped, again, reaching
    free_unused(docs.sparkSession)
    between = connected_components(_between_groups(reached, percent))
    first = members.select("set_id", "doc_id").join(groups.withColumnRenamed("node", "set_id"), "set_id", "left")
    named = first.select("set_id", "doc_id", F.coalesce("root", "set_id").alias("root"))
    wider = between.select(F.col("node").alias("root"), F.col("root").alias("whole"))
    rooted = meet(named, "set_id", wider, "root", "left").select("set_id", "doc_id", F.coalesce("whole", "root").alias("root"))
    return rows, checkpointed(rooted)


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """`(doc_id, n_shingles, component_id)` of every row.

    Two documents link when 100 * intersection >= percent * union of their shingle sets.
    """
    rows, rooted = _rooted(docs.select("doc_id", F.col("text").cast("string").alias("text")), width, percent)
    smallest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = rooted.join(smallest, "root").select("set_id", "component_id")
    return rows.join(classes, "set_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def nearest_kept(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """One row of each component: the one with the smallest doc_id, null last, then the smallest text hash.

    Rows are told apart by two hashes of id and text, so one id may stand for several
    texts; of rows equal in both one stays. Wordless texts are components of their
    own and all stay.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = ("__row_a", "__row_b")
    named = docs.withColumns({row[0]: F.xxhash64(text), row[1]: F.xxhash64(F.lit(1), text, F.col("doc_id"))})
    rows, rooted = _rooted(named.select("doc_id", F.col("text").cast("string").alias("text"), *row), width, percent, row)
    # Counts first, so that copies of a row meet in their task already.
    placed = (
        rows.where("set_id IS NOT NULL")
        .groupBy("set_id", "doc_id", *row)
        .agg(F.count("*").alias("n"))
        .join(rooted.select("set_id", "root"), "set_id")
    )
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *row, "n")).alias("least")
    chosen = placed.groupBy("root").agg(least).select(*(f"least.{c}" for c in row), (F.col("least.n") > 1).alias("__many"))
    wordless = rows.where("set_id IS NULL").select(*row, F.lit(False).alias("__many")).distinct()
    kept = named.join(checkpointed(chosen.unionByName(wordless)), list(row))
    single, repeated = kept.where("NOT __many"), kept.where("__many").dropDuplicates(list(row))
    return single.select(*docs.columns).unionByName(repeated.select(*docs.columns))
