"""Operators against brute force, round trips and held-out accuracy."""

import itertools
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from pairloom.llm.components import connected_components
from pairloom.llm.elias_fano import EliasFano
from pairloom.llm.jaccard import _visits, jaccard_components
from pairloom.llm.lm import score_texts
from pairloom.llm.merkle import _pieces, build, changed_paragraphs, likeness
from pairloom.llm.mixing import mix_sources, source_targets
from pairloom.llm.oracle import ORACLE
from pairloom.llm.packing import assemble, pack_documents
from pairloom.llm.queries import QUERIES
from pairloom.llm.roles import STATES, Costs, _close, repair_roles, steps
from pairloom.llm.warc import coalesced
from pairloom.operators.chat import CHATML, HEADERS, render_messages

SF = "/root/testdata/sf0.01"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert differences(spark, connect(SF), QUERIES[name], ORACLE[name], SF) == []


def shingles(text):
    w = WORDS.findall((text or "").translate(LOWER))
    return frozenset(zip(*(w[i:] for i in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {i: shingles(t) for i, t in rows}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, s in sets.items():
        for j, both in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_jaccard_matches_brute_force(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.where("length(text) < 4000").collect()]
    # Chains of texts about as similar as the threshold, and a large group around one text.
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(90)]
    for k in range(250):
        own = base[:]
        for at in rng.sample(range(90), rng.choice((1, 2, 3, 4, 5))):
            own[at] = f"v{rng.randrange(10**6)}"
        rows.append((100_000 + k, " ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(frame).collect()}
    assert got == brute_components(rows)


def test_alike_members_of_many_pivots_visit_few_groups(spark):
    """Members that share most tokens but have hundreds of pivots visit some groups each, not one per pivot."""
    rng = random.Random(5)
    some = lambda n: [rng.getrandbits(63) for _ in range(n)]
    base, pivots, rows = some(100), 300, []
    for i in range(3 * pivots):
        own = np.array(sorted(rng.sample(base, 80) + some(10)), dtype=np.uint64)
        rows.append((i.to_bytes(16, "big"), i.to_bytes(16, "big"), (i % pivots).to_bytes(16, "big"), own.tobytes()))
    reaching = spark.createDataFrame(rows, "set_id binary, root binary, home binary, tokens binary")
    grouped, visits = _visits(reaching, 75)
    assert grouped.count() == len(rows)
    assert 0 < visits.count() <= 12 * len(rows)


def test_jaccard_of_near_copies_and_shared_lines(spark):
    """Hundreds of near copies, a line that all documents share, passages in many, long texts, sizes about the half's corner."""
    rng = random.Random(11)
    say = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    line, rows = say(14), []

    def varied(base, most):
        own = base[:]
        for at in rng.sample(range(len(own)), min(len(own), rng.randrange(most + 1))):
            own[at] = f"v{rng.randrange(10**7)}"
        return own

    copied = say(80)
    rows += [varied(copied, 4) + line for _ in range(400)]
    passages = [say(20) for _ in range(6)]
    for _ in range(500):  # of the same passages in other order, and mostly of the shared line
        rows.append(line + [w for p in rng.sample(passages, 3) for w in p] + say(rng.randrange(6)))
    for size in (64, 65, 70, 85, 86, 100, 113, 114, 151):
        base = say(size)
        rows += [varied(base, 4) + line for _ in range(6)]
    base = say(6000)
    rows += [varied(base, 150) for _ in range(8)]
    rows = [(i, " ".join(words)) for i, words in enumerate(rows)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(frame).collect()}
    assert got == brute_components(rows)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 400)] + [(7, 7), (None, 3)]
    edges += [(2000 + rng.randrange(300), 2000 + rng.randrange(300)) for _ in range(200)]
    shuffled = dict(zip(range(3000), rng.sample(range(3000), 3000)))
    frame = spark.createDataFrame([(shuffled.get(a), shuffled.get(b)) for a, b in edges], "a int, b int").repartition(4)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(shuffled[a]), find(shuffled[b])
            parent[max(x, y)] = min(x, y)
    assert {r["node"]: r["root"] for r in connected_components(frame).collect()} == {x: find(x) for x in parent}
    assert connected_components(frame.where("false")).count() == 0


def test_packing_round_trip(docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    few = docs.where("doc_id % 10 < 3").cache()
    pieces = pack_documents(few, path, window=256)
    expected = {r["doc_id"]: [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 1] for r in few.collect()}
    rows = pieces.collect()
    own = defaultdict(dict)
    for r in rows:
        ids = np.frombuffer(r["ids"], dtype="<u4").tolist()
        assert len(ids) == r["length"] and r["doc_tokens"] == len(expected[r["doc_id"]])
        own[r["doc_id"]][r["start"]] = ids
    assert {d: [i for at in sorted(p) for i in p[at]] for d, p in own.items()} == expected
    sizes = {r["sequence_id"]: (r["n"], len(r["ids"]) // 4) for r in assemble(pieces).collect()}
    last = max(sizes)
    assert all(n == size for n, size in sizes.values()) and all(n == 256 for s, (n, _) in sizes.items() if s != last)
    for s, group in itertools.groupby(sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        at = 0
        for r in group:
            assert r["offset"] == at
            at += r["length"]


def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, target = float(sum(sizes.values())), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        above = [s for s in free if weight[s] * level > 3 * sizes[s]]
        if not above:
            return target | {s: weight[s] * level for s in free}
        for s in above:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def test_mixing_meets_targets(spark, docs):
    rows = mix_sources(docs, keep=("doc_id", "source")).collect()
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += r["__size"]
    expected = brute_targets(sizes)
    taken = Counter()
    for r in rows:
        taken[r["source"]] += r["__copies"] * r["__size"]
        assert r["__target"] == pytest.approx(expected[r["source"]]) and 0 <= r["__copies"] <= 3
    assert all(abs(taken[s] - t) <= 0.03 * t for s, t in expected.items())
    assert rows == mix_sources(docs.repartition(7), keep=("doc_id", "source")).collect() or sorted(rows) == sorted(
        mix_sources(docs.repartition(7), keep=("doc_id", "source")).collect()
    )


def test_mixing_without_rounding_emits_by_one_offset(spark):
    """Copies of a source, in order of size, are those of one running total and one offset."""
    docs = spark.createDataFrame([(i, "w " * (i + 1), "ab"[i % 2]) for i in range(60)], "doc_id long, text string, source string")
    rows = mix_sources(docs.repartition(5), keep=("doc_id", "source"), certain=None).collect()
    for name in "ab":
        own = sorted((r for r in rows if r["source"] == name), key=lambda r: r["__size"])
        rate = own[0]["__target"] / own[0]["__source_size"]
        got = [r["__copies"] for r in own]
        fits = [
            u
            for u in (k / 1000 for k in range(1000))
            if got == [int(u + rate * (i + 1) + 1e-5) - int(u + rate * i + 1e-5) for i in range(len(own))]
        ]
        assert fits, name


def test_large_documents_are_mixed_in_whole_copies(spark):
    rows = [(i, "w " * n, "a") for i, n in enumerate([900, 400, 400, 400, *[3] * 200])]
    rows += [(1000, "w " * 3000, "b"), *((1001 + i, "x " * 2, "b") for i in range(100))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    mixed = mix_sources(docs, keep=("doc_id", "source")).collect()
    assert all(0 <= r["__copies"] <= 3 for r in mixed) and len(mixed) == len(rows)
    for name in "ab":
        own = [r for r in mixed if r["source"] == name]
        taken, target = sum(r["__copies"] * r["__size"] for r in own), own[0]["__target"]
        # In b one document is nearly all: a half of it is as near as whole copies can come.
        assert abs(taken - target) <= (0.03 * target if name == "a" else 1500)
    # Equal rows share their whole copies.
    equal = spark.createDataFrame([(7, "w " * 50, "a")] * 10 + [(8, "v", "b")] * 10, "doc_id long, text string, source string")
    assert len(mix_sources(equal).collect()) == 20


def test_targets_are_capped_and_shared_again(spark):
    sizes = {"a": 10, "b": 500, "c": 300, "d": 1, None: 40, "é": 7}
    frame = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(frame, (5, 2, 1), 3).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_lm_base_score_matches_brute_force(docs):
    texts = {r["doc_id"]: WORDS.findall(r["text"].translate(LOWER)) + [None] for r in docs.collect()}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 5 == 1}
    counts = Counter(w for i, t in texts.items() if i not in held for w in t)
    n, v = sum(counts.values()), len(counts)
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    gain = Counter()
    for r in score_texts(docs, train, shards=5).collect():
        own = texts[r["doc_id"]]
        assert (r["n_tokens"], r["train_tokens"]) == (len(own), n)
        assert r["n_known"] == sum(w in counts for w in own)
        assert r["base_score"] == pytest.approx(sum(log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own), rel=1e-9)
        gain[r["doc_id"] in held] += r["score"] - r["base_score"]
    assert gain[False] > 0 and gain[True] > 0


def test_lm_is_the_same_for_any_sharding(docs):
    few = docs.where("doc_id % 5 = 0")
    a, b = (
        {r["doc_id"]: r["score"] for r in score_texts(few.repartition(n), F.col("doc_id") % 2 == 0, shards=s).collect()}
        for n, s in ((1, 2), (1, 9))
    )
    assert a.keys() == b.keys() and all(a[i] == pytest.approx(b[i], rel=1e-5) for i in a)


def test_lm_is_the_same_for_any_partitioning(docs):
    few = docs.where("doc_id % 5 = 0")
    a, b = (
        {r["doc_id"]: r["score"] for r in score_texts(few.repartition(n), F.col("doc_id") % 2 == 0, shards=4).collect()}
        for n in (1, 17)
    )
    assert a.keys() == b.keys() and all(a[i] == pytest.approx(b[i], rel=1e-9) for i in a)


def test_lm_knows_words_that_are_rare_everywhere(spark):
    # "zyxw" is once in each of many slices, "zyxv" nowhere: their letters are about as likely.
    rows = [(i, f"a{i} b{i} zyxw c{i}") for i in range(64)] + [(100, "zyxw"), (101, "zyxv")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(32)
    got = {r["doc_id"]: r["score"] for r in score_texts(frame, F.col("doc_id") < 100, shards=3).collect()}
    assert got[100] > got[101] + 1.5


def test_lm_learns_from_longer_contexts(spark):
    # "c" and "d" follow "b" alike; the word before it tells which.
    rows = [(i, "p a b c q" if i % 2 else "p e b d q") for i in range(20)] + [(1000, "p a b c q"), (1001, "p a b d q")]
    rows.append((500, " ".join(f"w{i}" for i in range(16_000))))  # so that none of them is among the most frequent
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    gap = {}
    for order in (2, 3, 4):
        got = {r["doc_id"]: r["score"] for r in score_texts(frame, F.col("doc_id") < 1000, shards=3, order=order).collect()}
        gap[order] = got[1000] - got[1001]
    assert abs(gap[2]) < 0.1 and gap[3] > 0.5 and gap[4] > 0.5


@pytest.mark.parametrize("top", [3, 1000, 2**40, 2**63])
def test_elias_fano_successor(tmp_path, top):
    rng = np.random.default_rng(top % 97)
    values = np.sort(rng.integers(0, top, 500, dtype=np.uint64))
    sequence = EliasFano(values, tmp_path, "v")
    asked = np.concatenate([values, rng.integers(0, top, 500, dtype=np.uint64), [np.uint64(0), np.uint64(top)]])
    at, found = sequence.successor(asked)
    assert (at == np.searchsorted(values, asked)).all()
    assert (found == np.isin(asked, values)).all()
    assert (sequence.get(np.arange(500)) == values).all()


def brute_repair(roles, costs=Costs()):
    """The least cost of all ways through the automaton."""
    reach = {0: 0.0}
    for role in roles:
        nxt = {}
        for s in steps(role if role in STATES[1:] else None, costs):
            if s.begin in reach:
                nxt[s.end] = min(nxt.get(s.end, 1e9), reach[s.begin] + s.cost)
        reach = nxt
    return min(c + reach[s] for s, _, c in _close(costs) if s in reach)


def cost_of(rows, costs=Costs()):
    total = 0.0
    for r in rows:
        total += {"insert": costs.insert, "relabel": costs.relabel, "merge": costs.merge, "keep": 0}[r["action"]]
    return total


def legal(rows):
    order = [r["role"] for r in rows if r["place"] == "open"]
    order = order[1:] if order[0] == "system" else order
    return order == ["user", "assistant"] * (len(order) // 2) and order


def test_roles_are_repaired_at_least_cost(spark):
    rng = random.Random(1)
    kinds = ("system", "user", "assistant", "tool", None)
    turns = {c: [rng.choice(kinds) for _ in range(rng.choice((1, 2, 3, 5, 60)))] for c in range(60)}
    turns[1000] = [rng.choice(kinds) for _ in range(900)]  # one conversation over many partitions
    frame = spark.createDataFrame(
        [(c, t, r, f"{c}-{t}") for c, own in turns.items() for t, r in enumerate(own)],
        "conv_id long, turn long, role string, text string",
    )
    rows = defaultdict(list)
    for r in repair_roles(frame, parts=16).collect():
        rows[r["conv_id"]].append(r)
    assert rows.keys() == turns.keys()
    for c, own in rows.items():
        own.sort(key=lambda r: (r["turn"], r["step"]))
        assert legal(own)
        assert [r["text"] for r in own if r["action"] != "insert"] == [f"{c}-{t}" for t in range(len(turns[c]))]
        # A merge may relabel as well, which its row doesn't tell: add it where the role changed.
        extra = sum(
            Costs().relabel
            for r in own
            if r["action"] == "merge" and turns[c][r["turn"]] != r["role"]
        )
        assert cost_of(own) + extra == pytest.approx(brute_repair(turns[c]))


@pytest.mark.parametrize("fmt", [CHATML, HEADERS])
def test_joined_rows_are_the_rendered_conversation(spark, fmt):
    rng = random.Random(2)
    kinds, said = ("system", "user", "assistant", "tool", None), ("", " \n", "\u3000", " a b ", "\tc", "d \u00a0", "e")
    turns = {c: [(rng.choice(kinds), rng.choice(said)) for _ in range(rng.choice((1, 2, 5, 40)))] for c in range(60)}
    turns[1000] = [(rng.choice(kinds), rng.choice(said)) for _ in range(900)]  # one conversation over many partitions
    turns[1001] = [("user", rng.choice(said[:3] if 20 < t < 280 else said)) for t in range(300)]  # turns of one role to merge
    frame = spark.createDataFrame(
        [(c, t, *own) for c, listed in turns.items() for t, own in enumerate(listed)],
        "conv_id long, turn long, role string, text string",
    )
    rows = defaultdict(list)
    for r in repair_roles(frame, fmt=fmt, parts=32).collect():
        rows[r["conv_id"]].append(r)
    messages = []
    for c, own in rows.items():
        own.sort(key=lambda r: (r["turn"], r["step"]))
        repaired = []
        for r in own:
            if r["place"] == "open":
                repaired.append([r["role"], r["text"]])
            else:
                repaired[-1][1] += "\n" + r["text"]
        messages.append((c, [tuple(m) for m in repaired]))
        assert legal(own)
    frame = spark.createDataFrame(messages, "conv_id long, messages array<struct<role:string,content:string>>")
    expected = {r["conv_id"]: r["text"] for r in frame.select("conv_id", render_messages("messages", fmt).alias("text")).collect()}
    assert any(r["place"] == "more" for r in rows[1001])
    assert {c: "".join(r["rendered"] for r in own) for c, own in rows.items()} == expected


def test_merkle_locates_edits():
    rng = random.Random(5)
    lines = [" ".join(f"w{rng.randrange(999)}" for _ in range(30)) + "." for _ in range(60)]
    edited = lines[:]
    edited[17] = edited[17].replace("w", "x", 1)
    a, b = build("\n".join(lines)), build("\n".join(edited))
    assert a.root != b.root and changed_paragraphs(a, b) == ([17], [17])
    assert 0.95 < likeness(a, b) < 1 and likeness(a, a) == 1
    inserted = build("\n".join([*lines[:30], "new.", *lines[30:]]))
    assert changed_paragraphs(a, inserted) == ([], [30])


def test_merkle_compares_in_order():
    rng = random.Random(6)
    lines = [" ".join(f"w{rng.randrange(999)}" for _ in range(30)) + "." for _ in range(60)]
    whole = build("\n".join(lines))
    swapped, copied = lines[:], lines[:]
    swapped[5], swapped[30] = swapped[30], swapped[5]
    copied[7] = copied[8]
    assert changed_paragraphs(whole, build("\n".join(swapped))) == ([5, 30], [5, 30])
    assert changed_paragraphs(whole, build("\n".join(copied))) == ([7], [7])
    assert likeness(whole, build("\n".join(lines[::-1]))) < 0.1
    for alphabet in ("".join(map(chr, range(0x4E00, 0x9000))), "abcdefghij", "日。"):
        text = "".join(rng.choice(alphabet) for _ in range(1001))
        assert 0.9 < likeness(build(text), build(text[:500] + "x" + text[501:])) < 1, alphabet
    assert likeness(build(""), build("a")) == 0 and likeness(build(""), build("")) == 1
    # Pieces are the text, whatever it is made of.
    for text in ("a" * 5000 + " b", "x\ud800" * 999, "é。" * 800 + "; z" * 9, " " * 999, "\u0964" * 999):
        raw = text.encode("utf-8", "surrogatepass")
        assert b"".join(_pieces(raw)) == raw


def test_merkle_query_by_brute_force(spark, docs):
    rows = {r["doc_id"]: r for r in QUERIES["op2_merkle_fingerprint"](spark, SF).collect()}
    given = sorted(((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()), reverse=True)
    assert len(rows) == len(given)
    for (doc_id, text), (_, after) in zip(given, given[1:] + given[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = rows[doc_id]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (build(text).root, build(edited).root)
        assert r["near_edited"] == likeness(build(text), build(edited))
        assert r["near_next"] == likeness(build(text), build(after))


def test_reads_are_coalesced():
    ranges = [("a", 0, 10), ("a", 10, 5), ("a", 10_000_000, 7), ("b", 0, 3)]
    assert coalesced(ranges) == [("a", 0, 15, [(0, 10), (10, 5)]), ("a", 10_000_000, 10_000_007, [(10_000_000, 7)]), ("b", 0, 3, [(0, 3)])]


def test_languages_are_told_apart(spark, docs):
    rows = QUERIES["op6_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)


def test_toxic_texts_are_found(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op3_toxicity"](spark, sf).join(labels, "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r["toxic"]]
    assert sum(r["predicted"] for r in toxic) >= 0.9 * len(toxic)
    assert not any(r["predicted"] for r in rows if not r["toxic"])


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, SF)
        assert sorted(after.columns) == sorted(docs.columns), name
        after = after.cache()
        if name == "near_duplicates":
            before = {r["doc_id"]: r["text"] for r in kept.collect()}
            heads = {root for _, root in brute_components(list(before.items())).values()}
            assert sorted(r["doc_id"] for r in after.collect()) == sorted(heads)
        kept = after
    assert corpus_pipeline.run(spark, SF).columns[0] == "doc_id"
