"""The manifest, decontamination and whitening operators against brute force, and their edges."""

import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import manifest as merkle
from pairloom.llm.decontaminate import decontaminate
from pairloom.llm.manifest import FIELDS, fold, manifest, sibling_texts, tree_levels
from pairloom.llm.queries import QUERIES
from pairloom.llm.whitening import covariance, scaled_vectors, whiten

ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def known(row):
    return tuple((v is None, str(v)) for v in row)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(r, text):
    values = [text if f == "text" else r[f] for f in FIELDS]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def brute_path(levels, at):
    path = []
    for level in levels[:-1]:
        first = at - at % 3
        path.append(("".join(level[first:at]), "".join(level[at + 1 : first + 3])))
        at //= 3
    return path


def brute_manifest(rows, now):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    leaves = {
        s: sorted(((r["doc_id"] is not None, r["doc_id"] or 0, brute_leaf(r, r["text"]), brute_leaf(r, now(r))) for r in by_source[s]))
        for s in sources
    }
    trees = {s: brute_levels([x[2] for x in leaves[s]]) for s in sources}
    over = brute_levels([trees[s][-1][0] for s in sources])
    root, out = over[-1][0], []
    for k, s in enumerate(sources):
        for at, (named, doc_id, leaf, folded) in enumerate(leaves[s]):
            path = brute_path(trees[s], at) + brute_path(over, k)
            for before, after in path:
                folded = sha(before + folded + after)
            proof = sha("".join(b + a for b, a in path))
            out.append((doc_id if named else None, leaf, trees[s][-1][0], root, proof, folded, folded == root))
    return out


def test_manifest_matches_brute_force(spark):
    """Sources of one row, of one superblock and of several; null and repeated ids; equal rows; clashing columns."""
    rows = [
        (i if i % 7 else None, None if i % 3 == 0 else f"s{i % 50}", "en" if i % 5 else None, i, None if i % 11 == 0 else f"a\nb{i // 2}")
        for i in range(7500)
    ]
    rows += [(5, "s5", "en", 5, "a\nb")] * 20 + [(-3, "lone", None, None, "x" * 200_000 + "\n"), (9, "", "é", 1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").select(
        "*", *(F.lit("clash").alias(c) for c in ("pos", "leaf", "tree", "node", "block", "place", "before"))
    )
    lost = F.when(F.col("doc_id") % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    got = [tuple(r) for r in manifest(docs.repartition(13), now={"text": lost}).collect()]
    strip = lambda r: r["text"].replace("\n", "") if r["doc_id"] is not None and r["doc_id"] % 2 == 0 and r["text"] else r["text"]
    expected = brute_manifest([r.asDict() for r in docs.collect()], strip)
    assert sorted(got, key=known) == sorted(expected, key=known)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_edges(spark):
    docs = spark.createDataFrame([(1, "a", "en", 1, "t")], "doc_id long, source string, lang string, n_chars long, text string")
    assert manifest(docs.where("false")).collect() == []
    (row,) = manifest(docs).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["verified"] and row["proof_sha256"] == sha("")


def test_manifest_of_text_ids(spark):
    docs = spark.createDataFrame([("b", None, "x"), ("a", None, None), (None, None, "y")], "key string, site string, body string")
    got = {r["key"]: r for r in manifest(docs, ("key", "body"), "key", "site").collect()}
    order = [got[None]["leaf"], got["a"]["leaf"], got["b"]["leaf"]]
    assert all(r["verified"] and r["root"] == sha("".join(order)) for r in got.values())


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28])
def test_proofs_lead_to_the_root(n):
    nodes = [sha(str(i)) for i in range(n)]
    levels = tree_levels(nodes)
    for at in range(n):
        path = [sibling_texts(level, at // 3**k) for k, level in enumerate(levels[:-1])]
        assert fold(nodes[at], path) == levels[-1][0]
        assert fold(sha("other"), path) != levels[-1][0]
    assert len(tree_levels(nodes, merkle.DEPTH)) == merkle.DEPTH + 1


def brute_leaks(docs, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        w = ITEM_WORDS.findall((text or "").translate(LOWER))
        for k in range(max(1, len(w) - window + 1)) if w else ():
            windows[tuple(w[k : k + window])].add("" if item is None else str(item))
    lengths, out = {len(w) for w in windows}, []
    for doc_id, text in docs:
        w = ITEM_WORDS.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                own = windows.get(tuple(w[k : k + n]))
                if own:
                    hit.update(range(k, k + n))
                    found |= own
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return out


def leaking(seed=4):
    """Texts over a small vocabulary, so that windows overlap, repeat and nearly meet; items of every length."""
    rng = random.Random(seed)
    say = lambda n: [rng.choice("abcdé") for _ in range(n)]
    items = [(i, " ".join(say(n))) for i, n in enumerate([*range(0, 16), 30, 40, 40])]
    items += [(2, "Zwei"), (None, "null id of its own here"), (50, None), (51, " ,; "), (52, "ÀB-cd_e"), (53, items[-1][1])]
    docs = []
    for d in range(300):
        w = say(rng.choice((0, 1, 3, 9, 10, 11, 60, 200)))
        for _ in range(rng.choice((0, 0, 1, 2))):
            own = ITEM_WORDS.findall((rng.choice(items)[1] or "").translate(LOWER))
            at = rng.randrange(len(w) + 1)
            w[at:at] = own[rng.randrange(3) :] if rng.random() < 0.3 else own
        docs.append((d, rng.choice((" ", "\n", ", ")).join(w).upper() if d % 3 else " ".join(w)))
    shared = " ".join(ITEM_WORDS.findall(items[-2][1]))
    docs += [(None, items[17][1]), (None, None), (7, items[17][1]), (7, items[17][1]), (7, "ÀB-CD_E zwei"), (8, " - ")]
    docs += [(1000 + d, f"x{d} {items[18][1]} y{shared}") for d in range(200)]
    docs.append((2000, " ".join(say(50_000))))
    return docs, items


@pytest.mark.parametrize("block_rows", [1_000_000, 60])
def test_decontamination_matches_brute_force(spark, block_rows):
    docs, items = leaking()
    clash = [F.lit("clash").alias(c) for c in ("id", "h1", "w", "pos", "shingle", "start", "n_words", "items", "near")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7).select("*", *clash)
    bench = spark.createDataFrame(items, "item_id long, text string").select("*", F.lit("clash").alias("wid"), F.lit("clash").alias("k"))
    got = [tuple(r) for r in decontaminate(frame, bench, block_rows=block_rows).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    expected = brute_leaks(docs, items)
    assert sorted(got, key=order) == sorted(expected, key=order)
    assert any(0 < r[2] < r[1] for r in expected)


@pytest.mark.parametrize("window,shingle", [(3, 3), (4, 1), (13, 5)])
def test_decontamination_with_other_windows(spark, window, shingle):
    docs, items = leaking(9)
    frame = spark.createDataFrame(docs[:300], "doc_id long, text string")
    got = decontaminate(frame, spark.createDataFrame(items, "item_id long, text string"), window, shingle).collect()
    assert sorted(map(tuple, got)) == sorted(brute_leaks(docs[:300], items, window))


def test_decontamination_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate(docs.where("false"), items).collect() == []
    assert [tuple(r) for r in decontaminate(docs, items.where("false")).collect()] == [(1, 2, 0, [])]
    with pytest.raises(ValueError):
        decontaminate(docs, items, window=3, shingle=4)


def test_decontamination_stays_in_the_engine(spark):
    docs, items = leaking()
    found = decontaminate(spark.createDataFrame(docs[:5], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    plan = found._jdf.queryExecution().toString()
    assert not re.search(r"Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan.replace("Scan ExistingRDD", ""))


def test_covariance_is_exact(spark):
    rng = random.Random(2)
    rows = [[rng.randrange(-(2**30), 2**30) if d == 3 else 10**9 + rng.randrange(900) for d in range(5)] for _ in range(700)]
    frame = spark.createDataFrame([(r,) for r in rows], "__x array<long>").repartition(5)
    n, sums, found = covariance(frame)
    assert (n, sums) == (700, [sum(c) for c in zip(*rows)])
    for i in range(5):
        for j in range(5):
            exact = Fraction(sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in rows), n**3)
            assert found[i, j] == float(exact)


def brute_white(rows, components=4):
    """Deviations, and whitened values up to sign, from numpy over distinct vectors."""
    x = {i: [int(np.floor(256 * c)) for c in v] for i, v in rows.items()}
    distinct = np.array(sorted(set(map(tuple, x.values()))))
    n, sums = len(distinct), distinct.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(distinct.T.astype(float), bias=True))
    top = vectors[:, ::-1][:, :components] / np.sqrt(values[::-1][:components])
    deviation = {i: sum((n * a - int(s)) ** 2 for a, s in zip(v, sums)) for i, v in x.items()}
    white = {i: (np.array(v) - sums / n) @ top for i, v in x.items()}
    return n, deviation, white, values[::-1][:components] / values.sum()


def test_whitening_matches_brute_force(spark):
    rows = QUERIES["op13_embedding_whitening"](spark, "/root/testdata/sf0.01").collect()
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    n, deviation, white, explained = brute_white({r["vec_id"]: r["embedding"] for r in table})
    assert len(rows) == 4 * len(table)
    by = {(r["vec_id"], r["component"]): r for r in rows}
    for k in range(1, 5):
        sign = np.sign(by[table[0]["vec_id"], k]["whitened"] * white[table[0]["vec_id"]][k - 1])
        for r in table:
            own = by[r["vec_id"], k]
            assert (own["n"], own["deviation"]) == (n, deviation[r["vec_id"]])
            assert own["whitened"] == pytest.approx(sign * white[r["vec_id"]][k - 1], abs=1e-9)
            assert own["explained"] == pytest.approx(explained[k - 1], rel=1e-9) and own["identity_error"] < 1e-9


def test_whitening_edges(spark):
    rng = random.Random(6)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [rng.gauss(0, 3) for _ in range(3)]) for i in range(40)] + [(100 + i, [1.0, 2.0, 3.0]) for i in range(500)]
    left_out = [(200, None), (201, [1.0, None, 2.0]), (202, [nan, 0.0, 0.0]), (203, [0.0, -inf, 1.0])]
    short = [(None, [-0.0, 1.5]), (None, []), (5, [7.0, 7.0, 7.0])]
    clash = [F.lit("clash").alias(c) for c in ("__x", "n", "component", "white", "deviation")]
    frame = spark.createDataFrame(rows + left_out + short, "vec_id long, embedding array<double>").select("*", *clash)
    got = whiten(frame.repartition(6)).collect()
    # Three dimensions have three components.
    assert len(got) == 3 * (len(rows) + len(short)) and {r["n"] for r in got} == {40 + 1 + 3}
    padded = dict(enumerate([v + [0.0] * (3 - len(v)) for _, v in rows + short]))
    _, deviation, _, explained = brute_white(padded, 3)
    assert sorted(int(r["deviation"]) for r in got if r["component"] == 1) == sorted(deviation.values())
    assert sorted({r["explained"] for r in got}, reverse=True) == pytest.approx(list(explained))
    assert whiten(frame.where("vec_id = 200")).collect() == [] and whiten(frame.where("false")).collect() == []
    assert whiten(frame.where("vec_id >= 100 and vec_id < 200")).collect() == []  # one distinct vector has no variance
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], "vec_id long, embedding array<double>")
    assert {r["component"] for r in whiten(line).collect()} == {1}  # the second dimension depends on the first
    with pytest.raises(Exception, match="out of range"):
        whiten(spark.createDataFrame([(1, [1e300])], "vec_id long, embedding array<double>")).collect()


def test_large_deviations_are_exact(spark):
    rows = [(i, [float(2**35 - i), float(-(2**35) + 3 * i * i)]) for i in range(50)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    _, deviation, _, _ = brute_white(dict(rows), 2)
    assert {r["vec_id"]: int(r["deviation"]) for r in whiten(frame).collect()} == deviation
    assert scaled_vectors(frame).count() == 50


def test_stages_with_any_columns_and_no_rows(spark):
    """Names that the stages use themselves come through unharmed; empty tables stay empty."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(
        "*", *(F.concat(F.lit(f"{c}-"), "doc_id").alias(c) for c in ("own_lang", "own_score", "__lang_pred", "__row_a", "__many", "a", "rows", "c0", "size", "copies"))
    )
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, sf)
        assert after.columns == docs.columns, name
        rows = after.collect()
        assert rows and all(r["a"] == f"a-{r['doc_id']}" and r["__row_a"] == f"__row_a-{r['doc_id']}" and r["c0"] == f"c0-{r['doc_id']}" for r in rows), name
        if name != "mixing":
            assert len(rows) == len({r["doc_id"] for r in rows}) <= kept.count()
        assert stage(spark, docs.where("false"), sf).collect() == [], name
        kept = after
    assert corpus_pipeline.packing(spark, docs.where("false"), sf).collect() == []


def test_texts_of_no_learned_language_go(spark):
    import corpus_pipeline

    rng = random.Random(1)
    say = lambda letters, words: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(words))
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = [(10**6 + i, say("абвгдежзийклмнопрстуфхцчшщ", 40), None, "x", 1) for i in range(100)]
    odd += [(2 * 10**6 + i, say("abcdefghijklmnopqrstuvwxyz", 60), None, "x", 1) for i in range(100)]
    odd += [(3 * 10**6, "12 34", "en", "x", 1), (3 * 10**6 + 1, None, "en", "x", 1), (3 * 10**6 + 2, "", "en", "x", 1)]
    both = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, both, sf).select("doc_id").collect()}
    real = {r["doc_id"] for r in docs.where("text rlike '[A-Za-z]'").select("doc_id").collect()}
    assert len(kept & {r[0] for r in odd}) <= 2
    assert len(real - kept) <= 0.005 * len(real)


def test_memory_of_texts_of_many_letters():
    import subprocess
    import sys
    from pathlib import Path

    code = """
import random, resource
from pairloom.llm.language import text_vectors
rng = random.Random(0)
letters = [chr(0x4E00 + i) for i in range(3000)]
one = "".join(rng.choices(letters, k=700_000))
small = text_vectors([one[:4000]], 1024, 7)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
whole = text_vectors([one], 1024, 7)
rows = text_vectors([one[i : i + 2000] for i in range(0, len(one), 2000)], 1024, 7)
assert whole.shape == (1, 1024) and rows.shape == (350, 1024) and abs(whole).max() > 0
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[2], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout.split()[-1]) < 500


def test_blocks_of_trigrams_change_nothing(monkeypatch):
    from pairloom.llm import language

    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdé ñ日本語 xyz", k=rng.choice((0, 5, 300)))) for _ in range(40)]
    whole = language.text_vectors(texts, 256, 7)
    monkeypatch.setattr(language, "_GRAMS", 50)
    assert np.array_equal(language.text_vectors(texts, 256, 7), whole)


def test_encoding_keeps_to_its_own_thread():
    """Threads of the tokenizer keep memory in every worker that ever encoded."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    code = """
import os
import pyarrow as pa
import public_tokenizers
from pairloom.llm.packing import WordEncoder
encoder = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
before = len(os.listdir("/proc/self/task"))
ids, counts = encoder.encode(pa.array([" ".join(f"word{i}" for i in range(20_000)), ""]), 1)
assert len(ids) == counts.sum() > 20_000 and counts[1] == 1
print(len(os.listdir("/proc/self/task")) - before)
"""
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"} | {"RAYON_NUM_THREADS": "4"}
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[2], env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout.split()[-1]) == 0
