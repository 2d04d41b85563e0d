import random
import re
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from lexmill.llm import jaccard as j
from lexmill.llm.components import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(t):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(texts):
    sets = [shingles(t) for t in texts]
    near = defaultdict(set)
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                near[a].add(b)
                near[b].add(a)
    root = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for a, bs in near.items():
            m = min(root[x] for x in {a, *bs})
            changed |= root[a] != m
            root[a] = m
    copies = [sum(s == o for o in sets) if s else 1 for s in sets]
    return [(root[k], len(near[k]), copies[k]) for k in range(len(texts))]


def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(3000)]
    base = [[rng.choice(vocabulary) for _ in range(n)] for n in (40, 60, 80, 120, 200, 400)]
    texts = ["", None, "!!", "one", "ONE", "two words", "a b c d e", "A b, c d e!", "same same same same same same same", "same " * 900]
    for words in base:
        for edits in (0, 0, 1, 1, 2, 3, 4, 6, 8):
            own = list(words)
            for _ in range(edits):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    texts += [" ".join(base[5] + [rng.choice(vocabulary) for _ in range(k)]) for k in (20, 99, 100, 101, 150)]
    return texts


@pytest.mark.parametrize("block", [j.BLOCK_SHINGLES, 300])
def test_classes_are_those_of_brute_force(docs_of, block):
    texts = corpus()
    got = {r["doc_id"]: tuple(r)[1:] for r in j.classes(docs_of(texts), block_shingles=block).collect()}
    assert [got[k] for k in range(len(texts))] == brute(texts)


def test_one_of_each(spark, docs_of):
    texts = corpus()
    docs = docs_of(texts).unionByName(docs_of(["no key", "no key"]).withColumn("doc_id", F.lit(None).cast("long")))
    kept = j.one_of_each(docs)
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert kept.columns == docs.columns and ids.count(None) == 2
    assert sorted(k for k in ids if k is not None) == [k for k, (root, _, _) in enumerate(brute(texts)) if k == root]


def test_repeated_rows_and_empty_tables(docs_of):
    docs = docs_of(["a b c d e f g", "other words stand here in this text"])
    twice = docs.unionByName(docs)
    got = sorted(tuple(r) for r in j.classes(twice).collect())
    assert got == [(0, 0, 1, 2), (0, 0, 1, 2), (1, 1, 1, 2), (1, 1, 1, 2)]
    clash = docs_of(["a b c d e f g"]).unionByName(docs_of(["quite another text under the same number"])).unionByName(docs_of(["a b c d e f g"], start=7))
    assert {(r["doc_id"], r["class_id"]) for r in j.classes(clash).collect()} == {(0, 0), (7, 0)}
    assert j.classes(docs_of([])).count() == 0


def test_texts_under_one_key_have_their_own_links(docs_of):
    """A key with several texts: each has the links and the copies of its own set."""
    texts = corpus()
    keys = [k % 7 if k % 3 else k for k in range(len(texts))]
    docs = docs_of(texts)
    shared = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("doc_id") % 7).otherwise(F.col("doc_id")))
    of_rows = brute(texts)
    least = {root: min(keys[k] for k, (r, _, _) in enumerate(of_rows) if r == root) for root, _, _ in of_rows}
    got = sorted(tuple(r) for r in j.classes(shared, block_shingles=300).collect())
    assert got == sorted((keys[k], least[root], links, copies) for k, (root, links, copies) in enumerate(of_rows))


def test_depth_shortens_to_the_recall():
    assert j.prefix_depth() == 5 and j.prefix_depth(recall=0.5) == 8 and j.prefix_depth(threshold=0.3) == 1
    assert 1 - (1 - 0.8**5) ** 24 >= j.RECALL > 1 - (1 - 0.8**6) ** 24


def test_recall_of_the_tries():
    """Pairs of just the threshold meet in a trie about as often as the depth promises."""
    hashes, rng, met = j.Hashes(j.TREES, j.prefix_depth()), np.random.default_rng(2), 0
    for _ in range(400):
        pool = np.unique(rng.integers(0, 1 << 63, 300, np.uint64))[:270]
        a, b = pool[:240], np.concatenate([pool[30:240], pool[240:262]])
        met += bool((hashes.prefixes(a) == hashes.prefixes(b)).any())
    assert met >= 398


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 380)] + [(5, 5)]
    root = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in range(400):
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == root and len(got) == len(root)


@pytest.mark.parametrize(("rows", "shingles"), [(7, j.BLOCK_SHINGLES), (1, 1)])
def test_units_of_any_size_give_the_same_links(docs_of, rows, shingles):
    texts = corpus()
    got = {r["doc_id"]: tuple(r)[1:] for r in j.classes(docs_of(texts), block_rows=rows, block_shingles=shingles).collect()}
    assert [got[k] for k in range(len(texts))] == brute(texts)


def near_group(n, size=60, seed=9):
    """Texts that each lack some words of one base text: many pairs about the threshold."""
    rng = random.Random(seed)
    base = [f"v{k}" for k in range(size)]
    return [" ".join(base[: size - rng.randrange(1 + size // 6)] + [f"own{k}"]) for k in range(n)]


def test_recall_of_the_forest(docs_of):
    """Links of groups of near copies and of unlike texts, counted by brute force; the recall is 0.9 at the least, and here 1."""
    texts = near_group(120) + near_group(60, 40, 3) + corpus()
    want = sum(links for _, links, _ in brute(texts))
    got = sum(r["n_links"] for r in j.classes(docs_of(texts), block_rows=32).collect())
    print(f"recall {got / want:.4f} of {want} links")
    assert 0.999 * want <= got <= want


def test_the_descent_ends_where_enough_is_found(spark, docs_of, monkeypatch):
    """Copies with one changed word are all met at the deepest prefixes; pairs about the threshold call for shorter ones."""
    seen = []
    level = j._level
    monkeypatch.setattr(j, "_level", lambda *args: seen.append((args[8], args[9])) or level(*args))
    alike = [" ".join(f"a{g}x{k}" for k in range(400)) + f" end{c}" for g in range(6) for c in range(20)]
    j.classes(docs_of(alike)).count()
    first, seen[:] = list(seen), []
    j.classes(docs_of(near_group(60))).count()
    assert first[0] == seen[0] == (j.MAX_DEPTH, None) and seen[-1][0] < first[-1][0] <= j.MAX_DEPTH and seen[-1][0] >= j.prefix_depth()
    assert not j.enough(10**9, 0.6, 0.8, 8, 24, j.RECALL) and j.enough(10**9, 0.4, 0.8, 8, 24, j.RECALL) and not j.enough(100, 0.0, 0.8, 8, 24, j.RECALL)
    assert j.measured_recall(0, 0.0, 0.8, 8, 24) < 0.99 and j.measured_recall(10**7, 0.0, 0.8, 8, 24) > 0.99999


def test_units_of_many_short_sets_are_bounded(spark):
    """A unit of two blocks of near copies: the arrays for its pairs take little memory."""
    import pyarrow as pa

    rng, n = np.random.default_rng(1), 2 * j.BLOCK_ROWS
    hashes, pool = j.Hashes(j.TREES, j.MAX_DEPTH), np.unique(rng.integers(0, 1 << 63, 14, np.uint64))
    sets = [np.sort(np.concatenate([pool[:12], rng.integers(0, 1 << 63, 1, np.uint64)])) for _ in range(n)]
    rows = {
        "unit": pa.array([5] * n, pa.int64()), "half": pa.array([1] * (n // 2) + [2] * (n // 2), pa.int32()), "tree": pa.array([0] * n, pa.int32()), "rep": pa.array(range(n), pa.int64()),
        "n": pa.array([len(s) for s in sets], pa.int32()), "copies": pa.array([1] * n, pa.int64()), "sig": pa.array([hashes.signature(s).tobytes() for s in sets], pa.binary()), "shingles": pa.array([s.tobytes() for s in sets], pa.binary()),
    }
    table = pa.RecordBatch.from_pydict(rows)
    tracemalloc.start()
    out = list(j._verify(0.8, j.TREES, j.TREES * j.MAX_DEPTH, 1, None, [8, 7, 6, 5])(iter([table])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    links = {r: k for b in out for r, k in zip(b.column("rep").to_pylist(), b.column("links").to_pylist(), strict=True)}
    met = sum(links.values()) // 2
    assert 0.5 * (n // 2) ** 2 < met <= (n // 2) ** 2 and peak < 300 << 20


def test_words_whose_polynomial_hashes_are_equal_are_told_apart(docs_of):
    word = lambda n, a, b: "".join((a, b)[bin(k).count("1") % 2] for k in range(n))
    texts = [w for n in (1024, 2048, 4096) for w in (word(n, "a", "b"), word(n, "b", "a"))]
    got = [tuple(r) for r in j.classes(docs_of(texts)).collect()]
    assert sorted(got) == [(k, k, 0, 1) for k in range(6)]


def test_long_texts_are_read_in_slices(docs_of):
    long = " ".join(f"w{k}" for k in range(400_000))
    got = {r["doc_id"]: tuple(r)[1:] for r in j.classes(docs_of([long, long + " more", "x" * 3_000_000 + " y", long.upper()])).collect()}
    assert got == {0: (0, 2, 2), 1: (0, 2, 1), 2: (2, 0, 1), 3: (0, 2, 2)}
