import hashlib
import re
import tracemalloc

import pytest
from pyspark.sql import functions as F

from lexmill.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEM = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu."
TEXTS = ["", None, "clean words only here", "before " + ITEM.upper() + " after", "alpha beta gamma delta epsilon zeta eta theta iota KAPPA", "alpha beta gamma delta epsilon zeta eta theta iota", "x short item y", "short-ITEM", "ça déjà vu été noël ça déjà vu été noël ça", "alpha " * 50, (ITEM + " ") * 3, "lone " * 30_000 + ITEM, "..., !!"]
ITEMS = [(1, ITEM), (2, ITEM), (10, "Short item"), (3, None), (4, "..."), (5, "ça déjà vu été noël ça déjà vu été noël"), (6, "alpha alpha")]


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(text):
    w, hit, items = words(text), set(), set()
    for item, t in ITEMS:
        iw = words(t)
        n = min(len(iw), 10)
        wins = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if iw else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i : i + n]) in wins:
                hit |= set(range(i, i + n))
                items.add(str(item))
    return len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("max_bytes", [d.MAX_BROADCAST_BYTES, 60])
def test_report_is_that_of_brute_force(docs_of, bench, max_bytes):
    got = {r["doc_id"]: tuple(r)[1:] for r in d.report(docs_of(TEXTS), bench, max_broadcast_bytes=max_bytes).collect()}
    assert got == {k: brute(t) for k, t in enumerate(TEXTS)}


def test_documents_and_spans_are_removed(docs_of, bench):
    docs = docs_of(TEXTS)
    kept = d.clean_documents(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {k for k, t in enumerate(TEXTS) if not brute(t)[4]}
    cut = {r["doc_id"]: r["text"] for r in d.clean_spans(docs, bench).collect()}
    assert cut[3] == "before. after" and cut[2] == TEXTS[2] and cut[1] is None and cut[6] == "x y"


def test_empty_tables(spark, docs_of, bench):
    assert d.report(docs_of([]), bench).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["contaminated"] for r in d.report(docs_of(TEXTS), none).collect()} == {False}


@pytest.mark.parametrize("max_bytes", [d.MAX_BROADCAST_BYTES, 60])
def test_repeated_and_null_keys_are_each_judged(docs_of, bench, max_bytes):
    texts = [TEXTS[k] for k in (3, 3, 6, 7, 2)] + ["x clean item y", "clean words only here"]
    keys = F.when(F.col("doc_id") < 2, 5).when(F.col("doc_id") < 5, F.lit(None)).otherwise(6).cast("long")
    docs = docs_of(texts).withColumn("doc_id", keys)
    got = sorted((str(r["doc_id"]), *tuple(r)[1:]) for r in d.report(docs, bench, max_broadcast_bytes=max_bytes).collect())
    assert got == sorted((str(5 if k < 2 else None if k < 5 else 6), *brute(t)) for k, t in enumerate(texts))


@pytest.mark.parametrize("max_bytes", [d.MAX_BROADCAST_BYTES, 20])
def test_items_without_an_id_are_hit(spark, docs_of, max_bytes):
    items = spark.createDataFrame([(None, "secret test passage"), (None, "another one of them"), (4, "short item")], "item_id long, text string")
    docs = docs_of(["a secret test passage here", "no passage", "short item, another one of them"])
    got = {r["doc_id"]: (r["n_hit"], r["n_items"], r["contaminated"]) for r in d.report(docs, items, max_broadcast_bytes=max_bytes).collect()}
    assert got == {0: (3, 0, True), 1: (0, 0, False), 2: (6, 1, True)}
    assert [r["doc_id"] for r in d.clean_documents(docs, items, max_broadcast_bytes=max_bytes).collect()] == [1]


def test_long_documents_and_items_are_read_in_slices(spark, docs_of):
    """A window across the edge of a slice or of an item's piece is found as any other."""
    item = " ".join(f"i{k}" for k in range(d.PIECE_WORDS + 40))
    hit = " ".join(f"i{k}" for k in range(d.PIECE_WORDS - 5, d.PIECE_WORDS + 5))
    fill = "x" * (d.SLICE - 40)
    texts = [fill + " " + hit + " end", "y " * (d.SLICE // 2 - 10) + hit + " z " * 700_000 + hit, hit]
    got = {r["doc_id"]: r for r in d.hit_spans(docs_of(texts), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    for k, t in enumerate(texts):
        assert got[k]["n_words"] == len(t.split()) and got[k]["items"] == ["1"]
        assert [t.encode()[s["from_byte"] : s["to_byte"]].decode() for s in got[k]["spans"]] == [hit] * t.count(hit)
        assert [t.split()[s["from_word"] : s["to_word"]] for s in got[k]["spans"]] == [hit.split()] * t.count(hit)


def test_a_set_is_bounded_by_what_is_built():
    words = [f"word{k}" for k in range(60_000)]
    text = " ".join(words[(k * 7919) % len(words)] for k in range(400_000))
    tracemalloc.start()
    held = d.WindowSet([(str(k), text[k * 30_000 : (k + 1) * 30_000]) for k in range(len(text) // 30_000)], d.WIDTH)
    size = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert size < (d.BUILT + 2) * len(text) and len(held.hashes[d.WIDTH]) > 300_000


def test_a_window_of_many_items_takes_one_place_for_each(spark, docs_of):
    items = spark.createDataFrame([(k, "the very same ten words stand in all of these items") for k in range(3000)], "item_id long, text string")
    got = d.report(docs_of(["the very same ten words stand in all of these items"] * 3), items).collect()
    assert {r["n_items"] for r in got} == {3000} and {r["n_hit"] for r in got} == {11}


def test_extra_columns_and_blocks_keep_documents_apart(docs_of, bench):
    docs = docs_of(TEXTS).unionByName(docs_of(TEXTS))
    one, many = (sorted(map(str, d.hit_spans(docs, bench, max_broadcast_bytes=b).collect())) for b in (d.MAX_BROADCAST_BYTES, 40))
    assert one == many and len(one) == 2 * len(TEXTS)
    kept = [sorted(map(str, d.clean_documents(docs, bench, max_broadcast_bytes=b).collect())) for b in (d.MAX_BROADCAST_BYTES, 40)]
    assert kept[0] == kept[1]
