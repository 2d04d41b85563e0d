import random
import re
import zlib

import numpy as np
import pytest

from lexmill.llm import quality as q


def corpus(n=400):
    rng = random.Random(4)
    good = ["the", "house", "stands", "near", "a", "river", "and", "people", "walk", "along", "its", "banks", "every", "day"]
    texts, labels = [], []
    for k in range(n):
        words = [rng.choice(good) for _ in range(rng.randrange(20, 60))]
        bad = k % 3 == 0
        texts.append(" ".join(f"{w}{rng.choice(['%%%', '###', '!!'])}" if bad else w for w in words))
        labels.append(int(not bad))
    return texts, labels


@pytest.fixture(scope="module")
def tables(spark, docs_of):
    texts, labels = corpus()
    rows = [(k, y, 0) for k, y in enumerate(labels)] + [(None, 1, 0), (3, None, 0), (5, 7, 0), (99999, 1, 0)]
    return docs_of([*texts, "", None, "long text " * 40_000]), spark.createDataFrame(rows, "doc_id long, quality int, toxic int"), labels


def test_held_out_rows_are_told_apart(tables):
    docs, labels, truth = tables
    rows = q.score(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] < len(truth)]
    assert len(held) > 50 and sum(a == b for a, b in held) / len(held) > 0.97
    empty = {r["doc_id"]: r["score"] for r in rows if r["doc_id"] in (400, 401)}
    assert empty[400] == empty[401]


def test_held_out_labels_and_other_columns_do_not_matter(tables):
    from pyspark.sql import functions as F

    docs, labels, _ = tables
    turned = labels.withColumn("quality", F.when(q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("elsewhere"))
    assert sorted(map(tuple, q.score(docs, labels).collect())) == sorted(map(tuple, q.score(other, turned).collect()))


def test_repeats_of_a_key_do_not_grow_the_fit(tables):
    docs, labels, _ = tables
    hot = docs.where("doc_id = 1").crossJoin(docs.sparkSession.range(300)).drop("id")
    more = labels.unionByName(labels.where("doc_id = 1").crossJoin(labels.sparkSession.range(300)).drop("id"))
    assert q.fit(docs.unionByName(hot), more) == q.fit(docs, labels)


def test_good_documents_stay(tables):
    docs, labels, truth = tables
    kept = q.good_documents(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in q.score(docs, labels).where("predicted = 1").collect()}


def test_without_labels_or_with_one_class(tables, spark):
    docs, labels, _ = tables
    assert {r["score"] for r in q.score(docs, labels.limit(0)).collect()} == {0.5}
    assert {r["predicted"] for r in q.score(docs, labels.where("quality = 1")).collect()} == {1}
    assert {r["predicted"] for r in q.score(docs, labels.where("quality = 0")).collect()} == {0}
    assert q.score(docs.limit(0), labels).count() == 0


def test_descent_reaches_the_minimum():
    """The dual's optimality conditions hold: rows outside the margin have no weight, rows inside have all of it."""
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(50, 6, replace=False)).astype(np.int32) for _ in range(80)]
    values = [rng.normal(size=6) for _ in rows]
    signs = np.where(rng.random(80) < 0.5, 1.0, -1.0)
    w = q.dual_coordinate_descent(rows, values, signs, np.full(80, 0.5), epochs=3000, tolerance=1e-9)
    objective = lambda w: 0.5 * w @ w + 0.5 * sum(max(0, 1 - s * (w[r] @ v)) for r, v, s in zip(rows, values, signs, strict=True))
    best = objective(w)
    for _ in range(200):
        step = np.zeros_like(w)
        step[:50] = rng.normal(size=50) * 10 ** rng.uniform(-5, 0)
        assert objective(w + step) >= best - 1e-7


def test_distinct_and_features():
    d = q.Distinct()
    assert sorted(d(np.array([5, 3, 5, 9, 3], np.int32))) == [3, 5, 9] and len(d(np.zeros(0, np.int32))) == 0
    a, b, c = q.features_of(np.frombuffer(b"Some words.Some words.", np.uint8), np.array([0, 11, 22, 22]))
    assert sorted(a) == sorted(b) and len(a) and not len(c)


def grams(text):
    """Names of a text's features by plain Python: words and marks, their pairs, and runs of three and four shapes."""
    tokens = re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+|\n+|[^\x00-\x20\x7f0-9A-Za-z\x80-\U0010ffff]+", text)
    tokens = [(t, "word" if re.match(r"[0-9A-Za-z\x80-\U0010ffff]", t) else "line" if t[0] == "\n" else "mark") for t in tokens]
    lower = [t.translate({c: c + 32 for c in range(65, 91)}) for t, _ in tokens]
    shapes, last = [], None
    for (t, kind), low in zip(tokens, lower, strict=True):
        size, ups = len(t.encode()), sum("A" <= c <= "Z" for c in t)
        shape = (0 if ups == 0 else 1 if ups == size else 2, any(c in "0123456789" for c in t), min(size // 8, 2)) if kind == "word" else kind if kind == "line" else low
        shapes.append((kind == "word" and low == last, shape))
        last = low if kind == "word" else last
    runs = lambda of, n: {(n, *of[k : k + n]) for k in range(len(of) - n + 1)}
    return {("w", x) for x in runs(lower, 1) | runs(lower, 2)} | {("s", x) for x in runs(shapes, 3) | runs(shapes, 4)}


@pytest.mark.parametrize("text", ["", "Some words, some words.\n\nMore  AND more 123 a1!!", "é中 É中 wOrd wOrd wOrd", "a\x7fb\tc\r\nd " * 40, "x" * 40 + " $$$ ### " * 30])
def test_features_are_those_of_plain_python(text):
    """As many different places as names (hashing may merge a few), and equal names for equal texts."""
    raw = text.encode()
    got = set(q.features_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0].tolist())
    assert len(grams(text)) - 2 <= len(got) <= len(grams(text))


def test_scores_are_those_of_brute_force():
    """Log-count ratios, unit rows, the least hinge loss and the logistic curve, each by dense NumPy over named features."""
    texts, labels = corpus(160)
    names = sorted({g for t in texts for g in grams(t)}, key=repr)
    at = {g: k for k, g in enumerate(names)}
    rows = [np.array(sorted(at[g] for g in grams(t)), np.int32) for t in texts]
    positive, calibrate = np.array(labels) == 1, np.arange(len(texts)) % 5 == 0
    weights, slope, intercept = q.fit_rows(rows, positive, calibrate)
    x = np.zeros((len(texts), len(names)))
    for k, r in enumerate(rows):
        x[k, r] = 1
    fit, y = ~calibrate, np.where(positive, 1.0, -1.0)
    p, n = 1 + x[fit & positive].sum(0), 1 + x[fit & ~positive].sum(0)
    # Smoothing counts every place of the table once, those without a feature as well.
    spare = q.SIZE - len(names)
    ratio = np.log(p / (p.sum() + spare)) - np.log(n / (n.sum() + spare))
    assert np.allclose(weights[0][: len(names)], ratio, atol=1e-4)
    z = x * ratio
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
    cost = np.where(y[fit] > 0, len(y[fit]) / (2 * (y[fit] > 0).sum()), len(y[fit]) / (2 * (y[fit] < 0).sum()))
    w = np.divide(weights[1][: len(names)], ratio, out=np.zeros(len(names)), where=np.abs(ratio) > 1e-9)
    loss = lambda v: v @ v / 2 + (cost * np.maximum(0, 1 - y[fit] * (z[fit] @ v))).sum()
    v = np.zeros(len(names))  # plain subgradient descent from nothing
    best = loss(v)
    for k in range(4000):
        inside = y[fit] * (z[fit] @ v) < 1
        v -= (v - ((cost * y[fit])[inside][:, None] * z[fit][inside]).sum(0)) / (k + 2)
        best = min(best, loss(v))
    assert loss(w) <= best * 1.01 + 1e-6
    margins = z @ w
    scores = 1 / (1 + np.exp(-(slope * margins + intercept)))
    own = [q.margin(r, weights[0], weights[1]) for r in rows]
    assert np.allclose(own, margins, atol=1e-4)
    assert ((scores >= 0.5) == positive)[calibrate].mean() > 0.95


def test_null_keys_are_not_held_out(tables):
    from pyspark.sql import functions as F

    docs, labels, _ = tables
    rows = q.score(docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")), labels).collect()
    assert [r["held_out"] for r in rows] == [False] * 3 and len({r["doc_id"] for r in rows}) == 1


def test_slices_of_long_texts_have_the_same_features():
    import pyarrow as pa

    text = "Some words, more words!\nAnd 12 more of them. " * 60_000
    raw = text.encode()
    assert len(raw) > 2 * q.SLICE
    want = set(q.features_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0].tolist())
    (got,) = q.Features()(pa.array([text]))
    assert set(got.tolist()) == want


def test_the_fit_is_bounded_by_its_features(tables):
    docs, labels, _ = tables
    assert q.fit(docs, labels, max_places=1 << 30) == q.fit(docs, labels) != q.fit(docs, labels, max_places=3000)
    assert q.fit(docs, labels, max_places=0)[1:] == (0.0, 0.0)


def test_a_fit_without_any_feature(docs_of, spark):
    docs = docs_of(["", None, "", "", " "] * 6)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(30)], "doc_id long, quality int, toxic int")
    assert len({r["score"] for r in q.score(docs, labels).collect()}) == 1
