import math
import os
import re

import corpus_pipeline as p
import numpy as np
import pyarrow.parquet as pq
import pytest
import test_mixing
from pyspark.sql import functions as F
from test_decontaminate import words
from test_jaccard import shingles
from test_secretscan import brute as secrets_in

from lexmill.llm import jaccard, quality, secretscan
from lexmill.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 11)]


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables here")
def test_run_is_that_of_brute_force(spark):
    docs = {d["doc_id"]: d for d in pq.read_table(f"{SMALL}/documents.parquet").to_pylist()}
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    good = {r["doc_id"] for r in quality.score(table, spark.read.parquet(f"{SMALL}/labels.parquet")).where("predicted = 1").collect()}
    sets = {k: shingles(docs[k]["text"]) for k in sorted(good)}
    root = {k: k for k in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    for _ in pairs:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    windows = set()
    for t in pq.read_table(f"{SMALL}/benchmark.parquet").column("text").to_pylist():
        w = words(t)
        windows |= {tuple(w[i : i + min(10, len(w))]) for i in range(max(1, len(w) - 9)) if w}
    sizes = {len(w) for w in windows}
    clean = set()
    for k in (k for k in root if root[k] == k):
        w = words(docs[k]["text"])
        if not any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1)):
            clean.add(k)
    out = {r["doc_id"]: r for r in p.run(spark, SMALL).collect()}
    assert set(out) <= clean and len(out) > 0.6 * len(clean)
    taken = sum(r["mix_tokens"] for r in out.values())
    everything = sum(len(docs[k]["text"].split()) for k in clean)
    assert abs(taken - int(everything * p.SHARE)) < 0.02 * everything
    assert all("[secret]" in r["text"] or r["text"] == docs[k]["text"] for k, r in out.items())
    assert not any(f"token = \"{h}" in r["text"] for r in out.values() for h in "0123456789abcdef") and all(r["n_chars"] == len(r["text"]) for r in out.values())


def test_stages_keep_columns_and_stand_empty_tables(spark, docs_of):
    docs = docs_of(["some words of a text that is read here", None, "", "some words of a text that is read here"])
    rest = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([], "item_id long, text string")
    for own in (docs, docs.limit(0)):
        kept = jaccard.one_of_each(quality.good_documents(own, rest))
        out = secretscan.redacted(p.decontaminate.clean_documents(kept, items))
        assert out.columns == docs.columns
        assert sorted(r["doc_id"] for r in out.collect()) == ([0, 1, 2] if own is docs else [])
        assert p.mix(spark, out, "").columns == [*docs.columns, "mix_epochs", "mix_tokens"]


def test_one_row_of_each_class_stays(spark, docs_of):
    """Repeated rows, different texts under one key and rows without a key: one row of each class."""
    a, near, b, c = ("a" + " w%d" * 60 % tuple(range(60)), "a" + " w%d" * 60 % tuple(range(60)) + " x", "quite another text that has its own words", "a third text without any key at all")
    none = F.lit(None).cast("long")
    docs = docs_of([a]).unionByName(docs_of([a])).unionByName(docs_of([b])).unionByName(docs_of([near, b], start=5))
    docs = docs.unionByName(docs_of([near, a, c, c, ""]).withColumn("doc_id", none))
    kept = p.deduplicate(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r["text"], r["doc_id"]) for r in kept.collect() if r["doc_id"] is not None) in ([(a, 0), (b, 0)], [(b, 0), (near, 0)])
    assert sorted(r["text"] for r in kept.where("doc_id is null").collect()) == ["", c]
    clash = docs_of([a]).unionByName(docs_of(["yet other words that stand under key one"], start=1)).unionByName(docs_of([near], start=1))
    assert sorted((r["doc_id"], r["text"][:3]) for r in p.deduplicate(spark, clash, "").collect()) == [(0, "a w"), (1, "yet")]


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables here")
def test_each_stage_is_that_of_brute_force(spark):
    """Stage by stage on what the last one kept: scores by the fitted model's own numbers, classes, windows, spans and prefixes by plain Python."""
    tables = {n: spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels", "benchmark")}
    docs = tables["documents"]
    weights, slope, intercept = quality.fit(docs, tables["labels"])
    ratio, scaled = np.frombuffer(weights, np.float32).reshape(2, -1)
    rows = {r["doc_id"]: r for r in docs.collect()}
    def places_of(batches):
        import pyarrow as pa

        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = np.frombuffer((t or "").encode(), np.uint8)
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array([k], pa.int64()), "places": pa.array([quality.features_of(raw, np.array([0, len(raw)]))[0].tolist()], pa.list_(pa.int32()))})

    good = set()
    # Features depend on the hash seed that Spark gives its workers, so they are taken there.
    for r in docs.select("doc_id", "text").mapInArrow(places_of, "doc_id long, places array<int>").collect():
        f = np.unique(np.array(r["places"], np.int32))
        norm = math.sqrt(float((ratio[f].astype(np.float64) ** 2).sum()))
        margin = float(scaled[f].astype(np.float64).sum()) / norm if norm else 0.0
        if 1 / (1 + math.exp(-(slope * margin + intercept))) >= quality.THRESHOLD:
            good.add(r["doc_id"])
    stage = lambda k, d: p.STAGES[k][1](spark, d, SMALL)
    kept = stage(0, docs)
    assert {r["doc_id"] for r in kept.collect()} == good and kept.columns == docs.columns
    kept = stage(1, kept)
    sets = {k: shingles(rows[k]["text"]) for k in sorted(good)}
    root = {k: k for k in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    for _ in pairs:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    heads = {k for k in root if root[k] == k}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(heads)
    kept = stage(2, kept)
    windows = set()
    for r in tables["benchmark"].collect():
        w = words(r["text"])
        windows |= {tuple(w[i : i + min(10, len(w))]) for i in range(max(1, len(w) - 9)) if w}
    sizes = {len(w) for w in windows}
    clean = {k for k in heads if not any(tuple(w[i : i + n]) in windows for w in [words(rows[k]["text"])] for n in sizes for i in range(len(w) - n + 1))}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(clean)
    kept = stage(3, kept)
    texts = {}
    for k in clean:
        t, at, out = rows[k]["text"], 0, ""
        for a, _, b, _ in secrets_in(t, secretscan.BASE + secretscan.MORE):
            out += t[at:a] + "[secret]" if a >= at else ""
            at = max(at, b)
        texts[k] = out + t[at:]
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in kept.collect()} == {k: (t, len(t)) for k, t in texts.items()}
    from pyspark.sql import DataFrame

    assert isinstance(kept, DataFrame) and kept.columns == docs.columns
    domain = lambda s: "domain" + str(int((re.findall(r"[0-9]{1,9}$", s) or ["0"])[0]) % 4)
    plain = [(k, domain(rows[k]["source"]), rows[k]["lang"], rows[k]["source"], " ".join(re.findall(r"[^ \t\r\n]+", t))) for k, t in sorted(texts.items())]
    monkey = {"domain": {}, **p.WEIGHTS}
    want = mixed_by_hand(plain, p.SHARE, {k: v for k, v in monkey.items() if v}, p.MAX_EPOCHS)
    assert {r["doc_id"]: (r["mix_epochs"], r["mix_tokens"]) for r in stage(4, kept).collect()} == {k: (e, n) for k, (_, e, n) in want.items() if n}


def mixed_by_hand(rows, share, weights, epochs):
    before, test_mixing.WEIGHTS = test_mixing.WEIGHTS, weights
    try:
        return test_mixing.brute(rows, share, epochs)
    finally:
        test_mixing.WEIGHTS = before


def test_small_plans_hold_inside_a_stage_and_no_longer(spark, monkeypatch):
    import corpus_pipeline
    from lexmill.llm import jaccard, mixing

    def settings(*_):
        return [spark.conf.get(k, None) for k in corpus_pipeline.SMALL_PLANS]

    seen, before = [], settings()
    monkeypatch.setattr(jaccard, "one_of_each", lambda *a, **b: seen.append(settings()))
    monkeypatch.setattr(mixing, "mixed_documents", lambda *a, **b: seen.append(settings()) or 1 / 0)
    corpus_pipeline.deduplicate(spark, None, "")
    docs = spark.createDataFrame([], "source string")
    try:
        corpus_pipeline.mix(spark, docs, "")
    except ZeroDivisionError:
        pass
    assert seen == [list(corpus_pipeline.SMALL_PLANS.values())] * 2 and settings() == before
