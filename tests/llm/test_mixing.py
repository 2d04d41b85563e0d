import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lexmill.llm import mixing as m

WEIGHTS = {"domain": {"d0": 3.0, "d1": 1.0}, "lang": {"en": 2.0}}


def water(budget, nodes):
    """Shares of (capacity, weight): raise all by weight, fixing those that fill up."""
    share, open_ = [0.0] * len(nodes), [k for k, (c, _) in enumerate(nodes) if c]
    while open_:
        level = budget / sum(nodes[k][1] for k in open_)
        full = [k for k in open_ if level * nodes[k][1] >= nodes[k][0]]
        if not full:
            for k in open_:
                share[k] = level * nodes[k][1]
            break
        for k in full:
            share[k] = nodes[k][0]
            budget -= nodes[k][0]
            open_.remove(k)
    return share


def brute(rows, share, epochs=m.MAX_EPOCHS):
    tokens = {k: len((t or "").replace("\n", " ").split(" ")) - (t or "").replace("\n", " ").split(" ").count("") for k, _, _, _, t in rows}
    leaf = defaultdict(int)
    for k, d, lang, s, _ in rows:
        leaf[d, lang, s] += tokens[k]
    budgets, out = {(): float(int(sum(leaf.values()) * share))}, {}
    for depth, level in enumerate(m.LEVELS):
        names = sorted({p[: depth + 1] for p, t in leaf.items() if t}, key=repr)
        for parent in {n[:-1] for n in names}:
            own = [n for n in names if n[:-1] == parent]
            total = [sum(t for p, t in leaf.items() if p[: depth + 1] == n) for n in own]
            weight = [WEIGHTS[level].get(n[-1], 1.0) if level in WEIGHTS else float(t) for n, t in zip(own, total, strict=True)]
            for n, x in zip(own, water(budgets[parent], [(t * epochs, w) for t, w in zip(total, weight, strict=True)]), strict=True):
                budgets[n] = x
    for p, t in leaf.items():
        b = int(budgets.get(p, 0) + 1e-6)
        whole, rest = (b // t, b % t) if t else (0, 0)
        mine = sorted((int(hashlib.md5(f"{m.SEED}:{whole}:{k}".encode()).hexdigest()[:8], 16), k) for k, *leaf_of, _ in rows if tuple(leaf_of) == p)
        for _, k in mine:
            part = min(rest, tokens[k])
            rest -= part
            out[k] = (tokens[k], whole, tokens[k] * whole + part)
    return out


ROWS = [(k, f"d{k % 3}", ["en", "de", None][k % 7 % 3], f"s{k % 5 if k % 2 else 0}", "w " * (k * 37 % 90) + ("\n" if k % 4 else "x\ty")) for k in range(300)] + [(900, "d0", "en", "s0", None), (901, "d9", "en", "s9", "")]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "doc_id long, domain_name string, lang string, source string, text string").withColumn("epochs", F.lit("x")).withColumn("_hash", F.lit("x"))


@pytest.mark.parametrize("share", [0.5, 3.0, 10.0, 0.01, 0.0])
def test_mix_is_that_of_brute_force(rows, share):
    plain = [(k, d, lang, s, (t or "").replace("\t", " ")) for k, d, lang, s, t in ROWS]
    got = m.mix(rows, domain=F.col("domain_name"), budget_share=share, weights=WEIGHTS).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["epochs"], r["tokens_taken"]) for r in got} == brute(plain, share) and len(got) == len(ROWS)


def test_documents_carry_what_is_taken(rows):
    kept = m.mixed_documents(rows, domain=F.col("domain_name"), budget_share=0.5, weights=WEIGHTS)
    assert kept.columns == [*rows.columns, "mix_epochs", "mix_tokens"]
    got = {r["doc_id"]: r["mix_tokens"] for r in kept.collect()}
    plain = [(k, d, lang, s, (t or "").replace("\t", " ")) for k, d, lang, s, t in ROWS]
    assert got == {k: v[2] for k, v in brute(plain, 0.5).items() if v[2]}


def test_repeated_rows_empty_tables_and_weights(rows, spark):
    twice = rows.where("doc_id < 20").unionByName(rows.where("doc_id < 20"))
    got = m.mix(twice, domain=F.col("domain_name"), budget_share=1.0, weights={})
    assert got.count() == 40 and got.where("tokens_taken <> n_tokens").count() == 0
    assert m.mix(rows.limit(0), domain=F.col("domain_name"), budget_share=1.0, weights={}).count() == 0
    with pytest.raises(ValueError):
        m.mix(rows, domain=F.col("domain_name"), budget_share=1.0, weights={"lang": {"en": 0}})


def test_null_keys_at_the_cut_get_their_share(spark):
    texts = ["w " * (k + 1) for k in range(20)]
    docs = spark.createDataFrame([(None, "d", "en", "s", t) for t in texts], "doc_id long, domain_name string, lang string, source string, text string")
    got = m.mix(docs, domain=F.col("domain_name"), budget_share=0.5, weights={}).collect()
    assert sorted((r["n_tokens"], r["tokens_taken"]) for r in got) == [(k + 1, (k + 1) // 2) for k in range(20)]


@pytest.mark.parametrize("share", [0.37, 2.5])
def test_epochs_give_the_tokens_that_were_taken(rows, share):
    """Whole copies and one prefix: their tokens are those taken, and each is the start of its text."""
    mixed = m.mixed_documents(rows, domain=F.col("domain_name"), budget_share=share, weights=WEIGHTS)
    taken = {r["doc_id"]: (r["mix_epochs"], r["mix_tokens"]) for r in mixed.collect()}
    texts = {k: t for k, *_, t in ROWS}
    out = defaultdict(dict)
    for r in m.epoch_texts(mixed).collect():
        out[r["doc_id"]][r["mix_epoch"]] = r["text"]
    assert set(out) == set(taken)
    for k, epochs in out.items():
        whole, tokens = taken[k]
        assert sum(len(t.split()) for t in epochs.values()) == tokens and set(epochs) <= set(range(whole + 1))
        assert all(epochs[e] == texts[k] for e in range(whole)) and texts[k].startswith(epochs.get(whole, ""))


def test_many_siblings_share_as_water_does(spark):
    """More siblings than steps, with ties and far ratios."""
    nodes = [(0, f"s{k}", 1 + (k * 7919) % 1000 ** (1 + k % 3), float(1 + k % 5)) for k in range(3000)]
    table = spark.createDataFrame(nodes, "domain int, source string, _cap long, _w double")
    for budget in (0.0, 5.0, 1e4, 1e7, 1e12):
        got = {r["source"]: r["_share"] for r in m.fill(table.withColumn("_budget", F.lit(budget)), ["domain"]).collect()}
        want = water(budget, [(c, w) for _, _, c, w in nodes])
        assert [got[s] for _, s, _, _ in nodes] == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_very_long_texts_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "w " * 1_000_000), (2, "x" * 2_000_000)], "doc_id long, text string").withColumns({c: F.lit("s") for c in ("lang", "source", "mix_epochs", "_tokens", "_row", "domain")})
    kept = m.mixed_documents(docs, domain=F.lit("d"), budget_share=0.5, weights={})
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert sum(r["mix_tokens"] for r in rows.values()) == 500_000 and kept.columns == ["doc_id", "text", "lang", "source", "_tokens", "_row", "domain", "mix_epochs", "mix_tokens"]
    texts = {r["doc_id"]: r["text"] for r in m.epoch_texts(kept).collect()}
    assert sum(len(t.split()) for t in texts.values()) == 500_000
