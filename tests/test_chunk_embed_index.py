import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmill.operators import chunk, embed, index


def test_equal_words(spark):
    text = " ".join(["word"] * 500)
    parts = chunk.split(text, 100, 20)
    assert [len(p.split()) for p in parts] == [100] * 6
    rows = spark.createDataFrame([("c", text)], "case_id string, clean_text string")
    made = chunk.chunk(rows, size=100, overlap=20).orderBy("chunk_index").collect()
    assert [r["chunk_index"] for r in made] == list(range(6)) and {r["total_chunks"] for r in made} == {6} and {r["approx_token_count"] for r in made} == {135}


def test_short_and_blank_texts(spark):
    rows = spark.createDataFrame([("a", "six words are not quite enough"), ("b", ""), ("c", None), ("d", "  \n ")], "case_id string, clean_text string")
    assert chunk.chunk(rows).count() == 0


def test_bad_sizes():
    with pytest.raises(ValueError):
        chunk.check_sizes(10, 10)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .,!?\n", max_size=400), st.integers(2, 12), st.integers(0, 1))
def test_chunks_cover_the_words(text, size, overlap):
    parts = chunk.split(text, size, overlap)
    assert all(p.strip() == p and p for p in parts)
    assert set("".join(text.split())) - set("".join(parts)) <= set(".,!? ")
    for p in parts:
        assert chunk.cost(p) <= (size + overlap) * 2 or " " not in p


def test_word_chunks_are_what_packing_gives(spark):
    texts = [" ".join(f"w{k}" for k in range(n)) for n in (0, 1, 74, 75, 99, 100, 101, 180, 181, 500)]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k")
    got = [r[0] for r in rows.select(chunk.word_chunks(F.col("t"), 100, 20)).collect()]
    assert got == [chunk.split(t, 100, 20, (" ",)) for t in texts]


def test_hard_chunks_are_what_splitting_gives(spark):
    texts = ["", "x" * 5, "y" * 1000, "a\n" * 300]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k")
    got = [r[0] for r in rows.select(chunk.hard_chunks(F.col("t"), 20, 4)).collect()]
    assert got[2] == [("y" * 1000)[k : k + 100] for k in range(0, 1000, 80)] and got[0] == [] and got[1] == ["xxxxx"]


def vectors(spark, *texts):
    return [np.array(r[0]) for r in spark.createDataFrame([(t,) for t in texts], "t string").select(embed.hashed_embedding(F.col("t"))).collect()]


def test_embeddings(spark):
    a, b, c, empty = vectors(spark, "bail application in a murder case", "the murder case and the bail sought", "land acquisition compensation", None)
    assert len(a) == embed.DIM and abs(np.linalg.norm(a) - 1) < 1e-5 and not empty.any()
    assert a @ b > a @ c
    assert embed.query_vector(spark, "bail application in a murder case") == pytest.approx(a.tolist())


def test_plugged_in_model(spark):
    model = lambda: lambda texts: np.array([[len(t), 1.0] for t in texts])
    got = spark.createDataFrame([("abc",)], "t string").select(embed.model_embedding(F.col("t"), "toy", model, dim=2)).first()[0]
    assert got == pytest.approx([3 / 10**0.5, 1 / 10**0.5], abs=1e-6)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(60, 16))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    m[7] = m[3]
    return m, spark.createDataFrame([(f"case{k:02}", 0, [float(x) for x in v]) for k, v in enumerate(m)], "case_id string, chunk_index int, embedding array<float>")


def test_ids_do_not_depend_on_partitions(spark, rows):
    one = {(r["case_id"], r["vec_id"]) for r in index.build_flat(rows[1].repartition(1)).collect()}
    eight = {(r["case_id"], r["vec_id"]) for r in index.build_flat(rows[1].repartition(8)).collect()}
    assert one == eight == {(f"case{k:02}", k) for k in range(60)}


def test_top_k_is_exact_and_ties_go_by_number(spark, rows):
    flat = index.build_flat(rows[1])
    got = index.top_k(flat, rows[0][3].tolist(), 5).collect()
    want = sorted(range(60), key=lambda k: (-round(float(rows[0][k] @ rows[0][3]), 6), k))[:5]
    assert [r["vec_id"] for r in got] == want and got[0]["score"] > 0.99 and want[:2] == [3, 7]
    assert index.top_k(flat, rows[0][3].tolist(), 100).count() == 60


def test_each_query_of_many(spark, rows):
    flat = index.build_flat(rows[1])
    asked = flat.where("vec_id % 10 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    got = index.top_k_each(flat, asked, 3)
    assert got.count() == 18 and {r["vec_id"] for r in got.where("rank = 1").collect()} == set(range(0, 60, 10))


def test_inverted_lists(spark, rows):
    flat = index.build_flat(rows[1])
    assert index.train_lists(flat, 100) == []
    centres = index.train_lists(flat, 4)
    listed = index.assign_lists(flat, centres)
    q = rows[0][11].tolist()
    everywhere = index.top_k(listed, q, 5, index.probed_lists(centres, q, 4)).collect()
    assert [r["vec_id"] for r in everywhere] == [r["vec_id"] for r in index.top_k(flat, q, 5).collect()]
    assert index.top_k(listed, q, 1, index.probed_lists(centres, q, 1)).first()["vec_id"] == 11
    assert index.assign_lists(flat, []).select("list_id").distinct().collect()[0][0] == 0


def test_inverted_lists_reach_their_recall(spark):
    """Of many queries, by the lists that a measurement asks for; all lists give the exact answer."""
    rng = np.random.default_rng(8)
    m = rng.normal(size=(1500, 24))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    flat = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(m)], "vec_id long, embedding array<float>")
    centres = index.train_lists(flat, 32)
    listed = index.assign_lists(flat, centres)
    asked = flat.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    n = index.probes_for(listed, centres, asked, 10, 0.95)
    exact = {(r["query_id"], r["rank"]): r["vec_id"] for r in index.top_k_each(flat, asked, 10).collect()}
    want = {(int(q) * 20, k + 1): int(v) for q in range(75) for k, v in enumerate(np.argsort(-(m.astype(np.float32) @ m[q * 20].astype(np.float32)), kind="stable")[:10])}
    assert sum(exact[x] == want[x] for x in want) >= len(want) - 4  # sums of floats may differ in the last place
    some = {(r["query_id"], r["vec_id"]) for r in index.top_k_each(listed, asked, 10, centres=centres, n_probe=n).collect()}
    recall = sum((q, v) in some for (q, _), v in exact.items()) / len(exact)
    print(f"recall {recall:.3f} with {n} of 32 lists")
    assert 0.9 <= recall and n < 32
    full = {(r["query_id"], r["rank"]): r["vec_id"] for r in index.top_k_each(listed, asked, 10, centres=centres, n_probe=32).collect()}
    assert full == exact


def test_many_equal_vectors_and_blocks_of_queries(spark, monkeypatch):
    flat = spark.createDataFrame([(k, [1.0, 0.0]) for k in range(300)] + [(900, None)], "vec_id long, embedding array<float>")
    asked = spark.createDataFrame([(f"q{k}", [1.0, 0.0]) for k in range(5)], "query_id string, query array<float>")
    for most in (10_000, 2):
        monkeypatch.setattr(index, "MAX_BROADCAST_QUERIES", most)
        got = index.top_k_each(flat.repartition(3), asked, 4).collect()
        assert sorted((r["query_id"], r["vec_id"], r["rank"]) for r in got) == [(f"q{q}", k, k + 1) for q in range(5) for k in range(4)]
    assert index.top_k_each(flat, asked.limit(0), 4).count() == 0 == index.top_k_each(flat.limit(0), asked, 4).count()


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("a b c d e f g h", ["a b c d e f", "e f g h"]),
        ("one two three four.\n\nfive six seven eight nine ten eleven twelve\n\nend here now", ["one two three four.", "five six seven eight nine ten", "nine ten eleven twelve", "end here now"]),
        ("a b. c. d e. f g h. i", ["a b. c. d e", "d e. f g h", "i"]),
        ("a b! c d! e f g! h", ["a b! c d", "c d! e f g", "h"]),
        ("k l, m n\n\n\n\no p q r s t\nu v, w x y", ["k l, m n", "o p q r s t", "u v, w x y"]),
        ("a\tb\tc\td\te\tf\tg", ["a\tb\tc\td\te\tf\tg"]),
        ("\t".join(f"w{k}" for k in range(20)), ["w0\tw1\tw2\tw3\tw4\tw5\tw6\tw7\tw8\tw9", "w7\tw8\tw9\tw10\tw11\tw12\tw13\tw14", "2\tw13\tw14\tw15\tw16\tw17\tw18\tw19", "7\tw18\tw19"]),
        ("five words fit in here", ["five words fit in here"]),
        ("  ", []),
    ],
)
def test_chunks_worked_out_by_hand(spark, text, want):
    """Six tokens a chunk (a piece of one word costs one, of five words six), two of overlap."""
    assert chunk.split(text, 6, 2) == want
    rows = spark.createDataFrame([("c", text)], "case_id string, clean_text string")
    got = chunk.numbered(rows, chunk.recursive_chunks(F.col("clean_text"), 6, 2), least_words=1).orderBy("chunk_index").collect()
    assert [r["text"] for r in got] == want and {r["total_chunks"] for r in got} <= {len(want)}


def test_vectors_that_are_null(spark):
    none = spark.createDataFrame([(k, None) for k in range(3)], "vec_id long, embedding array<float>")
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, query array<float>")
    assert [r["score"] for r in index.top_k(none, [1.0, 0.0], 2).collect()] == [0.0, 0.0]
    assert index.top_k_each(none, asked, 2).count() == 2 and index.assign_lists(none, [[1.0, 0.0], [0.0, 1.0]]).where("list_id = 0").count() == 3
