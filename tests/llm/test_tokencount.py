import tracemalloc

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexmill.llm import tokencount as tc

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = ["", None, "Hello world", "it's we'll 'tis don'tx '  's", "  two  spaces\n\n\tand tabs \n", "中文字符 emoji 🎉🎉 é é", "a<|endoftext|>b <|endoftext|>", "x" * 5000, "=" * 300, "word " * 20_000, "12345 678 ½ Ⅷ", "　   end\x1c", "the the"]


def count(t):
    return len(LIBRARY.encode(t or "", add_special_tokens=False).ids)


def test_counts_are_those_of_the_library(docs_of):
    got = {r["doc_id"]: tuple(r)[1:] for r in tc.count_tokens(docs_of(TEXTS), PATH).collect()}
    assert got == {k: (len((t or "").encode()), count(t), count(t) > 1024) for k, t in enumerate(TEXTS)}
    assert tc.count_tokens(docs_of([]), PATH).count() == 0


@settings(max_examples=120, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "'s", "'re", "'l", "'", "the", " abc", "中", "é", "1", "!?", "<|endoftext|>", "<|end", "S", "ing", " "]), max_size=12).map("".join))
def test_every_prefix_is_counted_exactly(text):
    held = tc.counter(PATH)
    assert held.prefix_counts(text).tolist() == [count(text[:k]) for k in range(len(text) + 1)]
    assert held.text_counts([text]) == [count(text)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert tc.counter(PATH).text_counts(texts) == [count(t) for t in texts]


def test_budgets_are_answered_from_the_store(docs_of):
    texts = ["Hello there, how are you today?", "", None]
    stored = tc.store_prefix_counts(docs_of(texts), PATH)
    rows = {r["doc_id"]: r for r in tc.longest_prefix_within(tc.tokens_of_prefix(stored, 8), 3).collect()}
    assert rows[0]["n_tokens"] == count(texts[0][:8]) and rows[1]["n_tokens"] == 0
    n = rows[0]["n_chars"]
    assert count(texts[0][:n]) <= 3 and all(count(texts[0][:k]) > 3 for k in range(n + 1, len(texts[0]) + 1)) and rows[2]["n_chars"] == 0


@pytest.mark.parametrize("pair", [("th", "e"), (" ", "t"), ("in", "g"), ("a", "b")])
def test_tokens_that_merge_do_not_fit(pair):
    held = tc.counter(PATH)
    a, b = (p.encode() for p in pair)
    assert held.fits(held.ids[a], held.ids[b]) == (held.encode(a + b) == [a, b])


def test_store_keeps_keys(docs_of):
    stored = tc.store_prefix_counts(docs_of(["ab", "ab"]), PATH)
    assert stored.select(F.size("prefix_tokens")).distinct().collect()[0][0] == 3


def thue_morse(n):
    return bytes(0x61 + bin(k).count("1") % 2 for k in range(n)).decode()


def test_words_whose_sums_of_powers_are_equal_are_told_apart(docs_of):
    """Polynomial hashes modulo 2^64 give both words of each pair one value."""
    texts = [t for n in (1024, 2048, 4096) for t in (thue_morse(n), thue_morse(n).translate({0x61: 0x62, 0x62: 0x61}))]
    assert tc.counter(PATH).text_counts(texts) == [count(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "'s", "the", " abc", "中 a", "é", "1 2", "a b", "!? x"]), max_size=60).map("".join), st.integers(2, 40))
def test_slices_do_not_change_counts(text, size):
    data = np.frombuffer(text.encode(), np.uint8)
    assert tc.counter(PATH).counts(data, np.array([0, len(data)]), size).tolist() == [count(text)]


def test_a_very_long_text_is_counted_within_bounds(docs_of):
    text = "Some words, a few numbers 12 and one more line.\n" * 400_000
    tracemalloc.start()
    try:
        got = tc.counter(PATH).counts(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got.tolist() == [400_000 * count("Some words, a few numbers 12 and one more line.\n")]
    assert peak < 300 << 20


def test_repeated_and_null_keys(docs_of):
    docs = docs_of(["one two", "one two", "three"]).withColumn("doc_id", F.when(F.col("doc_id") < 2, F.lit(None)).otherwise(9).cast("long"))
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in tc.count_tokens(docs, PATH).collect()) == [("9", count("three"))] + [("None", count("one two"))] * 2


def test_pieces_that_share_a_number_are_told_apart(monkeypatch):
    """With a mixing that gives all longer spans one number, counts stay those of the library."""
    monkeypatch.setattr(tc, "_mixed", lambda words: np.zeros(words.shape[1], np.uint64))
    held = tc.PrefixCounter(PATH)
    texts = ["internationalization straightforwardness", "electroencephalograph internationalization", " counterrevolutionary" * 3 + " straightforwardly", "responsibilities acknowledgements"]
    assert held.text_counts(texts) == [count(t) for t in texts]
