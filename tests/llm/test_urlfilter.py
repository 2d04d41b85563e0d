from itertools import combinations
from urllib.parse import urlsplit

import pytest
from pyspark.sql import functions as F

from lexmill.llm import urlfilter as u
from lexmill.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/7x?a=1#b", "https://example.com/en/8", "https://com/en/", "https://notcom/en/1", "http://a.net/de/1", "http://x.example.net/de/80", "http://b.example.org/es/1", "http://b.example.org/esx",
    "http://b.example.org?/es/", "a://b://c/en", "http://k.example.com#/en/", "http://É.com/en/x", "http://b.example.org/es/1", "http://u\n.com/p\nq?r",
]


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    tail = rest[end:]
    cut = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), tail[:cut]


def explicit(host, path):
    best = None
    for verdict, rule in URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(k, t) for k, t in enumerate(URLS)], "page_id long, url string").withColumns({c: F.lit("x") for c in ("host", "path", "_t", "token", "confidence")})


def test_hosts_paths_and_rules(pages, spark):
    none = spark.createDataFrame([], "url string")
    rows = {r["page_id"]: r for r in u.judge(pages, none, F.lit(True), explicit=URL_RULES).collect()}
    for k, t in enumerate(URLS):
        host, path = parts(t)
        rule = explicit(host, path)
        assert (rows[k]["host"], rows[k]["path"]) == (host, path) and (rows[k]["rule"], rows[k]["verdict"]) == (rule or (None, "allow")), t
    assert u.judge(pages.limit(0), none, F.lit(True)).count() == 0


def test_very_long_urls(spark):
    urls = ["a" * 300_000, "é😀" * 100_000 + "://x.com/" + "p" * 300_000 + "?q", "http://" + "H." * 100_000, "x://" * 50_000]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").select("page_id", u.host_of(F.col("url")).alias("host"), u.path_of(F.col("url")).alias("path")).collect()
    assert {r["page_id"]: (r["host"], r["path"]) for r in rows} == {k: parts(t) for k, t in enumerate(urls)}


def labelled_urls():
    out = []
    for k in range(300):
        spam = k % 5 == 0
        host = ["cheap-pills", "www.cheap-pills"][k // 5 % 2] if spam else ["shop", "blog", "news", "cheap-pills"][k % 40 % 4 if k % 8 else 3]
        out.append((f"https://{host}.example.com/{['en', 'fr'][k % 2]}/{k}" + ("?utm=x" if k % 3 else ""), spam or k % 50 == 7))
    return out


def brute_rules(labelled, tokens, min_count, min_confidence):
    n = len(labelled)
    sets = [(frozenset(t), bad) for t, (_, bad) in zip(tokens, labelled, strict=True)]
    seen = {c for t, bad in sets if bad for r in range(1, len(t) + 1) for c in combinations(sorted(t), r)}
    rules = {}
    for c in seen:
        both = sum(set(c) <= t and bad for t, bad in sets)
        every = sum(set(c) <= t for t, _ in sets)
        if both >= min_count and both / every >= min_confidence:
            rules[c] = both / every
    return {c: x for c, x in rules.items() if not any(set(d) < set(c) and y >= x for d, y in rules.items())}, n


def test_mined_rules_and_matches_are_those_of_brute_force(spark):
    labelled = labelled_urls()
    rows = spark.createDataFrame([(k, x, b) for k, (x, b) in enumerate(labelled)], "page_id long, url string, bad boolean")
    tokens = [r[0] for r in rows.orderBy("page_id").select(u.tokens_of(F.col("url"))).collect()]
    assert tokens[0] and all(len(set(t)) == len(t) for t in tokens) and "h:pills" in tokens[0] and urlsplit(labelled[0][0]).hostname.split(".")[-1] == "com"
    want, _ = brute_rules(labelled, tokens, 10, 0.6)
    got = u.mine_rules(rows, "url", F.col("bad"), min_support=0.0001, min_count=10, min_confidence=0.6).collect()
    assert {tuple(r["rule_tokens"]): round(r["confidence"], 9) for r in got} == {c: round(x, 9) for c, x in want.items()} and want
    for most in (u.MAX_BROADCAST_RULES, 0):
        judged = u.judge(rows, rows, F.col("bad"), min_support=0.0001, max_broadcast_rules=most).collect()
        for r in judged:
            fires = [x for c, x in want.items() if set(c) <= set(tokens[r["page_id"]])]
            assert r["verdict"] == ("block" if fires else "allow") and r["mined_confidence"] == (round(max(fires), 6) if fires else None)


@pytest.mark.parametrize("n", [12, 25, 60])
def test_repeats_of_a_long_url_are_mined_at_once(spark, n):
    """Words that always stand together are one item: not 2^n sets."""
    long = "http://bad.example.com/" + "/".join(f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(n))
    half = "http://bad.example.com/" + "/".join(f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(n // 2))
    rows = [(long, True)] * 10 + [(half, k < 2) for k in range(10)] + [(f"http://fine.example.com/p{'abcdefghij'[k % 10]}x", False) for k in range(20)]
    labelled = spark.createDataFrame(rows, "url string, bad boolean")
    rules = u.mine_groups(labelled, "url", F.col("bad"), min_count=10, min_confidence=0.6).collect()
    last = f"p:word{chr(97 + (n - 1) // 26)}{chr(97 + (n - 1) % 26)}"
    assert any(r["confidence"] == 1.0 and len(r["groups"]) == 1 and last in r["groups"][0] for r in rules)
    judged = {r["host"] + r["path"]: r["verdict"] for r in u.judge(labelled.withColumn("page_id", F.lit(1)), labelled, F.col("bad")).collect()}
    assert judged["bad.example.com" + long.split(".com")[1]] == "block" and judged["fine.example.com/pax"] == "allow"


def test_null_labels_do_not_block(spark):
    labelled = spark.createDataFrame([("http://a.example.com/x", None)] * 20, "url string, bad boolean")
    assert u.mine_groups(labelled, "url", F.col("bad")).count() == 0


def test_repeated_rows_and_null_keys_are_each_judged(spark):
    rows = [(1, "http://com/en/a"), (1, "http://com/en/a"), (None, "http://com/en/a"), (1, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = sorted((str(r["page_id"]), r["host"], r["rule"], r["verdict"]) for r in u.judge(pages, spark.createDataFrame([], "url string"), F.lit(True), explicit=URL_RULES).collect())
    assert got == [("1", "", None, "allow"), ("1", "com", "com/en/", "block"), ("1", "com", "com/en/", "block"), ("None", "com", "com/en/", "block")]
