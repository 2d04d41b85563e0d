"""URL filters: FP-growth rules over URL tokens, matched by an inverted index, below explicit host and path rules.

Mining: each labelled URL is a basket of its host and path tokens, with one more item where the label says block. Tokens
that stand in exactly the same baskets are one group: any of them stands for all, so mining has one item for each group, and
many repeats of one URL do not make a number of item sets that is exponential in its tokens. FP-growth finds the frequent
baskets; rules that conclude "block" are kept if they reach the least support (a share of the labelled URLs, and a count
below which chance decides) and confidence, and a rule goes when a more general one (fewer groups) is at least as confident.
A rule is a list of groups and fires when a URL has a token of each; that is the same as all rules of one token of each
group (``mine_rules`` lists these).

Matching: the index holds each rule under the tokens of its rarest group, so a URL meets only rules that share such a token.
Built-in functions and joins only; nothing is gathered on the driver but what FP-growth itself keeps there (the frequent
single items, at most the mean basket size / the least support).

The rules are broadcast only while the index has at most ``max_broadcast_rules`` entries; otherwise the join shuffles, with
hot tokens split by adaptive execution. Null URLs have an empty host and path and no token; URLs may be of any length.
Repeated rows are each judged; of several rules that fire the strongest confidence is given, of explicit rules the longest
decides (no two of one length fit a URL). Extra columns may have any name. An empty table gives an empty result; without
labels no rule is mined and the method allows all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import ascii_lower, cut

BLOCK_ITEM = "=block"
MIN_SUPPORT = 0.001
MIN_COUNT = 10
MIN_CONFIDENCE = 0.6
MAX_BROADCAST_RULES = 20_000


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``, empty without one. Located, as a repeated group would recurse for each character of a long URL."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """Distinct tokens: host labels, host words, path words and query words, marked by where they stand."""
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)

    def marked(mark: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda t: t != ""), lambda t: F.concat(F.lit(mark), t))

    return F.array_distinct(F.concat(
        marked("d:", F.split(host, r"\.")),
        marked("h:", F.flatten(F.transform(F.filter(F.split(host, r"\."), lambda p: p.rlike("[^a-z0-9]")), lambda p: F.split(p, "[^a-z0-9]+")))),
        marked("p:", F.filter(F.split(F.lower(path), r"[^a-z0-9]+"), lambda t: ~t.rlike("^[0-9]+$"))),
        marked("q:", F.filter(F.split(F.lower(query), r"[^a-z0-9_]+"), lambda t: ~t.rlike("^[0-9]+$"))),
    ))


def token_groups(tokens: DataFrame, least: int) -> DataFrame:
    """Groups of tokens that stand in the same baskets: first (the least token, which stands for the group), members. ``tokens``: _id, token.

    Groups of fewer than ``least`` baskets are left out. A group has no more members than the URL they all stand in.
    """
    marks = [F.bit_xor(F.xxhash64("_id", F.lit(k))).alias(f"_m{k}") for k in range(2)]
    sets = tokens.groupBy("token").agg(F.count("*").alias("_n"), *marks).where(F.col("_n") >= least)
    return sets.groupBy("_n", "_m0", "_m1").agg(F.array_sort(F.collect_list("token")).alias("members")).select(F.col("members")[0].alias("first"), "members")


def mine_groups(labelled: DataFrame, url: str, blocked: Column, *, min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (groups, n_tokens, confidence, support) that conclude "block". ``labelled``: a row for each labelled URL."""
    rows = labelled.select(tokens_of(F.col(url)).alias("_t"), F.coalesce(blocked, F.lit(False)).alias("_b"))
    baskets = cut(rows.where("_b or size(_t) > 0").withColumn("_id", F.monotonically_increasing_id()))
    n = baskets.count()
    if n < min_count:
        return labelled.sparkSession.createDataFrame([], "groups array<array<string>>, n_tokens int, confidence double, support double")
    support = max(min_support, min_count / n)
    tokens = baskets.select("_id", F.explode("_t").alias("token"))
    groups = cut(token_groups(tokens, int(support * n)))
    own = tokens.join(groups.select(F.col("first").alias("token")), "token", "left_semi").groupBy("_id").agg(F.collect_list("token").alias("_own"))
    items = F.concat(F.coalesce("_own", F.array().cast("array<string>")), F.when(F.col("_b"), F.array(F.lit(BLOCK_ITEM))).otherwise(F.array().cast("array<string>")))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(cut(baskets.join(own, "_id", "left").select(items.alias("items"))))
    found = model.associationRules.where(F.col("consequent")[0] == BLOCK_ITEM)
    rules = cut(found.select(F.array_sort("antecedent").alias("rule_tokens"), "confidence", "support"))
    # A more general rule has a subset of the tokens: it is met under each of the longer rule's tokens it starts with.
    general = rules.select(F.col("rule_tokens")[0].alias("_first"), F.col("rule_tokens").alias("_g"), F.col("confidence").alias("_c"))
    long = rules.select("rule_tokens", "confidence", F.explode("rule_tokens").alias("_first"))
    beaten = long.join(general, "_first").where((F.size("_g") < F.size("rule_tokens")) & (F.size(F.array_except("_g", "rule_tokens")) == 0) & (F.col("_c") >= F.col("confidence"))).select("rule_tokens").distinct()
    kept = rules.join(beaten, "rule_tokens", "left_anti").withColumn("first", F.explode("rule_tokens"))
    return kept.join(groups, "first").groupBy("rule_tokens", "confidence", "support").agg(F.array_sort(F.collect_list("members")).alias("groups")).select("groups", F.size("groups").alias("n_tokens"), "confidence", "support")


def mine_rules(labelled: DataFrame, url: str, blocked: Column, **options) -> DataFrame:
    """The mined rules token by token (rule_tokens, n_tokens, confidence, support): one for each choice from a rule's groups."""
    choices = F.aggregate("groups", F.array(F.array().cast("array<string>")), lambda acc, g: F.flatten(F.transform(acc, lambda a: F.transform(g, lambda t: F.array_append(a, t)))))
    return mine_groups(labelled, url, blocked, **options).select(F.explode(choices).alias("_c"), "n_tokens", "confidence", "support").select(F.array_sort("_c").alias("rule_tokens"), "n_tokens", "confidence", "support")


def rule_index(rules: DataFrame, urls: DataFrame, url: str) -> DataFrame:
    """Posting entries (token, groups, confidence): each rule under the tokens of the group that fewest URLs have."""
    frequency = urls.select(F.explode(tokens_of(F.col(url))).alias("token")).groupBy("token").count()
    spread = rules.select("groups", "confidence", F.explode("groups").alias("_g")).select("*", F.explode("_g").alias("token"))
    counts = frequency.join(spread.select("token").distinct(), "token", "left_semi")
    # A token that no URL has makes its group no larger.
    sized = spread.join(counts, "token", "left").groupBy("groups", "confidence", "_g").agg(F.sum(F.coalesce("count", F.lit(0))).alias("_n"))
    rarest = sized.groupBy("groups", "confidence").agg(F.min(F.struct("_n", "_g")).alias("m"))
    return rarest.select(F.explode("m._g").alias("token"), "groups", "confidence")


def explicit_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Rule string and verdict of the longest fitting rule of (verdict, host + path), null if none fits."""
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        own_host, slash, own_path = rule.partition("/")
        own_host = own_host.lower()
        here = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(slash + own_path)
        fits.append((here, rule, verdict))
    if not fits:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    pick = lambda k: reduce(lambda acc, f: acc.when(f[0], f[k]), fits[1:], F.when(fits[0][0], fits[0][k]))
    return pick(1), pick(2)


def judge(pages: DataFrame, labelled: DataFrame, blocked: Column, *, explicit: list[tuple[str, str]] = (), key: str = "page_id", url: str = "url", label_url: str = "url", min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE, max_broadcast_rules: int = MAX_BROADCAST_RULES) -> DataFrame:
    """Per page: key, host, path, rule, verdict, mined_confidence (of the strongest mined rule that fires, else null)."""
    rules = cut(mine_groups(labelled, label_url, blocked, min_support=min_support, min_count=min_count, min_confidence=min_confidence))
    own = pages.select(F.col(key).alias("_key"), F.col(url).cast("string").alias("_url"))
    index = cut(rule_index(rules, own, "_url"))
    if index.count() <= max_broadcast_rules:
        index = F.broadcast(index)
    # Equal URLs fire the same rules: they are matched once.
    distinct = own.where("_url is not null").select("_url").distinct().select("_url", tokens_of(F.col("_url")).alias("_t"))
    fired = distinct.select("_url", "_t", F.explode("_t").alias("token")).join(index, "token").where(F.forall("groups", lambda g: F.arrays_overlap(g, F.col("_t"))))
    strongest = fired.groupBy("_url").agg(F.max("confidence").alias("mined_confidence"))
    joined = own.join(strongest, "_url", "left").select("_key", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"), "mined_confidence")
    rule, verdict = explicit_rule(F.col("host"), F.col("path"), list(explicit))
    method = F.when(F.col("mined_confidence").isNotNull(), "block").otherwise("allow")
    return joined.select(F.col("_key").alias(key), "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), F.round("mined_confidence", 6).alias("mined_confidence"))
