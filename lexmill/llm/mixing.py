"""Mixing sources to target weights by hierarchical budgeting.

The corpus is a tree: domain, language, source. A token budget starts at the root and goes down by target weights. A
node can take at most its subtree's tokens times ``max_epochs``; what a node cannot take goes to its siblings by their
weights, and only if all of them are full to the level above. This is water-filling: among siblings in the order of
capacity / weight, the full ones keep their capacity and the rest share what is left by weight.

Each leaf then takes exactly its budget as a prefix of its token stream: whole epochs first, then the prefix of one more
epoch, whose order is a hash of seed, epoch and document key. The last document of the prefix may be taken in part.

Finding the cut needs no sort of a leaf: documents fall into ranges of the hash, the ranges' token sums are added up per
leaf, and only the one range in which the budget ends is ordered. A leaf of n documents has about sqrt(n) ranges of sqrt(n)
documents, so that neither the sums nor the ordered range of a hot source grow large. Built-in functions only.

Nulls: a null text has no tokens, and null domains, languages or sources are leaves of their own. A document without
tokens is in no prefix. Rows with a null key have one place in the order, as have repeated rows: at the cut each of them
gives its tokens' share of what is left, rounded down. Texts may be of any length, and extra columns may have any name but
``mix_epochs`` and ``mix_tokens``, which are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.common import cut

SEED = 20
MAX_EPOCHS = 4
LEVELS = ("domain", "lang", "source")


def count_words(text: Column) -> Column:
    """Tokens of a text: runs of characters other than space, tab, CR and LF."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t\r\n]+")).cast("long")


def order_hash(key: Column, epoch: Column, seed: int) -> Column:
    """32 bits of the MD5 of seed, epoch and key: the place of a document in an epoch of its leaf."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), key.cast("string"))), 1, 8), 16, 10).cast("long")


STEPS_AN_OCTAVE = 64


def fill(nodes: DataFrame, parent: list) -> DataFrame:
    """Budgets of siblings: ``nodes`` has the parent's columns, _w, _cap and the parent's _budget; adds _share.

    Siblings fall into steps of capacity / weight, and only sums by step are put in order. A step whose members are all full
    needs no order, nor do those after the first step that is not; that one's members alone are sorted.
    """
    kept, names = nodes.columns, [f"_up{k}" for k in range(len(parent))]
    own = [p if isinstance(p, Column) else F.col(p) for p in parent]
    ratio = F.col("_cap") / F.col("_w")
    nodes = cut(nodes.withColumn("_ratio", ratio).withColumn("_step", F.floor(F.log2(ratio) * STEPS_AN_OCTAVE)))
    sums = nodes.groupBy(*[p.alias(n) for p, n in zip(own, names, strict=True)], "_step").agg(F.sum("_cap").alias("_caps"), F.sum("_w").alias("_ws"), F.max("_ratio").alias("_most"), F.first("_budget").alias("_b"))
    order = Window.partitionBy(*names).orderBy("_step")
    before = F.coalesce(F.sum("_caps").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.coalesce(F.sum("_ws").over(order.rowsBetween(1, Window.unboundedFollowing)), F.lit(0.0))
    not_full = sums.withColumn("_before", before).withColumn("_after", after).where(F.col("_b") - F.col("_before") - F.col("_caps") < F.col("_most") * F.col("_after"))
    opened = not_full.groupBy(*names).agg(F.min(F.struct("_step", "_before", (F.col("_after") + F.col("_ws")).alias("_on"), "_most")).alias("_open"))
    met = nodes.join(opened, [p.eqNullSafe(F.col(n)) for p, n in zip(own, names, strict=True)], "left")
    w = Window.partitionBy(*names).orderBy("_ratio", *[c for c in kept if c in LEVELS]).rowsBetween(Window.unboundedPreceding, -1)
    caps, ws = F.coalesce(F.sum("_cap").over(w), F.lit(0)), F.coalesce(F.sum("_w").over(w), F.lit(0.0))
    level = (F.col("_budget") - F.col("_open._before") - caps) / (F.col("_open._on") - ws)
    # Levels fall from the first node that is not full on: that one's level is what all after it get per weight.
    cuts = met.where("_step = _open._step").withColumn("_level", level).where(F.col("_level") * F.col("_w") < F.col("_cap"))
    levels = cuts.groupBy(*[F.col(n).alias(f"_c{n}") for n in names]).agg(F.max("_level").alias("_level"))
    out = met.join(levels, [F.col(n).eqNullSafe(F.col(f"_c{n}")) for n in names], "left")
    # Without an open step all nodes are full; rounding may leave none open in one, and then its own ratio is the level.
    reached = F.coalesce("_level", "_open._most")
    share = F.when(F.col("_open").isNull() | (F.col("_ratio") <= reached), F.col("_cap").cast("double")).otherwise(F.greatest(reached, F.lit(0.0)) * F.col("_w"))
    return out.withColumn("_share", share).select(*kept, "_share")


def leaf_budgets(leaves: DataFrame, budget: Column, weights: dict[str, dict[str, float]], max_epochs: int) -> DataFrame:
    """Whole-token budget of each leaf with tokens. ``leaves``: domain, lang, source, _tokens. ``budget``: a column over one row.

    ``weights``: for a level, the weight of each name; names not given have 1. A level that is absent goes by tokens.
    """
    if any(v <= 0 for level in weights.values() for v in level.values()):
        raise ValueError("weights must be above 0")
    leaves = leaves.where("_tokens > 0")
    above: list[str] = []
    current = leaves.agg(budget.cast("double").alias("_budget"))
    for level in LEVELS:
        names = [*above, level]
        weight = F.sum("_tokens").cast("double")
        nodes = leaves.groupBy(*names).agg((F.sum("_tokens") * max_epochs).alias("_cap"), weight.alias("_natural"))
        if level in weights:
            given = F.lit(1.0)
            for name, value in sorted(weights[level].items()):
                given = F.when(F.col(level) == name, F.lit(float(value))).otherwise(given)
        nodes = nodes.withColumn("_w", given if level in weights else F.col("_natural"))
        up = current.select(*[F.col(c).alias(f"_up_{c}") for c in above], F.col("_budget"))
        joined = nodes.join(up, [F.col(c).eqNullSafe(F.col(f"_up_{c}")) for c in above]) if above else nodes.join(F.broadcast(up))
        current = fill(joined.drop(*[f"_up_{c}" for c in above]), above or [F.lit(0)])
        current = current.select(*names, F.col("_share").alias("_budget"))
        above = names
    return current.select(*LEVELS, F.floor(F.col("_budget") + 1e-6).cast("long").alias("_leaf_budget"))


def _same_leaf(left: list[str], right: list[str]) -> list[Column]:
    return [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)]


def plan(rows: DataFrame, budget: Column, weights: dict[str, dict[str, float]], *, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """Per leaf: whole epochs, the order (hash, key) at which the prefix of the next one ends, and how many of its tokens are taken.

    ``rows``: _key, domain, lang, source, _tokens of each document, already materialised: it is read a few times.
    """
    leaves = cut(rows.groupBy(*LEVELS).agg(F.sum("_tokens").alias("_tokens"), F.count("*").alias("_docs")))
    budgets = leaf_budgets(leaves, budget, weights, max_epochs)
    mine = [f"_l_{c}" for c in LEVELS]
    own = leaves.select(*[F.col(c).alias(m) for c, m in zip(LEVELS, mine, strict=True)], "_tokens", "_docs")
    planned = cut(own.join(budgets, _same_leaf(mine, list(LEVELS)), "left").select(
        *mine,
        F.when(F.col("_tokens") > 0, F.floor(F.coalesce("_leaf_budget", F.lit(0)) / F.greatest("_tokens", F.lit(1))).cast("long")).otherwise(F.lit(0).cast("long")).alias("epochs"),
        F.when(F.col("_tokens") > 0, F.coalesce("_leaf_budget", F.lit(0)) % F.greatest("_tokens", F.lit(1))).otherwise(F.lit(0)).alias("_rest"),
        F.ceil(F.sqrt(F.col("_docs").cast("double"))).cast("long").alias("_ranges"),
    ))
    placed = with_leaf(rows, planned).withColumn("_hash", order_hash(F.col("_key"), F.col("epochs"), seed)).withColumn("_range", F.shiftright(F.col("_hash") * F.col("_ranges"), 32))
    sums = placed.where("_rest > 0").groupBy(*mine, "_rest", "_range").agg(F.sum("_tokens").alias("_t"))
    running = Window.partitionBy(*mine).orderBy("_range")
    ended = sums.withColumn("_to", F.sum("_t").over(running)).where("_to > _rest").groupBy(*mine).agg(F.min(F.struct("_range", (F.col("_to") - F.col("_t")).alias("_before"))).alias("_cut"))
    last = ended.select(*[F.col(m).alias(f"_c{m}") for m in mine], F.col("_cut._range").alias("_cut_range"), F.col("_cut._before").alias("_before"))
    inside = _join_leaves(placed, last, _same_leaf(mine, [f"_c{m}" for m in mine])).where("_range = _cut_range").groupBy(*mine, "_rest", "_before", "_hash", "_key").agg(F.sum("_tokens").alias("_t"))
    order = Window.partitionBy(*mine).orderBy("_hash", "_key")
    at = inside.withColumn("_to", F.col("_before") + F.sum("_t").over(order)).where("_to > _rest").groupBy(*mine).agg(F.min(F.struct("_hash", "_key", (F.col("_rest") - F.col("_to") + F.col("_t")).alias("_left"), F.col("_t").alias("_all"))).alias("_end"))
    ends = at.select(*[F.col(m).alias(f"_c{m}") for m in mine], "_end")
    return cut(planned.join(ends, _same_leaf(mine, [f"_c{m}" for m in mine]), "left").select(*mine, "epochs", F.col("_end._hash").alias("_end_hash"), F.col("_end._key").alias("_end_key"), F.col("_end._left").alias("_end_left"), F.col("_end._all").alias("_end_all")))


MAX_BROADCAST_LEAVES = 20_000


def _join_leaves(rows: DataFrame, leaves: DataFrame, on: list[Column]) -> DataFrame:
    """Left side kept; leaves broadcast only up to MAX_BROADCAST_LEAVES, else shuffled with hot leaves split by adaptive execution."""
    few = leaves.limit(MAX_BROADCAST_LEAVES + 1).count() <= MAX_BROADCAST_LEAVES
    return rows.join(F.broadcast(leaves) if few else leaves, on)


def with_leaf(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    return _join_leaves(rows, leaves, _same_leaf(list(LEVELS), [f"_l_{c}" for c in LEVELS]))


def taken(docs: DataFrame, leaves: DataFrame, *, seed: int = SEED) -> DataFrame:
    """``docs`` (with _key, domain, lang, source, _tokens) and the leaves' plan: adds epochs and tokens_taken."""
    joined = with_leaf(docs, leaves).withColumn("_hash", order_hash(F.col("_key"), F.col("epochs"), seed))
    at_end = (F.col("_hash") == F.col("_end_hash")) & F.col("_key").eqNullSafe(F.col("_end_key"))
    before = (F.col("_hash") < F.col("_end_hash")) | ((F.col("_hash") == F.col("_end_hash")) & F.coalesce(F.col("_key") < F.col("_end_key"), F.col("_key").isNull() & F.col("_end_key").isNotNull()))
    # Nulls come first, as in the plan's order. Repeated rows share what is left by their tokens.
    share = F.expr("CAST(_tokens AS DECIMAL(18, 0)) * CAST(_end_left AS DECIMAL(18, 0)) div CAST(_end_all AS DECIMAL(18, 0))")
    part = F.when(at_end, share).when(before, F.col("_tokens")).otherwise(F.lit(0))
    return joined.withColumn("tokens_taken", (F.col("_tokens") * F.col("epochs") + part).cast("long")).drop("_hash", "_end_hash", "_end_key", "_end_left", "_end_all", *[f"_l_{c}" for c in LEVELS])


def mix(docs: DataFrame, *, domain: Column, budget_share: float, weights: dict[str, dict[str, float]], key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """Per document: key, domain, lang, source, n_tokens, epochs (whole copies), tokens_taken (of all copies and the part)."""
    rows = cut(docs.select(F.col(key).alias("_key"), domain.alias("domain"), F.col(lang).alias("lang"), F.col(source).alias("source"), count_words(F.col(text)).alias("_tokens")))
    leaves = plan(rows, F.floor(F.sum("_tokens") * budget_share), weights, max_epochs=max_epochs, seed=seed)
    return taken(rows, leaves, seed=seed).select(F.col("_key").alias(key), "domain", "lang", "source", F.col("_tokens").alias("n_tokens"), "epochs", "tokens_taken")


def mixed_documents(docs: DataFrame, *, domain: Column, budget_share: float, weights: dict[str, dict[str, float]], key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The documents of which any token is taken, in their own columns, with ``mix_epochs`` and ``mix_tokens``.

    Texts are read where they lie: the leaves' plan meets them in a join without shuffling them.
    """
    slim = docs.select(F.col(key).alias("_key"), domain.alias("domain"), F.col(lang).alias("lang"), F.col(source).alias("source"), count_words(F.col(text)).alias("_tokens"))
    leaves = plan(cut(slim), F.floor(F.sum("_tokens") * budget_share), weights, max_epochs=max_epochs, seed=seed)
    own = docs.select(F.struct(*docs.columns).alias("_row"), F.col(key).alias("_key"), domain.alias("domain"), F.col(lang).alias("lang"), F.col(source).alias("source"), count_words(F.col(text)).alias("_tokens"))
    kept = taken(own, leaves, seed=seed).where("tokens_taken > 0")
    own_columns = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in ("mix_epochs", "mix_tokens")]
    return kept.select(*own_columns, F.col("epochs").alias("mix_epochs"), F.col("tokens_taken").alias("mix_tokens"))


def epoch_texts(mixed: DataFrame, *, text: str = "text", epoch: str = "mix_epoch") -> DataFrame:
    """The rows of ``mixed_documents`` as the stream of tokens that they stand for: one for each epoch, in the documents' own columns and ``epoch``.

    Whole epochs have the whole text; the last one has its first tokens, up to ``mix_tokens`` in all.
    """
    tokens = count_words(F.col(text))
    part = F.col("mix_tokens") - F.col("mix_epochs") * tokens
    # Behind each token the text may be cut; white space before a token stays with it.
    prefix = F.array_join(F.slice(F.split(F.col(text), r"(?<=[^ \t\r\n])(?=[ \t\r\n])"), F.lit(1), F.col("_part").cast("int")), "")
    rows = mixed.withColumn("_part", part).withColumn("_tokens", tokens)
    spread = rows.withColumn(epoch, F.explode(F.sequence(F.lit(0).cast("long"), F.col("mix_epochs")))).where((F.col(epoch) < F.col("mix_epochs")) | (F.col("_part") > 0))
    own = F.when((F.col(epoch) < F.col("mix_epochs")) | (F.col("_part") >= F.col("_tokens")), F.col(text)).otherwise(prefix)
    return spread.withColumn(text, own).drop("_part", "_tokens", "mix_epochs", "mix_tokens")
