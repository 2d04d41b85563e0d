"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

A document is the set of its shingles (``width`` consecutive words; fewer words, but not none, are one shingle). Two
documents are linked if the Jaccard similarity of their sets is ``threshold`` or more.

1. Documents with equal sets are one representative with a number of copies, so copies are never paired. It has a number
   of its own, as a key may stand for several texts; numbers follow the smallest keys.
2. The forest has ``trees`` prefix tries. A representative's path in a trie is ``max_depth`` MinHash values; the paths of
   all trees are its signature. Representatives that share the first d values of a tree share its node of depth d. A node
   is known by a hash of these values, and its members meet by grouping on it: no sorted path array is kept.
3. The join starts at the deepest nodes and shortens the matched prefixes until the recall is met. A pair of similarity s
   is met at depth d in some tree with chance p(s, d) = 1 - (1 - s^d)^trees, so the links found so far say how many are
   still unseen: each stands for 1 / p(s, d) - 1 others, and one more of just ``threshold`` is assumed. The next depth is
   the greatest one at which that leaves no more than the recall allows, and not half a link; the least depth, at which
   p(threshold, d) itself reaches ``recall`` whatever the data (``prefix_depth``), ends the descent at the latest.
4. Pairs are compared inside trie nodes only, each pair in one place: where it has shared a longer prefix in any tree, or
   one of this length in an earlier tree, it was met before. Two steps do this. The first has signatures only and tells
   which members of a node have anyone new that can be linked to them (set sizes, and at least ``LEAST_SHARED`` of the
   signature alike: a linked pair misses that with a chance below one in ten million). The second has the whole sets of
   those members and verifies the same pairs exactly.
5. A unit of work is a node, or for a large node two of its blocks of about ``block_rows`` members and ``block_shingles``
   shingles, so that no node is gathered whole. A unit gives each member a number of links and a root, not pairs.
6. Roots are united to classes; a class is named by its smallest key, which is that of its smallest number.

Null and wordless texts are linked to nothing and are a class each; so are rows with a null key, which have no class.
Repeated rows (a key twice) are copies of each other if their texts are equal, and are each answered; different texts
under one key are classes of their own, though the key may name both. Very long texts are read in slices; a set takes
eight bytes a shingle. Ties (pairs of just the threshold) are links. Sets hold 64-bit hashes made of SipHash values of the
words. Extra columns may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import cut, few, small_batches
from lexmill.llm.components import components
from lexmill.llm.wordbytes import mix, text_shingles, text_words

WIDTH = 5
THRESHOLD = 0.8
TREES = 24
MAX_DEPTH = 8
RECALL = 0.9999
# The measured recall has to leave a tenth of what the wanted recall allows, as it is an estimate, and no more than half a link unseen.
MARGIN, MOST_UNSEEN = 0.1, 0.5
BLOCK_ROWS = 1_024
BLOCK_SHINGLES = 1 << 19
COLUMNS = 2_048
PAIRS = 1 << 14
# Of the values of two signatures, the share that has to be equal: the threshold less six standard deviations.
LEAST_SHARED = 6.0


def chance(similarity: float | np.ndarray, depth: int, trees: int = TREES):
    """The chance that a pair of this similarity shares a prefix of this depth in one of the trees."""
    return 1 - (1 - similarity**depth) ** trees


def prefix_depth(threshold: float = THRESHOLD, trees: int = TREES, max_depth: int = MAX_DEPTH, recall: float = RECALL) -> int:
    """The greatest depth at which a pair of just ``threshold`` shares a prefix in some trie with probability ``recall``."""
    depth = max_depth
    while depth > 1 and chance(threshold, depth, trees) < recall:
        depth -= 1
    return depth


def least_shared(threshold: float, values: int) -> int:
    """How many of so many MinHash values a pair of ``threshold`` shares all but surely."""
    return max(0, int(values * threshold - LEAST_SHARED * np.sqrt(values * threshold * (1 - threshold))))


class Hashes:
    """MinHash values of all tries: 16 bits of each, ``depth`` of them for each tree."""

    def __init__(self, trees: int, depth: int):
        rng = np.random.default_rng(11)
        n = trees * depth
        self.trees, self.depth = trees, depth
        self.factors = rng.integers(0, 1 << 31, n, np.uint32) * np.uint32(2) + np.uint32(1)
        self.shifts = rng.integers(0, 1 << 32, n, np.uint32)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """The paths of all trees, one after the other; of no shingles: zeros."""
        if not len(shingles):
            return np.zeros(len(self.factors), np.uint16)
        small = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.factors), np.iinfo(np.uint32).max, np.uint32)
        for at in range(0, len(small), 1024):
            values = self.factors[:, None] * small[None, at : at + 1024] + self.shifts[:, None]
            np.minimum(least, values.min(axis=1), out=least)
        return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)

    def prefixes(self, shingles: np.ndarray) -> np.ndarray:
        """The node of each tree that a set lies under at full depth, as one number."""
        return codes(self.signature(shingles)[None, :], self.trees, self.depth)[0]


def codes(signatures: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """For each signature and tree a number of its first ``depth`` values; equal prefixes have equal numbers."""
    paths = signatures.reshape(len(signatures), trees, -1).astype(np.uint64)
    out = np.zeros(paths.shape[:2], np.uint64)
    for d in range(depth):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + paths[:, :, d] + np.uint64(1))
    return out


def set_marks(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit marks of a set; equal sets have equal marks."""
    with np.errstate(over="ignore"):
        return int(mix(shingles).sum(dtype=np.uint64)), int(mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64))


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text of a column."""
    for words in text_words(column):
        yield text_shingles(words, width)


def _signed(values) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    own = F.col(text).cast("string")
    return docs.select(F.col(key).alias("_key"), own.alias("_text"), F.xxhash64(own).alias("hash"))


def signatures(docs: DataFrame, key: str, text: str, width: int, trees: int, depth: int) -> DataFrame:
    """Per row: _key, hash (of the text), n (shingles), m0 and m1 (marks of the set), sig (16-bit values, tree by tree)."""
    kind = docs.schema[key].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(trees, depth)
        for batch in batches:
            sizes, marks, paths = [], [], []
            for s in shingle_sets(batch.column(1), width):
                sizes.append(len(s))
                marks.append(set_marks(s) if len(s) else (0, 0))
                paths.append(hashes.signature(s).tobytes())
            marks_ = _signed(marks).reshape(-1, 2).T.copy()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sizes, pa.int32()), pa.array(marks_[0]), pa.array(marks_[1]), pa.array(paths, pa.binary())], ["_key", "hash", "n", "m0", "m1", "sig"])

    return _texts(docs, key, text).mapInArrow(scan, f"_key {kind}, hash long, n int, m0 long, m1 long, sig binary")


def whole_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables that hold whole units, from batches sorted by ``unit``; a table has the rows of a batch and of a unit at most."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        units = batch.column("unit").to_numpy()
        at = int(np.searchsorted(units, units[-1], "left"))
        if held and held[-1].column("unit")[0].as_py() != units[0]:
            yield pa.Table.from_batches(held)
            held = []
        if at:
            yield pa.Table.from_batches([*held, batch.slice(0, at)])
            held = []
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


class Members:
    """The members of some units, which come sorted by unit and half (0: a node by itself; 1, 2: two blocks of one)."""

    def __init__(self, table: pa.Table, trees: int, depth: int, deeper: int | None):
        self.table, n = table, table.num_rows
        self.unit, half, self.tree, self.size = (table.column(c).to_numpy() for c in ("unit", "half", "tree", "n"))
        self.signatures = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(n, -1)
        self.here = codes(self.signatures, trees, depth)
        self.below = codes(self.signatures, trees, deeper) if deeper else None
        end = np.searchsorted(self.unit, self.unit, "right")
        # The second half of a unit begins after its rows of half 0 or 1.
        firsts = np.concatenate([[0], np.cumsum(half < 2)])
        begin = np.searchsorted(self.unit, self.unit, "left")
        second = begin + firsts[end] - firsts[begin]
        rows = np.arange(n)
        self.low = np.where(half == 0, rows + 1, second)
        self.high = np.where(half == 2, self.low, end)

    def pairs(self, threshold: float, shared: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows that are met here for the first time and can be linked, some at a time, in the order of units."""
        count = np.maximum(self.high - self.low, 0)
        ends = np.cumsum(count)
        at = 0
        while at < len(count):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
            own = count[at:to]
            a = np.repeat(np.arange(at, to), own)
            b = np.arange(len(a)) - np.repeat(np.cumsum(own) - own, own) + np.repeat(self.low[at:to], own)
            at = to
            small, large = np.minimum(self.size[a], self.size[b]), np.maximum(self.size[a], self.size[b])
            can = (small >= threshold * large - 1e-9) & (self.tree[a] == self.tree[b])
            a, b = a[can], b[can]
            alike = self.here[a] == self.here[b]
            # The first tree in which the two share a node of this depth has to be that of the unit.
            new = alike.any(axis=1) & (alike.argmax(axis=1) == self.tree[a])
            if self.below is not None:
                new &= ~(self.below[a] == self.below[b]).any(axis=1)
            a, b = a[new], b[new]
            near = np.count_nonzero(self.signatures[a] == self.signatures[b], axis=1) >= shared
            yield a[near], b[near]


def _wanted(threshold: float, trees: int, values: int, depth: int, deeper: int | None):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_units(batches):
            members = Members(table, trees, depth, deeper)
            needed = np.zeros(table.num_rows, bool)
            for a, b in members.pairs(threshold, least_shared(threshold, values)):
                needed[a] = needed[b] = True
            yield from members.table.select(["unit", "half", "tree", "rep"]).filter(pa.array(needed)).to_batches()

    return scan


def common(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many shingles the sets of each pair of rows have in common."""
    rows_a, a = np.unique(a, return_inverse=True)
    rows_b, b = np.unique(b, return_inverse=True)
    if len(a) <= 4 * (len(rows_a) + len(rows_b)):
        out = np.zeros(len(a), np.int64)
        for k, (x, y) in enumerate(zip(rows_a[a].tolist(), rows_b[b].tolist(), strict=True)):
            small, large = (sets[x], sets[y]) if len(sets[x]) <= len(sets[y]) else (sets[y], sets[x])
            out[k] = np.count_nonzero(large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small)
        return out
    # Many pairs of few rows: products of indicator matrices, some of the common shingles at a time.
    left, right = [sets[k] for k in rows_a.tolist()], [sets[k] for k in rows_b.tolist()]
    a_all, b_all = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(a_all, b_all)

    def places(values: np.ndarray, owners: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        rows = np.repeat(np.arange(len(owners)), [len(s) for s in owners])
        at = np.minimum(np.searchsorted(shared, values), max(len(shared) - 1, 0))
        keep = shared[at] == values if len(shared) else np.zeros(len(values), bool)
        rows, at = rows[keep], at[keep]
        order = np.argsort(at, kind="stable")
        return rows[order], at[order]

    (ar, ac), (br, bc) = places(a_all, left), places(b_all, right)
    both = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(shared), COLUMNS):
        a_lo, a_hi = np.searchsorted(ac, [at, at + COLUMNS])
        b_lo, b_hi = np.searchsorted(bc, [at, at + COLUMNS])
        width = min(COLUMNS, len(shared) - at)
        x, y = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        x[ar[a_lo:a_hi], ac[a_lo:a_hi] - at] = 1
        y[br[b_lo:b_hi], bc[b_lo:b_hi] - at] = 1
        both += x @ y.T
    return both[a, b].astype(np.int64)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n rows the smallest row that the pairs connect it to."""
    root = np.arange(n)
    while True:
        new = root.copy()
        least = np.minimum(root[a], root[b])
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


LINKS = "rep long, links long, near long, pairs long, unseen array<double>"


def _verify(threshold: float, trees: int, values: int, depth: int, deeper: int | None, depths: list[int]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_units(batches):
            members = Members(table, trees, depth, deeper)
            n, column = table.num_rows, members.table.column("shingles")
            sets: dict[int, np.ndarray] = {}
            copies, reps = members.table.column("copies").to_numpy(), members.table.column("rep").to_numpy()
            links, pairs, unseen = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros((n, len(depths)))
            linked = []
            for a, b in members.pairs(threshold, least_shared(threshold, values)):
                edges = [0, *(np.flatnonzero(np.diff(members.unit[a])) + 1).tolist(), len(a)]
                for lo, hi in pairwise(edges):
                    if lo == hi:
                        continue
                    rows = np.unique(np.concatenate([a[lo:hi], b[lo:hi]])).tolist()
                    # Sets of units that are done are let go.
                    sets = {k: sets[k] if k in sets else np.frombuffer(column[k].as_py(), np.uint64) for k in rows}
                    both = common(sets, a[lo:hi], b[lo:hi])
                    ratio = both / (members.size[a[lo:hi]] + members.size[b[lo:hi]] - both)
                    yes = ratio >= threshold - 1e-12
                    x, y = a[lo:hi][yes], b[lo:hi][yes]
                    np.add.at(links, x, copies[y])
                    np.add.at(links, y, copies[x])
                    np.add.at(pairs, x, 1)
                    for k, d in enumerate(depths):
                        np.add.at(unseen[:, k], x, 1 / chance(ratio[yes], d, trees) - 1)
                    linked.append((x, y))
            if not linked:
                continue
            roots = _roots(n, *(np.concatenate(c) for c in zip(*linked, strict=True)))
            some = np.flatnonzero(links > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(reps[some]), pa.array(links[some]), pa.array(reps[roots[some]]), pa.array(pairs[some]), pa.array(unseen[some].tolist(), pa.list_(pa.float64()))], ["rep", "links", "near", "pairs", "unseen"]
            )

    return scan


def measured_recall(pairs: int, unseen: float, threshold: float, depth: int, trees: int) -> float:
    """Share of the links that are found, by the found ones and one that is assumed to have just the threshold."""
    return (pairs + chance(threshold, depth, trees)) / (pairs + unseen + 1)


def enough(pairs: int, unseen: float, threshold: float, depth: int, trees: int, recall: float) -> bool:
    """Whether a join that stops at this depth should miss no more than ``MOST_UNSEEN`` links and a small share of all."""
    return unseen + 1 - chance(threshold, depth, trees) <= MOST_UNSEEN and measured_recall(pairs, unseen, threshold, depth, trees) >= 1 - MARGIN * (1 - recall)


def _by_unit(rows: DataFrame) -> DataFrame:
    return rows.repartition("unit").sortWithinPartitions("unit", "half", "rep")


def forest_links(reps: DataFrame, docs: DataFrame, key: str, text: str, width: int, threshold: float, trees: int, max_depth: int, recall: float, block_rows: int, block_shingles: int) -> DataFrame:
    """Rows rep, links, near: in several rows, the number of links of each linked representative and others of its class."""
    floor = prefix_depth(threshold, trees, max_depth, recall)
    depths, found = list(range(max_depth, floor - 1, -1)), []
    depth, deeper = max_depth, None
    while True:
        new = cut(_level(reps, docs, key, text, width, threshold, trees, max_depth, depth, deeper, depths, block_rows, block_shingles))
        found.append(new)
        sums = [r for r in (f.agg(F.sum("pairs").alias("pairs"), *[F.sum(F.col("unseen")[k]).alias(f"u{k}") for k in range(len(depths))]).first() for f in found)]
        pairs = sum(r["pairs"] or 0 for r in sums)
        reached = {d: enough(pairs, sum(r[f"u{k}"] or 0.0 for r in sums), threshold, d, trees, recall) for k, d in enumerate(depths)}
        if depth == floor or reached[depth]:
            break
        depth, deeper = next((d for d in depths if d < depth and reached[d]), floor), depth
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _level(reps: DataFrame, docs: DataFrame, key: str, text: str, width: int, threshold: float, trees: int, max_depth: int, depth: int, deeper: int | None, depths: list[int], block_rows: int, block_shingles: int) -> DataFrame:
    """Links of the pairs that share a node of this depth, but of no greater depth that was visited."""

    def node(t: int, d: int):
        return F.xxhash64(F.lit(t), F.substring("sig", 2 * max_depth * t + 1, 2 * d))

    under = reps.select("rep", "n", F.posexplode(F.array(*[F.struct(node(t, depth).alias("node"), (node(t, deeper) if deeper else F.lit(0).cast("long")).alias("child")) for t in range(trees)])).alias("tree", "x")).select("rep", "n", "tree", "x.*")
    blocks = F.greatest(F.ceil(F.count("*") / block_rows), F.ceil(F.sum("n") / block_shingles)).cast("int")
    sized = under.groupBy("node").agg(F.count("*").alias("size"), F.min("child").alias("c0"), F.max("child").alias("c1"), blocks.alias("blocks"))
    # All pairs of a node with one child were met in that child.
    nodes = sized.where("size > 1 and c0 <> c1" if deeper else "size > 1").select("node", "blocks")
    # The second key keeps the join from reusing the aggregation's partitions, so adaptive execution may split a hot node.
    live = under.select("rep", "tree", "node").withColumn("_k", F.xxhash64("node")).join(nodes.withColumn("_k", F.xxhash64("node")), ["node", "_k"])
    places = live.groupBy("rep").agg(F.collect_list(F.struct("tree", "node", "blocks")).alias("places"))  # at most one for each tree
    placed = places.join(reps.select("rep", "n", "sig"), "rep").select("rep", "n", "sig", F.explode("places").alias("p")).select("rep", "n", "sig", "p.*")
    block = F.pmod(F.xxhash64("rep"), F.col("blocks").cast("long")).cast("int")
    dealt = placed.withColumn("block", block).select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    units = dealt.select(
        F.xxhash64("node", F.least("block", "other"), F.greatest("block", "other")).alias("unit"),
        F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("half"), "tree", "rep", "n", "sig",
    )
    kept = "unit long, half int, tree int, rep long"
    wanted = cut(_by_unit(units).mapInArrow(_wanted(threshold, trees, trees * max_depth, depth, deeper), kept))

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, hashes = set(), Hashes(trees, max_depth)
        for batch in batches:
            sets, paths, keep = [], [], []
            for s, m0, m1, rep in zip(shingle_sets(batch.column(0), width), *(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                # A row may come several times, and a key with another text of equal hash: the marks tell which text is meant.
                keep.append(rep not in seen and _signed(set_marks(s)).tolist() == [m0, m1])
                sets.append(s.tobytes() if keep[-1] else None)
                paths.append(hashes.signature(s).tobytes() if keep[-1] else None)
                if keep[-1]:
                    seen.add(rep)
            yield pa.RecordBatch.from_arrays([*batch.columns[3:], pa.array(paths, pa.binary()), pa.array(sets, pa.binary())], ["rep", "n", "copies", "sig", "shingles"]).filter(pa.array(keep, pa.bool_()))

    asked = few(reps.join(wanted.select("rep").distinct(), "rep", "left_semi").select("m0", "m1", "rep", "n", "copies", "least", "hash"))
    texts = _texts(docs, key, text)
    met = texts.join(asked, texts["_key"].eqNullSafe(asked["least"]) & (texts["hash"] == asked["hash"])).select("_text", "m0", "m1", "rep", "n", "copies")
    # Rows of one key and text may lie in several tasks: one of them stays.
    sets = met.mapInArrow(with_sets, "rep long, n int, copies long, sig binary, shingles binary").dropDuplicates(["rep"])
    full = wanted.join(sets, "rep")
    return _by_unit(full).mapInArrow(_verify(threshold, trees, trees * max_depth, depth, deeper, depths), LINKS)


def _classed(docs: DataFrame, *, null_keys: bool = False, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, width: int = WIDTH, trees: int = TREES, max_depth: int = MAX_DEPTH, recall: float = RECALL, block_rows: int = BLOCK_ROWS, block_shingles: int = BLOCK_SHINGLES) -> tuple[DataFrame, DataFrame]:
    """``signatures`` of all rows, and per representative: m0, m1, n, rep (number), least (key) and hash of one of its texts, copies, links (or null), root (number), class_id.

    Rows with a null key are left out, or with ``null_keys`` are texts as any other, after all keys.
    """
    rows = cut(signatures(small_batches(docs), key, text, width, trees, max_depth))
    sets_of = rows.where("n > 0" if null_keys else "n > 0 and _key is not null").groupBy("m0", "m1", "n").agg(
        F.min("_key").alias("least"), F.coalesce(F.min_by("hash", "_key"), F.min("hash")).alias("hash"), F.count("*").alias("copies"), F.first("sig").alias("sig")
    )
    # Numbers are fixed by the cut, and follow the order: a class's smallest number has its smallest key.
    reps = cut(sets_of.orderBy(F.asc_nulls_last("least"), "m0", "m1", "n").withColumn("rep", F.monotonically_increasing_id()))
    links = forest_links(reps, docs, key, text, width, threshold, trees, max_depth, recall, block_rows, block_shingles)
    united = components(links.select(F.col("rep").alias("a"), F.col("near").alias("b")))
    heads = united.join(reps.select(F.col("rep").alias("root"), F.col("least").alias("head")), "root").select(F.col("node").alias("rep"), "root", "head")
    counted = links.groupBy("rep").agg(F.sum("links").alias("links"))
    named = reps.drop("sig").join(counted, "rep", "left").join(heads, "rep", "left")
    return rows, named.withColumn("class_id", F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("head"))).withColumn("root", F.coalesce("root", "rep")).drop("head")


def classes(docs: DataFrame, *, key: str = "doc_id", **options) -> DataFrame:
    """Per row: key, class_id (smallest key of its class), n_links (other documents it is linked to, copies included), n_copies."""
    rows, named = _classed(docs, key=key, **options)
    answers = named.select("m0", "m1", "n", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "copies")
    slim = rows.select("_key", "m0", "m1", F.when(F.col("_key").isNotNull() & (F.col("n") > 0), F.col("n")).alias("n"))
    return slim.join(answers, ["m0", "m1", "n"], "left").select(
        F.col("_key").alias(key), F.coalesce("class_id", "_key").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies")
    )


def one_of_each(docs: DataFrame, *, key: str = "doc_id", text: str = "text", nulls_apart: bool = True, **options) -> DataFrame:
    """One row of each class, in its own columns: a text under the smallest key; of rows that repeat key and text any one.

    Wordless rows are a class each and stay. Rows with a null key stay as well, or without ``nulls_apart`` are compared as
    any other, and left only where no text of their class has a key.
    """
    rows, named = _classed(docs, null_keys=not nulls_apart, key=key, text=text, **options)
    heads = named.where("rep = root").select(F.col("least").alias("_kept"), F.col("hash").alias("_mark"))
    seen = rows.where("n > 0 and _key is not null" if nulls_apart else "n > 0").groupBy(F.col("_key").alias("_again"), F.col("hash").alias("_copy")).count().where("count > 1").drop("count")
    same = F.col("_kept").eqNullSafe(F.col("_again")) & (F.col("_mark") == F.col("_copy"))
    repeated = cut(heads.join(seen, same, "left_semi"))
    wordless = rows.where("n = 0 and _key is not null" if nulls_apart else "n = 0").select(F.col("_key").alias("_kept"), F.col("hash").alias("_mark")).distinct()
    own = F.xxhash64(F.col(text).cast("string"))

    def of(kept: DataFrame) -> DataFrame:
        return docs.join(kept.hint("shuffle_hash"), docs[key].eqNullSafe(kept["_kept"]) & (own == kept["_mark"]), "left_semi")

    out = of(heads.join(seen, same, "left_anti").unionAll(wordless))
    if not repeated.isEmpty():
        whole = of(repeated).select(F.struct(*docs.columns).alias("row"), F.col(key).alias("k"), own.alias("h"))
        # Partial sums leave one row of a task, so a hot key's copies do not meet in one place.
        once = whole.groupBy("k", "h").agg(F.first("row").alias("row"))
        out = out.unionByName(once.select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
    return out.unionByName(docs.where(F.col(key).isNull())) if nulls_apart else out
