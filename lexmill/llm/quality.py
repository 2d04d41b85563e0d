"""Quality classifier: Naive Bayes support vectors (n-gram indicators scaled by class log-count ratios, linear hinge loss).

Features are indicators of n-grams, hashed into 2**20 places: words and pairs of words, and runs of three and four token
shapes (lower case, capitalised, upper case, digits, each mark itself, new line; with a sign for a word that repeats the
one before it), so that the model also sees how a text is written. Each indicator is scaled by the log ratio of its smoothed
class counts, rows are scaled to unit length, and weights minimise the L2-regularised hinge loss by dual coordinate
descent. A logistic curve, fitted on labelled rows that the weights have not seen, turns margins into scores.

The model is fitted on a sample of about ``max_rows`` labelled rows, chosen by a hash of the document key, and of those on as
many as have ``max_places`` features in all (33 million; 10,000 rows of a thousand words have half of that). It is fitted in
one task, which these bound; what reaches the driver is the model: 8 MB. Scoring is a map over all rows without a shuffle.

Null texts count as empty; an empty text has no feature and the score of margin 0. Long texts are read in slices. Labels
other than 0 and 1 and null keys are left out of the fit; a null key is not held out. Equal texts have equal scores, and a
score of just the threshold is good. Extra columns may have any name. Repeated rows are each scored; in the fit a key's repeats count once for each label, by the least text of the key. With one class only, or none, all scores are that class's share
(0.5 without labels). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.common import cut, small_batches
from lexmill.llm.wordbytes import IS_WORD, LOWER, SLICE, apart, mix, slices, text_chunks, word_hashes

BITS = 20
SIZE = 1 << BITS
MAX_ROWS = 10_000
MAX_PLACES = 1 << 25
THRESHOLD = 0.3
# Tokens that a slice of a long text has from the one before it; n-grams have four at most.
CARRIED = 16
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _kinds() -> np.ndarray:
    """0: white space and controls, 1: word byte, 2: any other mark, 3: new line."""
    table = np.full(256, 2, np.uint8)
    table[:0x21] = 0
    table[0x7F] = 0
    table[IS_WORD == 1] = 1
    table[0x0A] = 3
    return table


KIND = _kinds()
# Bytes of tokens as they are, A-Z lower-cased; all others as a space. A new line, which is a token, becomes a byte that is in no token.
NEW_LINE = 1
TOKENS_ONLY = bytes(NEW_LINE if KIND[b] == 3 else int(LOWER[b]) if KIND[b] else 0x20 for b in range(256))


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Kind, hash and shape of each token, and for each text the index of its first token (one more at the end)."""
    kind = KIND[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    bounds = np.flatnonzero(edge)
    starts, ends = bounds[:-1], bounds[1:]
    solid = kind[starts] > 0
    starts, ends = starts[solid], ends[solid]
    own, sizes = kind[starts], ends - starts
    hashes = word_hashes(apart(np.frombuffer(data.tobytes().translate(TOKENS_ONLY), np.uint8), starts, ends).split(b" ")[:-1])
    upper = np.concatenate([[0], np.cumsum((data >= 0x41) & (data <= 0x5A), dtype=np.int32)])
    digit = np.concatenate([[0], np.cumsum((data >= 0x30) & (data <= 0x39), dtype=np.int32)])
    ups, digits = upper[ends] - upper[starts], digit[ends] - digit[starts]
    shape = np.where(ups == 0, 1, np.where(ups == sizes, 2, 3)) + 3 * (digits > 0) + 6 * np.minimum(sizes // 8, 2)
    shape = np.where(own == 1, shape, np.where(own == 3, 90, 0)).astype(np.uint64)
    return own, hashes, np.where(own == 2, hashes, mix(shape)), np.searchsorted(starts, offsets)


def grams_of(own: np.ndarray, hashes: np.ndarray, shape: np.ndarray) -> list[np.ndarray]:
    """Places of the n-grams that begin at each token: of one and two tokens, of three and four shapes."""
    words = np.flatnonzero(own == 1)
    same = np.zeros(len(own), np.uint64)
    if len(words) > 1:
        same[words[1:]] = hashes[words[1:]] == hashes[words[:-1]]
    shape = mix(shape + same * np.uint64(977))
    nxt = lambda h, k: np.concatenate([h[k:], np.zeros(min(k, len(h)), np.uint64)])
    two = mix(hashes * _STEP + nxt(hashes, 1))
    three = mix((shape * _STEP + nxt(shape, 1)) * _STEP + nxt(shape, 2) + np.uint64(3))
    four = mix(((shape * _STEP + nxt(shape, 1)) * _STEP + nxt(shape, 2)) * _STEP + nxt(shape, 3) + np.uint64(4))
    shift = np.uint64(64 - BITS)
    return [(g >> shift).astype(np.int32) for g in (hashes, two, three, four)]


def _places(grams: list[np.ndarray], a: int, b: int) -> np.ndarray:
    return np.concatenate([g[a : a + max(0, b - a - k)] for k, g in enumerate(grams)]) if b > a else np.zeros(0, np.int32)


def features_of(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The feature places of each text, with repeats."""
    if not len(data):
        return [np.zeros(0, np.int32)] * (len(offsets) - 1)
    own, hashes, shape, first = tokens_of(data, offsets)
    grams = grams_of(own, hashes, shape)
    return [_places(grams, a, b) for a, b in pairwise(first.tolist())]


class Distinct:
    """Distinct values of small integer arrays without sorting: the last writer of a place keeps it."""

    def __init__(self) -> None:
        self.mark = np.zeros(SIZE, np.int32)

    def __call__(self, values: np.ndarray) -> np.ndarray:
        order = np.arange(len(values), dtype=np.int32)
        self.mark[values] = order
        return values[self.mark[values] == order]


class Features:
    """The distinct feature places of texts, for one task."""

    def __init__(self) -> None:
        self.distinct = Distinct()

    def __call__(self, column: pa.Array) -> Iterator[np.ndarray]:
        for _, _, data, offsets in text_chunks(column):
            if len(data) > SLICE:
                yield self.long(data)
            else:
                yield from map(self.distinct, features_of(data, offsets))

    def long(self, data: np.ndarray) -> np.ndarray:
        """Those of one long text, in slices; a slice starts with the last tokens of the one before it."""
        seen, held = np.zeros(SIZE, bool), None
        for raw in slices(data, KIND):
            part = np.frombuffer(raw, np.uint8)
            now = tokens_of(part, np.array([0, len(part)]))[:3]
            held = now if held is None else tuple(np.concatenate([h[-CARRIED:], n]) for h, n in zip(held, now, strict=True))
            seen[_places(grams_of(*held), 0, len(held[0]))] = True
        return np.flatnonzero(seen).astype(np.int32)


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray] | UnitRows, signs: np.ndarray, costs: np.ndarray, *, epochs: int = 12, tolerance: float = 1e-3, seed: int = 7) -> np.ndarray:
    """Weights that minimise |w|^2 / 2 + sum of cost * hinge loss. A row: places and values; its dual variable stays in [0, cost]."""
    weights, alpha = np.zeros(SIZE), np.zeros(len(rows))
    squares = np.array([float(v @ v) for v in (values[i] for i in range(len(rows)))])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)).tolist():
            if squares[i] == 0:
                continue
            own = values[i]
            gradient = signs[i] * float(weights[rows[i]] @ own) - 1
            projected = min(gradient, 0) if alpha[i] == 0 else max(gradient, 0) if alpha[i] == costs[i] else gradient
            worst = max(worst, abs(projected))
            if projected:
                new = min(max(alpha[i] - gradient / squares[i], 0.0), costs[i])
                weights[rows[i]] += (new - alpha[i]) * signs[i] * own
                alpha[i] = new
        if worst < tolerance:
            break
    return weights


class UnitRows:
    """Rows of scaled indicators with unit length, each made when it is asked for: only the features' places are kept."""

    def __init__(self, rows: list[np.ndarray], ratio: np.ndarray):
        self.rows, self.ratio = rows, ratio
        self.norms = np.array([float(np.sqrt(ratio[r] @ ratio[r])) or 1.0 for r in rows])

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.ratio[self.rows[i]] / self.norms[i]


def log_ratios(rows: list[np.ndarray], positive: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Per feature: log of (count in class 1 / all of class 1) / (count in class 0 / all of class 0), counts smoothed."""
    count = [np.full(SIZE, smooth), np.full(SIZE, smooth)]
    for r, p in zip(rows, positive.tolist(), strict=True):
        count[int(p)][r] += 1
    p, q = count[1] / count[1].sum(), count[0] / count[0].sum()
    return np.log(p / q)


def logistic_curve(margins: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the log-odds of class 1 on the margin, by Newton steps with smoothed targets."""
    n1, n0 = positive.sum(), (~positive).sum()
    target = np.where(positive, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, float(np.log((n1 + 1) / (n0 + 1)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        ga, gb = float(((p - target) * margins).sum()) + 1e-6 * a, float((p - target).sum())
        haa, hab, hbb = float((w * margins * margins).sum()) + 1e-6, float((w * margins).sum()), float(w.sum())
        det = haa * hbb - hab * hab
        if det <= 1e-12:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a - da, b - db
        if abs(da) + abs(db) < 1e-8:
            break
    return a, b


def fit_rows(rows: list[np.ndarray], positive: np.ndarray, calibrate: np.ndarray, cost: float = 1.0) -> tuple[np.ndarray, float, float]:
    """Log ratios and weights on plain indicators (the ratios multiplied in), slope and intercept. ``calibrate``: rows kept for the curve."""
    share = float(positive.mean()) if len(positive) else 0.5
    if len(positive) == 0 or positive.all() or not positive.any():
        return np.zeros((2, SIZE), np.float32), 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    fit = ~calibrate if 0 < positive[~calibrate].sum() < (~calibrate).sum() and calibrate.any() else np.ones(len(positive), bool)
    curve = calibrate if not fit.all() and 0 < positive[calibrate].sum() < calibrate.sum() else fit
    used = [r for r, f in zip(rows, fit.tolist(), strict=True) if f]
    ratio = log_ratios(used, positive[fit])
    signs = np.where(positive[fit], 1.0, -1.0)
    n1, n0 = (signs > 0).sum(), (signs < 0).sum()
    costs = np.where(signs > 0, cost * len(signs) / (2 * n1), cost * len(signs) / (2 * n0))
    weights = dual_coordinate_descent(used, UnitRows(used, ratio), signs, costs)
    margins = np.array([margin(r, ratio, weights * ratio) for r, c in zip(rows, curve.tolist(), strict=True) if c])
    return np.stack([ratio, weights * ratio]).astype(np.float32), *logistic_curve(margins, positive[curve])


def margin(row: np.ndarray, ratio: np.ndarray, scaled: np.ndarray) -> float:
    """Weights times the unit-length row of scaled indicators."""
    r = ratio[row].astype(np.float64)
    norm = float(np.sqrt(r @ r))
    return float(scaled[row].sum(dtype=np.float64) / norm) if norm else 0.0


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, calibrate, text) to (label, calibrate, places)."""
    features = Features()
    for batch in batches:
        places = [p.tobytes() for p in features(batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(places, pa.binary())], ["label", "calibrate", "places"])


def held_out(key: Column) -> Column:
    """Rows that the fit never sees: CRC-32 of the key's text divisible by 5. A null key is none of them (nor in the fit)."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = MAX_ROWS, max_places: int = MAX_PLACES) -> tuple[bytes, float, float]:
    """Model (weights as bytes, slope, intercept) from labelled rows that are not held out: about ``max_rows``, with at most ``max_places`` features in all."""
    usable = small_batches(labels).select(F.col(key).alias("_key"), F.col(label).cast("int").alias("label")).where("_key is not null and label in (0, 1)").where(~held_out(F.col("_key"))).distinct()
    n = usable.count()
    share = min(1.0, max_rows / n) if n else 1.0
    place = F.pmod(F.xxhash64("_key"), F.lit(1 << 20))
    sample = usable.where(place < int(share * (1 << 20))).withColumn("calibrate", F.pmod(F.xxhash64("_key", F.lit(1)), F.lit(5)) == 0)
    # The sample is bounded by max_rows, so it may be sent to every executor; the documents stay where they are.
    met = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text")).join(F.broadcast(sample), "_key")
    # One text for each key, so that a key of very many rows does not grow the fit.
    once = met.groupBy("_key", "label", "calibrate").agg(F.min("_text").alias("_text"))
    rows = cut(once.select("label", "calibrate", "_text").mapInArrow(_feature_rows, "label int, calibrate boolean, places binary").withColumn("_id", F.monotonically_increasing_id()))
    # In the order of a hash of the features; the sample's rows are few, so one task may add up their sizes.
    sizes = rows.select("_id", F.xxhash64("places").alias("_hash"), "label", F.octet_length("places").cast("long").alias("_bytes"))
    upto = F.sum("_bytes").over(Window.orderBy("_hash", "label", "_id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    bounded = rows.join(F.broadcast(sizes.withColumn("_upto", upto).where(F.col("_upto") <= 4 * max_places).select("_id")), "_id", "left_semi").drop("_id")

    def train(table: pa.Table) -> pa.Table:
        # The rows stay where Arrow has them; their order is that of a digest, so that it is the same in every run.
        places, labels = table.column("places").combine_chunks(), table.column("label").to_numpy()
        ends, raw = np.frombuffer(places.buffers()[1], np.int32)[places.offset : places.offset + len(places) + 1] // 4, places.buffers()[2]
        every = np.frombuffer(raw, np.int32) if raw is not None and len(raw) else np.zeros(0, np.int32)
        rows = [every[a:b] for a, b in pairwise(ends.tolist())]
        order = sorted(range(len(rows)), key=lambda k: (blake2b(rows[k], digest_size=16).digest(), labels[k]))
        weights, slope, intercept = fit_rows([rows[k] for k in order], labels[order] == 1, table.column("calibrate").to_numpy()[order].astype(bool))
        return pa.table({"weights": pa.array([weights.tobytes()], pa.binary()), "slope": pa.array([float(slope)]), "intercept": pa.array([float(intercept)])})

    found = bounded.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(train, "weights binary, slope double, intercept double").collect()
    if not found:
        return np.zeros((2, SIZE), np.float32).tobytes(), 0.0, 0.0
    return bytes(found[0]["weights"]), found[0]["slope"], found[0]["intercept"]


def scorer(model) -> object:
    """Function from a text column to scores, for one task; ``model``: the broadcast of what ``fit`` returns."""
    weights, slope, intercept = model.value
    ratio, scaled = np.frombuffer(weights, np.float32).reshape(2, SIZE)
    features = Features()

    def score(column: pa.Array) -> np.ndarray:
        margins = [margin(f, ratio, scaled) for f in features(column)]
        return 1 / (1 + np.exp(-np.clip(slope * np.array(margins, np.float64) + intercept, -700, 700)))

    return score


def _score_column(model):
    """A column function from texts to scores; batches cross as Arrow arrays, and only the texts do."""

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = scorer(model)
        for texts in batches:
            yield pa.array(own(texts), pa.float64())

    return scores


def score(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = THRESHOLD, max_rows: int = MAX_ROWS) -> DataFrame:
    """Per row: key, held_out, score, predicted (1 if score >= threshold)."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, key=key, text=text, label=label, max_rows=max_rows))
    scored = docs.select(F.col(key).alias("_key"), _score_column(model)(F.col(text).cast("string")).alias("score"))
    return scored.select(F.col("_key").alias(key), held_out(F.col("_key")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = THRESHOLD, max_rows: int = MAX_ROWS) -> DataFrame:
    """The documents that score ``threshold`` or more, in their own columns. Only texts go to Python, and only scores come back."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, key=key, text=text, label=label, max_rows=max_rows))
    return docs.where(_score_column(model)(F.col(text).cast("string")) >= threshold)
