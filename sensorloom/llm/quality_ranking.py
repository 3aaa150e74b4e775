"""Quality scores by Bradley-Terry ranking of document pairs.

A pair of labelled documents, one good and one bad, says that the good one is preferred.  The model
gives every document the score ``w . x`` of its features, and learns ``w`` by logistic loss on the
feature differences of the pairs.  A score counts as good from the quantile of the training scores
that equals the share of bad labels; scores are mapped to (0, 1) so that this quantile lies at the cut.

Features are shares and sizes of a text, and the shares of its words in ``BUCKETS`` buckets that words are hashed
to, so that the words of good and bad texts are learned.  Language, source and doc_id are no features.

The fit takes every labelled row; of rows that repeat a doc_id the one with the smallest text.  Rows are dealt to groups
by hash, and in a group each row of the commoner label is paired with one of the other label in turn, so that all
rows are in pairs and there are as many pairs as rows of one label.  Sums of slopes and curvatures come from all tasks.

Defined results: a null or empty text has zero features and a score; rows that repeat a doc_id are
scored one by one; without two labels to learn from every score is one half; no documents give no rows;
labelled ids without a document, and null labels, are passed over.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sensorloom.llm.arrow_rows import columns_of, portions
from sensorloom.llm.common import stored

FOLDS, CUT = 5, 0.3
PAIRS, PENALTY = 20_000, 1e-3
#: Rows of a group, and how many of each label it has at least, where needed by rows that are in several groups.
GROUP_ROWS, PARTNERS = 1_000, 50
#: Tasks that send their sums to the driver at once, and half the share of scores that the cut is looked for in.
SUMMING, NEAR_CUT = 64, 1e-3
#: Buckets of words, and the penalty of their weights, which are many.
BUCKETS, WORD_PENALTY = 256, 1e-2

_SYMBOLS = re.compile(r"[#*$%&|<>{}\[\]^~_=+\\@]")
_UPPER = re.compile(r"[A-Z]")
_DIGITS = re.compile(r"[0-9]")
_MARKS = re.compile(r"[!?]")
_STOPS = re.compile(r"[.,;:]")

FEATURES = ("words", "length", "symbols", "upper", "digits", "marks", "stops", "distinct", "commonest", "runs", "lines",
            "repeated_lines", "short_words", "long_words")


WIDTH = len(FEATURES) + BUCKETS
PENALTIES = np.r_[np.full(len(FEATURES), PENALTY), np.full(BUCKETS, WORD_PENALTY)]


def buckets(counted: Counter) -> np.ndarray:
    """Roots of the shares of the words in each bucket, whatever their case."""
    place = np.fromiter((zlib.crc32(word.lower().encode("utf-8", "replace")) % BUCKETS for word in counted), np.int64, len(counted))
    shares = np.bincount(place, np.fromiter(counted.values(), np.float64, len(counted)), BUCKETS)
    return np.sqrt(shares / shares.sum())


def features(text: str | None) -> np.ndarray:
    """Transformed shares and sizes of a whole text, then its words by bucket."""
    words = (text or "").split()
    if not words:
        return np.zeros(WIDTH)
    n, letters = len(words), sum(map(len, words))
    counted = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    same = sum(a == b for a, b in zip(words, words[1:]))
    root = np.sqrt
    return np.concatenate([np.array([
        np.log1p(n), np.log(letters / n), root(len(_SYMBOLS.findall(text)) / letters),
        root(len(_UPPER.findall(text)) / letters), root(len(_DIGITS.findall(text)) / letters),
        root(len(_MARKS.findall(text)) / n), root(len(_STOPS.findall(text)) / n),
        np.log(len(counted)) / np.log(n + 1), root(max(counted.values()) / n), root(same / n),
        np.log1p(n / len(lines)), root(1 - len(set(lines)) / len(lines)),
        root((lengths <= 2).mean()), root((lengths >= 15).mean())]), buckets(counted)])


def remainder(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS


class Ranking:
    """Scores as a function of features."""

    def __init__(self, centre: np.ndarray, scale: np.ndarray, weights: np.ndarray, threshold: float, cut: float):
        self.centre, self.scale, self.weights, self.threshold, self.cut = centre, scale, weights, threshold, cut

    def raw(self, vectors: np.ndarray) -> np.ndarray:
        return ((vectors - self.centre) / self.scale) @ self.weights

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        above = np.clip(self.raw(vectors) - self.threshold, -30, 30)
        return 1 / (1 + np.exp(-above) * (1 - self.cut) / self.cut)


def sums_of(difference: np.ndarray, weights: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of some pairs, and the sums of their slopes and curvatures."""
    chance = 1 / (1 + np.exp(-np.clip(difference @ weights, -30, 30)))
    return len(difference), difference.T @ (1 - chance), (difference * (chance * (1 - chance))[:, None]).T @ difference


def newton(sums: Callable[[np.ndarray], tuple[int, np.ndarray, np.ndarray]], width: int) -> np.ndarray:
    """Weights by Newton steps on the penalised logistic loss of the pairs."""
    penalties = PENALTIES if width == WIDTH else np.full(width, PENALTY)
    weights = np.zeros(width)
    for _ in range(25):
        pairs, slopes, curves = sums(weights)
        step = np.linalg.solve(curves / pairs + np.diag(penalties), slopes / pairs - penalties * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(vectors: np.ndarray, good: np.ndarray, share_bad: float, cut: float = CUT, pairs: int = PAIRS) -> Ranking:
    """Bradley-Terry weights of vectors in memory, from drawn pairs."""
    width = vectors.shape[1]
    if not good.any() or good.all():
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), float(np.log((1 - cut) / cut) * -1), cut)
    centre, scale = vectors.mean(axis=0), vectors.std(axis=0) + 1e-6
    plain = (vectors - centre) / scale
    draw = np.random.default_rng(0)
    better, worse = plain[good], plain[~good]
    difference = better[draw.integers(len(better), size=pairs)] - worse[draw.integers(len(worse), size=pairs)]
    weights = newton(lambda weights: sums_of(difference, weights), width)
    raw = plain @ weights
    # Both labels are sampled to about the same number: weigh each row by the share of its label.
    mass = np.where(good, (1 - share_bad) / good.sum(), share_bad / (~good).sum())
    order = np.argsort(raw)
    place = min(int(np.searchsorted(np.cumsum(mass[order]), share_bad)), len(raw) - 2)
    return Ranking(centre, scale, weights, float((raw[order][place] + raw[order][place + 1]) / 2), cut)


def train(documents: DataFrame, labels: DataFrame, cut: float = CUT) -> Ranking:
    """Ranking learned from all labelled rows outside the held-out fold."""
    usable = labels.filter(F.col("quality").isin(0, 1) & (remainder() != 0)).select("doc_id", "quality")
    counts = {row["quality"]: row["count"] for row in usable.groupBy("quality").count().collect()}
    share_bad = counts.get(0, 0) / max(1, sum(counts.values()))
    labelled = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    measured = documents.select("doc_id", "text").join(labelled, "doc_id").groupBy("doc_id", "quality").agg(
        F.min("text").alias("text"))

    def vectors(batches):
        for batch, texts in portions(batches, "text"):
            found = pa.array([features(text).tobytes() for text in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*columns_of(batch, ["doc_id", "quality"]), found], ["doc_id", "quality", "x"])

    kind = measured.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("quality", T.IntegerType()), T.StructField("x", T.BinaryType())])
    rows = stored(measured.withColumn("quality", F.col("quality").cast("int")).mapInArrow(vectors, schema), "ranking")
    sizes = {row["quality"]: row["count"] for row in rows.groupBy("quality").count().collect()}
    if len(sizes) < 2:
        return fit(np.zeros((1, WIDTH)), np.zeros(1, bool), share_bad, cut)
    n = sum(sizes.values())
    first, second = _summed(rows, _moments)
    centre = first / n
    scale = np.sqrt(np.maximum(second / n - centre ** 2, 0)) + 1e-6
    pairs = stored(_pairs(rows, sizes), "pairs")

    def sums(weights: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        def of(x: np.ndarray) -> list[np.ndarray]:
            count, slopes, curves = sums_of(x / scale, weights)
            return [np.array([count]), slopes, curves]

        count, slopes, curves = _summed(pairs, of)
        return int(count[0]), slopes, curves

    ranking = Ranking(centre, scale, newton(sums, WIDTH), 0.0, cut)
    ranking.threshold = _threshold(rows, ranking, n, share_bad)
    return ranking


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist())).reshape(len(column), WIDTH)


def _moments(x: np.ndarray) -> list[np.ndarray]:
    return [x.sum(axis=0), (x ** 2).sum(axis=0)]


def _summed(rows: DataFrame, of: Callable[[np.ndarray], list[np.ndarray]]) -> list[np.ndarray]:
    """Arrays that are sums over the vectors of all rows; each task sends one set."""
    def added(batches):
        total = None
        for batch in batches:
            if len(batch):
                found = of(_matrix(batch.column(0)))
                total = found if total is None else [a + b for a, b in zip(total, found)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([[np.asarray(one, float).tobytes() for one in total]])], ["sums"])

    sent = rows.select("x").coalesce(SUMMING).mapInArrow(added, "sums array<binary>")
    totals: list[np.ndarray] = []
    for row in sent.collect():
        found = [np.frombuffer(bytes(one)) for one in row["sums"]]
        totals = [a + b for a, b in zip(totals, found)] if totals else found
    return [one.reshape(WIDTH, WIDTH) if len(one) == WIDTH * WIDTH else one for one in totals]


def _pairs(rows: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """Differences of a good and a bad vector.  A label too rare for all groups has its rows in several of them."""
    groups = max(1, sum(sizes.values()) // GROUP_ROWS)
    copies = {label: min(groups, -(-PARTNERS * groups // size)) for label, size in sizes.items()}
    times = F.when(F.col("quality") == 1, copies[1]).otherwise(copies[0])
    spread = F.transform(F.sequence(F.lit(0), times - 1), lambda k: F.pmod(F.xxhash64("doc_id") + F.floor(k * groups / times), F.lit(groups)))
    dealt = rows.withColumn("_group", F.explode(spread))

    def paired(table: pa.Table) -> pa.Table:
        order = sorted(zip(table["quality"].to_pylist(), table["x"].to_pylist()))
        good, bad = ([np.frombuffer(x) for label, x in order if label == wanted] for wanted in (1, 0))
        count = max(len(good), len(bad)) if good and bad else 0
        found = [(good[i % len(good)] - bad[i % len(bad)]).tobytes() for i in range(count)]
        return pa.table({"x": pa.array(found, pa.binary())})

    return dealt.groupBy("_group").applyInArrow(paired, "x binary")


def _threshold(rows: DataFrame, ranking: Ranking, n: int, share_bad: float) -> float:
    """Middle of the two training scores around the share of bad labels, exactly."""
    def scored(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(ranking.raw(_matrix(batch.column(0))))], ["raw"])

    raw = stored(rows.select("x").mapInArrow(scored, "raw double"), "raw")
    place = max(0, min(int(np.ceil(share_bad * n - 1e-9)) - 1, n - 2))
    near = [max(0.0, place / n - NEAR_CUT), min(1.0, (place + 2) / n + NEAR_CUT)]
    low, high = raw.agg(F.percentile_approx("raw", near, 10_000)).first()[0]
    below = raw.filter(F.col("raw") < low).count()
    around = raw.filter(F.col("raw").between(low, high)).groupBy("raw").count().orderBy("raw").collect()
    ends = below + np.cumsum([row["count"] for row in around])
    values = [around[min(int(np.searchsorted(ends, k, "right")), len(around) - 1)]["raw"] for k in (place, place + 1)]
    return (values[0] + values[1]) / 2


def score(documents: DataFrame, ranking: Ranking, text: str = "text", into: str = "score") -> DataFrame:
    """The rows with the score of their text; the text is dropped."""
    kept = [field for field in documents.schema.fields if field.name not in (text, into)]
    schema = T.StructType([*kept, T.StructField(into, T.DoubleType())])

    def scored(batches):
        for batch, texts in portions(batches, "__text"):
            vectors = np.array([features(one) for one in texts]).reshape(len(texts), WIDTH)
            yield pa.RecordBatch.from_arrays(
                [*columns_of(batch, schema.names[:-1]), pa.array(ranking.scores(vectors))], schema.names)

    return documents.select(*[f"`{field.name}`" for field in kept], documents[text].alias("__text")).mapInArrow(
        scored, schema)
