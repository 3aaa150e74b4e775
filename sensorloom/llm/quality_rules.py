"""Quality rules: fixed base rules, then robust multivariate outliers per language and source.

Five statistics of each document are transformed to a vector.  For every (lang, source) group the
minimum-covariance-determinant estimate is approached by concentration steps: take the share of the
group that lies nearest to the present centre, take its mean and covariance, measure all again.  There are three
starts: the coordinate-wise medians with the counting noise of the group as scales, the same with the median
deviations where these are larger, and the mean and covariance of the whole group.  Of the three results that with
the least determinant is taken.

Counting noise is how far a statistic of a document of the group's usual length moves by chance, as by one symbol
or one repeated line.  Its square is added to the diagonal in each step, so that a statistic that is constant in a
group neither breaks the inverse nor makes small differences count.  A document is rejected when its squared
Mahalanobis distance, brought to the size of a chi-square variable by its median, is over the cutoff.

Quantiles are read from counts over a fixed fine grid, which is exact to the grid's step, adds up over
tasks in any order and gives the same result in every run.

Defined results: a null or empty text has no words, fails the base rules and takes no part in the
estimates; null languages and sources form groups of their own; a group too small for an estimate has
its counting noise as its covariance; rows that repeat a doc_id are judged one by one; no documents give
no rows; null doc_ids are kept.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.llm.common import SPACES, stored, text_of, without, words

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Share of a group that the estimate rests on, half of it so that copies of one junk text cannot enter unless
#: they are as many as all others; concentration steps; chi-square quantiles for five
#: statistics: the median, and 0.9999.
CORE, STEPS, MEDIAN, CUTOFF = 0.5, 3, 4.3515, 25.745
#: The statistics of the vector, and how many times its counting noise a statistic is allowed (tuned on labelled
#: rows of the check tables; the tests judge other ones).
NAMES, NOISE = ("log_length", "symbol_rate", "upper_share", "line_share", "repeat_share"), 1.5
#: A normal deviation over the median one; starts.
DEVIATION, TURNS = 1.4826, 3

#: Estimates of so many groups, of about 200 bytes each, are broadcast; more are joined by shuffles.
MAX_BROADCAST_GROUPS = 10_000

_GROUP = ["lang", "source"]
_TURN = [*_GROUP, "turn"]
_GRID, _FARTHEST = 256, 1 << 16


def _covered(positions: str, width: int = 3) -> Column:
    """Length of the union of intervals of this width that start at the sorted positions."""
    steps = F.transform(positions, lambda at, i: F.coalesce(
        F.least(F.lit(width), F.get(positions, i + 1) - at), F.lit(width)))
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def statistics(documents: DataFrame, *keep: str) -> DataFrame:
    """The counted statistics of each whole text, with the columns to keep."""
    text = F.col("_text")
    worded = documents.select(*keep, text_of().alias("_text")).select(
        *keep, "_text", words(text).alias("_words"),
        F.filter(F.split(text, "\n", -1), lambda line: without(line, SPACES) != "").alias("_lines"))
    counted = worded.select(
        *keep, "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.length(without(text, SPACES)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.length(text) - F.length(without(text, UPPER))).cast("long").alias("n_upper"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"))
    counts = ["n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines"]
    hashed = counted.select(*keep, *counts, F.slice(
        F.transform("_words", lambda word, i: F.xxhash64(word, F.get("_words", i + 1), F.get("_words", i + 2))),
        F.lit(1), F.greatest(F.lit(0), F.size("_words") - 2)).alias("_windows"))
    # Only texts with a repeated window sort their windows.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = hashed.select(*keep, *counts, F.when(repeats, F.sort_array(
        F.transform("_windows", lambda value, i: F.struct(value.alias("v"), i.alias("i"))))).alias("_ordered"))
    twice = F.transform("_ordered", lambda item, i: F.when(
        F.coalesce(F.get("_ordered", i - 1)["v"] == item["v"], F.lit(False))
        | F.coalesce(F.get("_ordered", i + 1)["v"] == item["v"], F.lit(False)), item["i"]))
    placed = ordered.select(*keep, *counts, F.sort_array(F.filter(twice, lambda at: at.isNotNull())).alias("_at"))
    return placed.select(*keep, *counts, F.coalesce(_covered("_at"), F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def vectors(counted: DataFrame) -> DataFrame:
    """Adds the transformed statistics; documents that fail the base rules may hold nulls."""
    share = lambda part, whole: F.sqrt(F.try_divide(F.col(part), F.col(whole)))
    return counted.withColumns({
        "log_length": F.log(F.try_divide(F.col("word_chars"), F.col("n_words"))),
        "symbol_rate": share("n_symbols", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words")})


def _cell(value: Column) -> Column:
    return F.least(F.floor(value * _GRID), F.lit(_FARTHEST))


def _quantile(df: DataFrame, keys: list[str], value: Column, share: float) -> DataFrame:
    """Upper end of the grid cell that holds the quantile, as column ``quantile``."""
    counts = df.groupBy(*keys, _cell(value).alias("cell")).count()
    whole = Window.partitionBy(*keys)
    running = F.sum("count").over(whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = counts.withColumns({"so_far": running, "all": F.sum("count").over(whole)})
    return marked.filter(F.col("so_far") >= share * F.col("all")).groupBy(*keys).agg(
        ((F.min("cell") + 1) / _GRID).alias("quantile"))


def _per_group(df: DataFrame, estimates: DataFrame, few: bool, keys: list[str] = _GROUP) -> DataFrame:
    """Rows with what is known of their group; few groups are broadcast, others joined by shuffles."""
    estimates = F.broadcast(estimates) if few else estimates
    same = [F.col(f"d.{name}").eqNullSafe(F.col(f"e.{name}")) for name in keys]
    return df.alias("d").join(estimates.alias("e"), same, "left").drop(*[F.col(f"e.{name}") for name in keys])


def noise() -> dict[str, Column]:
    """How far each statistic of a document moves by chance: that of word lengths, one symbol, capital or line, one window."""
    return {
        "log_length": F.lit(0.5) / F.sqrt("n_words"), "symbol_rate": F.lit(1.0) / F.sqrt("n_words"),
        "upper_share": F.lit(1.0) / F.sqrt("word_chars"), "line_share": F.lit(1.0) / F.sqrt(F.greatest(F.lit(1), "n_lines")),
        "repeat_share": F.sqrt(F.lit(3.0) / F.col("n_words"))}


def _medians(df: DataFrame, values: dict[str, Column], prefix: str, fine: int = 1) -> DataFrame:
    """Per group the medians of some values, on a grid that is finer by a factor."""
    unpivoted = df.select(*_GROUP, F.explode(F.map_from_arrays(
        F.array(*map(F.lit, values)), F.array(*[value * fine for value in values.values()]))).alias("name", "value"))
    medians = _quantile(unpivoted, [*_GROUP, "name"], F.col("value"), 0.5)
    return medians.groupBy(*_GROUP).agg(*[
        F.max(F.when(F.col("name") == name, F.col("quantile") / fine)).alias(f"{prefix}_{name}") for name in values])


def _pairs():
    return combinations_with_replacement(NAMES, 2)


def _moments(core: DataFrame, keys: list[str]) -> DataFrame:
    """Per group: mean and covariance of the core."""
    return core.groupBy(*keys).agg(
        *[F.avg(name).alias(f"m_{name}") for name in NAMES], *[F.covar_pop(a, b).alias(f"c_{a}_{b}") for a, b in _pairs()])


def _with_noise(moments: DataFrame, scales: DataFrame, few: bool, keys: list[str]) -> DataFrame:
    """Moments with the squared counting noise of the group on the diagonal."""
    ridged = _per_group(moments, scales, few)
    return ridged.select(*keys, *[f"m_{name}" for name in NAMES], *[
        (F.col(f"c_{a}_{b}") + (F.col(f"s_{a}") ** 2 if a == b else 0.0)).alias(f"c_{a}_{b}") for a, b in _pairs()])


def _starts(fitting: DataFrame, scales: DataFrame, few: bool) -> DataFrame:
    """Per group and turn: centre and covariance to start from."""
    medians = stored(_medians(fitting, {name: F.col(name) for name in NAMES}, "m"), "mcd")
    apart = {name: F.abs(F.col(name) - F.col(f"m_{name}")) for name in NAMES}
    deviations = _medians(_per_group(fitting, medians, few), apart, "d", 16)
    centred = _per_group(_per_group(medians, scales, few), deviations, few)

    def diagonal(turn: int, deviation) -> DataFrame:
        return centred.select(*_GROUP, F.lit(turn).alias("turn"), *[f"m_{name}" for name in NAMES], *[
            (deviation(a) ** 2 if a == b else F.lit(0.0)).alias(f"c_{a}_{b}") for a, b in _pairs()])

    everything = _moments(fitting, _GROUP).withColumn("turn", F.lit(2))
    return diagonal(0, lambda name: F.col(f"s_{name}")).unionByName(
        diagonal(1, lambda name: F.greatest(F.col(f"s_{name}"), DEVIATION * F.col(f"d_{name}")))).unionByName(
        _with_noise(everything, scales, few, _TURN))


def _whitening(moments: DataFrame) -> DataFrame:
    """Per group and turn: the mean, the inverse ``w`` of the Cholesky factor ``l`` of the covariance, and the logarithm
    of the determinant."""
    names, width = list(NAMES), len(NAMES)
    df = moments

    def dot(left, right, places) -> Column:
        return sum((F.col(left(k)) * F.col(right(k)) for k in places), F.lit(0.0))

    for j, b in enumerate(names):
        inner = dot(lambda k: f"l_{j}_{k}", lambda k: f"l_{j}_{k}", range(j))
        df = df.withColumn(f"l_{j}_{j}", F.sqrt(F.col(f"c_{b}_{b}") - inner))
        below = {
            f"l_{i}_{j}": (F.col(f"c_{b}_{names[i]}") - dot(
                lambda k, i=i: f"l_{i}_{k}", lambda k: f"l_{j}_{k}", range(j))) / F.col(f"l_{j}_{j}")
            for i in range(j + 1, width)}
        df = df.withColumns(below) if below else df
    for gap in range(width):
        df = df.withColumns({
            f"w_{j + gap}_{j}": (F.lit(1.0) if gap == 0 else -dot(
                lambda k, i=j + gap: f"l_{i}_{k}", lambda k, j=j: f"w_{k}_{j}", range(j, j + gap)))
            / F.col(f"l_{j + gap}_{j + gap}")
            for j in range(width - gap)})
    determinant = sum((2 * F.log(F.col(f"l_{j}_{j}")) for j in range(width)), F.lit(0.0))
    return df.select(
        *_TURN, *[f"m_{name}" for name in names], *[f"w_{i}_{j}" for i in range(width) for j in range(i + 1)],
        determinant.alias("log_determinant"))


def _distance() -> Column:
    """The squared Mahalanobis distance of a row that has its group's estimates."""
    names = list(NAMES)
    whitened = [
        sum((F.col(f"w_{i}_{j}") * (F.col(names[j]) - F.col(f"m_{names[j]}")) for j in range(i + 1)), F.lit(0.0))
        for i in range(len(names))]
    return sum((value * value for value in whitened), F.lit(0.0))


def outliers(measured: DataFrame, cutoff: float = CUTOFF, core: float = CORE, steps: int = STEPS) -> DataFrame:
    """Adds ``distance`` and ``outlier``, false where the base rules fail.  Reads ``measured`` several times."""
    columns = measured.columns
    fitting = measured.filter(~base_failed())
    scales = stored(_medians(fitting, {name: NOISE * value for name, value in noise().items()}, "s", 16), "mcd")
    few = scales.count() * TURNS <= MAX_BROADCAST_GROUPS
    fitting = fitting.select(*_GROUP, *NAMES)
    estimates = stored(_whitening(_starts(fitting, scales, few)), "mcd")
    turned = fitting.withColumn("turn", F.explode(F.array(*map(F.lit, range(TURNS)))))
    # sqrt(distance) is what the grid is laid over: near points are told apart better.
    away = F.sqrt(_distance())
    for _ in range(steps):
        distances = _per_group(turned, estimates, few, _TURN).select(*_TURN, *NAMES, away.alias("away"))
        edge = stored(_quantile(distances, _TURN, F.col("away"), core), "mcd")
        nearest = _per_group(distances, edge, few, _TURN).filter(F.col("away") < F.col("quantile"))
        estimates = stored(_whitening(_with_noise(_moments(nearest, _TURN), scales, few, _TURN)), "mcd")
    least = F.row_number().over(Window.partitionBy(*_GROUP).orderBy("log_determinant", "turn"))
    estimates = stored(estimates.withColumn("least", least).filter("least = 1").drop("least", "turn", "log_determinant"), "mcd")
    distances = _per_group(fitting, estimates, few).select(*_GROUP, away.alias("away"))
    typical = stored(_quantile(distances, _GROUP, F.col("away"), 0.5).withColumn(
        "stretch", F.greatest(F.lit(1.0), F.col("quantile") ** 2 / MEDIAN)).drop("quantile"), "mcd")
    judged = _per_group(_per_group(measured, estimates, few), typical, few)
    distance = F.when(~base_failed(), _distance() / F.col("stretch"))
    return judged.select(*columns, distance.alias("distance"), F.coalesce(distance > cutoff, F.lit(False)).alias("outlier"))


def judge(documents: DataFrame, *keep: str) -> DataFrame:
    """The statistics and the verdict of each row, with the columns to keep (not lang and source)."""
    measured = stored(vectors(statistics(documents, *keep, *_GROUP)), "statistics")
    failed = base_failed()
    return outliers(measured).withColumns({"base_failed": failed, "kept": ~failed & ~F.col("outlier")})
