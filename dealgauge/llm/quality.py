"""Quality rules: simple base rules, then robust multivariate outliers per language and source.

Base statistics come from whole texts. The outlier rule estimates a minimum covariance determinant per
(lang, source): from the median and absolute deviations, the half of the documents with the smallest
distances gives mean and covariance, which give new distances, and so on (`STEPS` concentration steps).
Documents whose squared Mahalanobis distance of transformed statistics is above the chi-square cut are
rejected. Every step is one aggregate over all rows; only estimates (one row per group) are joined back.

A covariance gets `RIDGE` added on its diagonal, so that statistics that are constant in a group do not
break its inverse. Sources with fewer than `SMALL_GROUP` clean rows in a language share one estimate of that language. Documents that
fail a base rule take no part in the estimates and are not kept. Null text has no words; null lang or source is
a group of its own; repeated rows count as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from dealgauge.llm.mixing import words
from dealgauge.llm.scratch import Scratch

#: Transformed statistics: log length, mean word length, symbol rate, repeated share.
FEATURES = ("f_length", "f_word", "f_symbols", "f_repeat")
STEPS = 3
#: Deviations that clean texts may show in any group, even where the half sample shows none.
RIDGE = (1.0, 0.1, 0.5, 0.04)
SMALL_GROUP = 60
#: 1 - 1e-5 quantile of chi-square with four degrees of freedom, on the consistent scale of the half sample.
CUT = 28.47
#: Median of chi-square with four degrees of freedom.
HALF = 3.357
WINDOW = 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def repeated_words(hashes: Column) -> Column:
    """Words covered by windows of eight word hashes that occur twice or more in the array."""
    n = F.size(hashes) - (WINDOW - 1)
    windows = F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))
    # most texts repeat no window: only the others are sorted
    some = let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_covered(_repeats(w))))
    return F.when(n >= 2, some).otherwise(0).cast("long")


def _repeats(windows: Column) -> Column:
    """Positions of windows whose hash is that of a neighbour in the sorted array, in order."""
    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def equal_neighbours(o: Column) -> Column:
        following = F.slice(o, 2, F.size(o))
        pairs = F.filter(F.arrays_zip(o.alias("a"), following.alias("b")), lambda x: x["a"]["h"] == x["b"]["h"])
        return F.array_union(F.transform(pairs, lambda x: x["a"]["i"]), F.transform(pairs, lambda x: x["b"]["i"]))

    return F.array_sort(let(ordered, equal_neighbours))


def _covered(at: Column) -> Column:
    start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(at, start, lambda acc, i: F.struct(
        (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")), lambda acc: acc["n"])


def base_statistics(documents: DataFrame) -> DataFrame:
    """doc_id, lang, source and the base statistics of whole texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = let(
        F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != ""),
        lambda x: F.size(x) - F.size(F.array_distinct(x)))
    counted = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        let(F.transform(w, lambda x: F.xxhash64(x)), repeated_words).alias("n_repeat_words")))
    return (
        documents.select(
            "doc_id", "lang", "source", counted.alias("counted"),
            F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            lines.cast("long").alias("n_dup_lines"))
        .select("doc_id", "lang", "source", "counted.n_words", "word_chars", "n_symbols", "n_dup_lines", "counted.n_repeat_words")
        .withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))))


def _features(rows: DataFrame) -> DataFrame:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return rows.withColumns({
        "f_length": F.log1p(F.col("n_words").cast("double")),
        "f_word": F.log1p(F.col("word_chars") / n),
        "f_symbols": F.log1p(100.0 * F.col("n_symbols") / n),
        "f_repeat": F.log1p((F.col("n_repeat_words") + F.col("n_dup_lines")) / n),
    })


def _distance(mean: list[Column], cov: list[list[Column]]) -> Column:
    """Squared Mahalanobis distance by an unrolled Cholesky factor."""
    p = len(mean)
    low: list[list[Column]] = [[None] * p for _ in range(p)]
    solved: list[Column] = []
    for i in range(p):
        for j in range(i + 1):
            inner = reduce(lambda a, k: a - low[i][k] * low[j][k], range(j), cov[i][j])
            low[i][j] = F.sqrt(F.greatest(inner, F.lit(1e-12))) if i == j else inner / low[j][j]
        gap = F.col(FEATURES[i]) - mean[i]
        solved.append(reduce(lambda a, k: a - low[i][k] * solved[k], range(i), gap) / low[i][i])
    return reduce(lambda a, b: a + b, [x * x for x in solved])


def _same(lang: str, group: str) -> Column:
    return F.col("lang").eqNullSafe(F.col(lang)) & F.col("group").eqNullSafe(F.col(group))


def _grouped(rows: DataFrame) -> DataFrame:
    """`rows` with the group whose estimate they use: their source, or all small sources of the language."""
    sizes = rows.groupBy(F.col("lang").alias("n_lang"), F.col("source").alias("n_source")).agg(
        F.count_if(~F.col("base_failed")).alias("n_clean"))
    same = F.col("lang").eqNullSafe(F.col("n_lang")) & F.col("source").eqNullSafe(F.col("n_source"))
    small = F.col("n_clean") < SMALL_GROUP
    group = F.struct(small.alias("small"), F.when(~small, F.col("source")).alias("source"))
    return rows.join(sizes, same).withColumn("group", group).drop("n_lang", "n_source", "n_clean")


def _estimates(rows: DataFrame) -> DataFrame:
    """Mean and ridged covariance of each group, one row per group."""
    p = range(len(FEATURES))
    sums = [F.avg(f).alias(f"m{i}") for i, f in enumerate(FEATURES)]
    sums += [F.covar_pop(FEATURES[i], FEATURES[j]).alias(f"c{i}{j}") for i in p for j in range(i + 1)]
    found = rows.groupBy(F.col("lang").alias("g_lang"), F.col("group").alias("g_group")).agg(F.count("*").alias("g_n"), *sums)
    return found.withColumns({f"c{i}{i}": F.col(f"c{i}{i}") + RIDGE[i] ** 2 for i in p})


def _of_estimate() -> Column:
    p = range(len(FEATURES))
    return _distance([F.col(f"m{i}") for i in p], [[F.col(f"c{i}{j}") for j in range(i + 1)] for i in p])


def outlier_distances(statistics: DataFrame, scratch: Scratch, steps: int = STEPS) -> DataFrame:
    """`statistics` with `distance`, the squared robust distance on the scale of chi-square."""
    rows = scratch.write(_grouped(_features(statistics)), "features")
    clean = rows.filter(~F.col("base_failed"))
    groups = ("lang", "group")
    start = clean.groupBy(*[F.col(g).alias(f"g_{g}") for g in groups]).agg(
        F.count("*").alias("g_n"), *[F.percentile_approx(f, [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i, f in enumerate(FEATURES)])
    scaled = [((F.col(f) - F.col(f"q{i}")[1]) / ((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349 + RIDGE[i])) for i, f in enumerate(FEATURES)]
    distance = reduce(lambda a, b: a + b, [x * x for x in scaled])
    estimates = scratch.write(start, "start")
    for step in range(steps):
        measured = clean.join(estimates, _same("g_lang", "g_group")).withColumn("d", distance)
        middle = scratch.write(
            measured.groupBy(F.col("lang").alias("h_lang"), F.col("group").alias("h_group"))
            .agg(F.percentile_approx("d", 0.5, 1000).alias("half")), f"half{step}")
        inner = measured.join(middle, _same("h_lang", "h_group")).filter(F.col("d") <= F.col("half"))
        estimates = scratch.write(_estimates(inner.select(*groups, *FEATURES)), f"estimate{step}")
        distance = _of_estimate()
    measured = clean.join(estimates, _same("g_lang", "g_group")).withColumn("d", distance)
    middle = measured.groupBy(F.col("lang").alias("h_lang"), F.col("group").alias("h_group")).agg(
        F.percentile_approx("d", 0.5, 1000).alias("half"))
    scales = scratch.write(
        estimates.join(middle, F.col("g_lang").eqNullSafe(F.col("h_lang")) & F.col("g_group").eqNullSafe(F.col("h_group")))
        .drop("h_lang", "h_group"), "scales")
    # the half sample is too tight by a factor; the median distance is put where chi-square has its median
    factor = HALF / F.greatest(F.col("half"), F.lit(HALF / 4))
    return rows.join(scales, _same("g_lang", "g_group"), "left").withColumn(
        "distance", _of_estimate() * F.least(F.lit(1.0), factor)).select(*statistics.columns, "distance")


def quality_rules(documents: DataFrame, cut: float = CUT) -> DataFrame:
    """doc_id, the base statistics, base_failed, distance and kept for every row of `documents`."""
    scratch = Scratch(documents.sparkSession, "quality")
    statistics = scratch.write(base_statistics(documents), "statistics")
    judged = outlier_distances(statistics, scratch)
    scratch.drop(*[f"{name}{step}" for name in ("half", "estimate") for step in range(STEPS - 1)])
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= cut)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        kept.alias("kept"), "distance")
