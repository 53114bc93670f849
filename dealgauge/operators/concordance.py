"""Concordance index: how often the lead with the higher score converts first."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealgauge.functions import nullable_div
from dealgauge.operators.ranks import running_total
from dealgauge.sources.stages import measured

_DIGIT_BITS = 4
_BASE = 1 << _DIGIT_BITS


def concordance_pairs(rows: DataFrame, score: str, day: str = "duration_days", event: str = "event_converted") -> DataFrame:
    """Comparable, concordant and tied pairs, without forming any pair.

    A pair is comparable when one lead has an event and the other leaves later, or on the same
    day without an event. Scores are coded by their dense rank, which is exact for any
    distribution. Two different codes differ first in exactly one digit. So rows are counted per (prefix of the code, day, next digit); inside one prefix a
    running sum over later days gives, for every event, the rows with a lower digit that are
    still there. Windows see one row per distinct day, never the leads themselves.
    """
    known = rows.filter(F.col(score).isNotNull())
    scores = measured(known.select(F.col(score).alias("s")).distinct().withColumn("one", F.lit(1).cast("long")))
    count = scores.count()
    digits_used = max(1, -(-max(count - 1, 0).bit_length() // _DIGIT_BITS))
    ranks = running_total(scores, [F.col("s")], "one").select("s", (F.col("running") - 1).alias("code"))
    grouped = known.groupBy(F.col(day).alias("day"), F.col(score).alias("score")).agg(
        F.sum(event).alias("events"), F.count(F.lit(1)).alias("leaving"))
    coded = grouped.join(ranks, F.col("score") == F.col("s")).select("day", "code", "events", "leaving")
    levels = F.explode(F.array(*[
        F.struct(
            F.lit(level).alias("level"),
            F.shiftright("code", _DIGIT_BITS * (digits_used - level)).alias("prefix"),
            (
                F.shiftright("code", _DIGIT_BITS * (digits_used - level - 1)).bitwiseAND(F.lit(_BASE - 1))
                if level < digits_used else F.lit(0).cast("long")
            ).alias("digit"),
        ) for level in range(digits_used + 1)
    ]))
    split = coded.select("day", "events", "leaving", levels.alias("l")).select("day", "events", "leaving", "l.*")
    digits = range(_BASE)
    cells = split.groupBy("level", "prefix", "day").agg(*[
        F.sum(F.when(F.col("digit") == d, F.col(c)).otherwise(0)).alias(f"{c}_{d}")
        for c in ("events", "leaving") for d in digits
    ])
    after = Window.partitionBy("level", "prefix").orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, -1)

    still_there = cells.select("level", *[f"events_{d}" for d in digits], *[
        (F.coalesce(F.sum(f"leaving_{d}").over(after), F.lit(0)) + F.col(f"leaving_{d}") - F.col(f"events_{d}")).alias(f"later_{d}")
        for d in digits
    ])
    # Pair counts grow with the square of the rows: doubles cannot overflow.
    lower, below = F.lit(0.0), F.lit(0)
    for d in range(1, _BASE):
        below = below + F.col(f"later_{d - 1}")
        lower = lower + F.col(f"events_{d}").cast("double") * below
    same = F.col("events_0").cast("double") * F.col("later_0")
    everyone = sum((F.col(f"later_{d}") for d in digits), F.lit(0))
    all_events = sum((F.col(f"events_{d}") for d in digits), F.lit(0))
    return still_there.agg(
        F.sum(F.when(F.col("level") < digits_used, lower).otherwise(0.0)).alias("concordant"),
        F.sum(F.when(F.col("level") == digits_used, same).otherwise(0.0)).alias("tied"),
        F.sum(F.when(F.col("level") == 0, all_events.cast("double") * everyone).otherwise(0.0)).alias("comparable"),
    )


def concordance_index(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn(
        "c_index", nullable_div(F.col("concordant") + F.col("tied") / 2, F.col("comparable")))
