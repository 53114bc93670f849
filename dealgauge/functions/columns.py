"""Column expressions used by several operators. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_size(raw: Column) -> Column:
    """First run of digits as an integer: '163 emp' -> 163, '23.0' -> 23, 'n/a' -> null."""
    return F.regexp_extract(raw, r"(\d+)", 1).try_cast("int")


def blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def nullable_div(num: Column, den: Column) -> Column:
    """num / den as a double, null when den is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def share(condition: Column) -> Column:
    """Part of the rows for which the condition holds; null conditions count as false."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def right_closed_bins(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (edges[i], edges[i+1]] that holds the value, else null."""
    out = F.when(value <= edges[0], None)
    for upper, label in zip(edges[1:], labels):
        out = out.when(value <= upper, label)
    return out


def bin_index(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Number (from 0) of the equal-width bin between low and high; the last bin is closed."""
    width = high - low
    position = F.when(width > 0, F.floor((value - low) / width * F.lit(bins))).otherwise(0)
    return F.least(position, F.lit(bins - 1)).cast("int")
