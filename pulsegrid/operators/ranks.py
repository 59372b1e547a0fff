"""Exact order statistics of many columns at once without moving their values.

``select_ranks`` finds the values that stand at given ranks (0 = smallest) of
given columns by radix selection. A range of values known to hold a wanted rank
is cut into ``BUCKETS`` digits by a function that never decreases with the
value; one pass over the rows counts the digits (with the smallest and largest
value of each), and the digit that holds the rank is the next, narrower range.
A range whose smallest and largest value agree is the answer. All columns and
ranks advance in the same pass, and what is shuffled is digit counts: at most
BUCKETS rows for each range and map task, however many rows a column has.

A range within a factor of two on one side of zero is cut evenly; any other by
the logarithm of the magnitude, which brings every range within that factor in
one pass whatever the column's scale. Evenly cut, a range loses 16 of the 53
bits of a double's fraction in each pass, so five passes settle any column and
two or three usual ones. Ranges end at values that occur, which only helps.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKETS = 1 << 16
_SHIFT, _TOP = 1075.0, 2200.0  # log2 of the least double is -1074, that of the largest is below 1024


@dataclass(frozen=True)
class Range:
    """Values of a column from ``lo`` to ``hi``; ``before`` rows are smaller."""
    column: str
    lo: float
    hi: float
    before: int
    ranks: tuple[int, ...]


def _value(column: str) -> Column:
    return F.col(f"`{column}`").cast("double")


def _even(r: Range) -> bool:
    a, b = sorted((abs(r.lo), abs(r.hi)))
    return r.lo * r.hi > 0 and b <= 2 * a


def _signed_log(v: Column) -> Column:
    return F.when(v == 0, 0.0).when(v > 0, F.least(F.log2(v), F.lit(_TOP)) + _SHIFT).otherwise(-(F.least(F.log2(-v), F.lit(_TOP)) + _SHIFT))


def _signed_log_of(x: float) -> float:
    if x == 0:
        return 0.0
    return math.copysign(min(math.log2(abs(x)), _TOP) + _SHIFT, x)


def digit(r: Range, v: Column) -> Column:
    """Bucket of a value of the range: never decreases with the value, 0 for
    the smallest and BUCKETS - 1 for the largest."""
    if _even(r):
        part = (v - F.lit(r.lo)) / F.lit(r.hi - r.lo)
    else:
        lo, hi = _signed_log_of(r.lo), _signed_log_of(r.hi)
        part = (_signed_log(v) - F.lit(lo)) / F.lit(hi - lo)
    # both ends are kept inside whatever the last place of a logarithm
    return F.least(F.greatest(F.floor(part * BUCKETS), F.lit(0)), F.lit(BUCKETS - 1)).cast("int")


def digit_counts(df: DataFrame, ranges: Sequence[Range]) -> DataFrame:
    """(range, digit, n, lo, hi) of the rows in each range: the only thing that
    is shuffled, after partial aggregation."""
    found = []
    for i, r in enumerate(ranges):
        v = _value(r.column)
        found.append(F.when((v >= F.lit(r.lo)) & (v <= F.lit(r.hi)) & ~F.isnan(v),
                            F.struct(F.lit(i).alias("range"), digit(r, v).alias("digit"), v.alias("v"))))
    rows = df.select(F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("x")).select("x.*")
    return rows.groupBy("range", "digit").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))


def _narrowed(df: DataFrame, ranges: Sequence[Range]) -> list[Range]:
    """The digits that hold the ranges' ranks, by one pass over the rows."""
    upto = W.partitionBy("range").orderBy("digit").rowsBetween(W.unboundedPreceding, 0)
    counts = digit_counts(df, ranges).withColumn("end", F.sum("n").over(upto))
    wanted = F.element_at(F.array(*[F.array(*[F.lit(k - r.before) for k in r.ranks]) for r in ranges]), F.col("range") + 1)
    holds = F.filter(wanted, lambda k: (k >= F.col("end") - F.col("n")) & (k < F.col("end")))
    out = []
    for x in counts.select("*", holds.alias("held")).where(F.size("held") > 0).collect():  # at most one row a rank
        r = ranges[x["range"]]
        out.append(Range(r.column, x["lo"], x["hi"], r.before + x["end"] - x["n"], tuple(r.before + k for k in x["held"])))
    return out


def select_ranks(df: DataFrame, bounds: Mapping[str, tuple[float, float]], ranks: Mapping[str, Sequence[int]]) -> dict[tuple[str, int], float]:
    """{(column, rank): value} for ranks among the values that are neither null
    nor NaN; ``bounds`` are each column's smallest and largest such value."""
    todo = [Range(c, *bounds[c], 0, tuple(sorted(set(ks)))) for c, ks in ranks.items() if ks]
    found: dict[tuple[str, int], float] = {}
    while True:
        found |= {(r.column, k): r.lo for r in todo if r.lo == r.hi for k in r.ranks}
        todo = [r for r in todo if r.lo != r.hi]
        if not todo:
            return found
        todo = _narrowed(df, todo)


def column_figures(df: DataFrame, cols: Sequence[str]) -> dict[str, dict]:
    """count, nan (how many of them), mean, std (sample) and the range of the
    values that are no NaN, per column, in one pass."""
    aggs = []
    for i, c in enumerate(cols):
        v = _value(c)
        real = F.when(~F.isnan(v), v)
        aggs += [F.count(v).alias(f"count{i}"), F.count_if(F.isnan(v)).alias(f"nan{i}"), F.avg(v).alias(f"mean{i}"),
                 F.stddev_samp(v).alias(f"std{i}"), F.min(real).alias(f"lo{i}"), F.max(real).alias(f"hi{i}")]
    row = df.agg(*aggs).first()
    return {c: {k: row[f"{k}{i}"] for k in ("count", "nan", "mean", "std", "lo", "hi")} for i, c in enumerate(cols)}


def quantile_values(df: DataFrame, figures: Mapping[str, dict], ps: Sequence[float]) -> dict[str, list[float]]:
    """Quantiles ``ps`` with linear interpolation of the columns that have
    values; NaN counts as the largest value."""
    places = {c: [p * (f["count"] - 1) for p in ps] for c, f in figures.items() if f["count"]}
    ends = {c: {k for x in at for k in (math.floor(x), math.ceil(x))} for c, at in places.items()}
    real = {c: figures[c]["count"] - figures[c]["nan"] for c in places}
    found = select_ranks(df, {c: (figures[c]["lo"], figures[c]["hi"]) for c in places}, {c: [k for k in ks if k < real[c]] for c, ks in ends.items()})

    def between(c: str, x: float) -> float:
        low, high = (found.get((c, k), math.nan) for k in (math.floor(x), math.ceil(x)))
        return low if low == high else (math.ceil(x) - x) * low + (x - math.floor(x)) * high

    return {c: [between(c, x) for x in at] for c, at in places.items()}
