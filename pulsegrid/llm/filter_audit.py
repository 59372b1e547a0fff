"""Filter interaction audit by difference arrays over Lehmer ranks.

Filters are applied in some order and the first that a document fails removes
it. For every order of the filters the audit says what each step removes, what
it finds already gone, and what useful or harmful documents go with it.

A document matters only by the set of filters that it fails, its mask, so
documents are counted by (part, mask) first; that is the only pass over them.
Orders are numbered by their Lehmer rank, in which all orders with a common
beginning are neighbours. A mask is removed at step k by exactly the orders
that begin with k - 1 filters outside the mask and one inside it: for each such
beginning one interval of (n - k)! ranks. The mask's count is added where an
interval starts and taken away where it ends; prefix sums over the n! ranks of
a (part, step) then give what the step removes in every order. The intervals
depend on the number of filters only (31 masks, 120 ranks for five).

``conditions`` holds the five filters of the query: words are maximal
``[^\\x20\\x09-\\x0D]+``, and texts are equal when their SHA-256 is.

Defined cases: a null text is empty (fails A alone, and E if it is not the first
empty text); a null lang is the part ''; a document without a label counts as
neither good nor toxic, one with several is good (toxic) if any says so; rows
that repeat (doc_id, text) are counted each, and none makes the other fail E; a
null doc_id has no smaller id and is no smaller id, so it neither fails E nor
makes others fail; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsegrid.llm.common import kept, scratch, split_join, text_column

FILTERS = "ABCDE"
MAX_FILTERS = 6  # 720 orders
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def removal_intervals(n: int, mask: int) -> list[tuple[int, int, int]]:
    """(step, first rank, end rank) of the orders of n filters that remove a
    mask at that step; steps count from 1, neighbours are joined."""
    out: list[tuple[int, int, int]] = []

    def walk(step: int, rank: int, left: list[int]) -> None:
        width = factorial(len(left) - 1)
        for digit, f in enumerate(left):
            lo = rank + digit * width
            if not mask >> f & 1:
                walk(step + 1, lo, left[:digit] + left[digit + 1:])
            elif out and out[-1][0] == step and out[-1][2] == lo:
                out[-1] = (step, out[-1][1], lo + width)
            else:
                out.append((step, lo, lo + width))

    if mask:
        walk(1, 0, list(range(n)))
    return out


def interval_ends(n: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, rank, +1 or -1) at the ends of every mask's intervals."""
    return [(m, step, rank, sign) for m in range(1, 1 << n) for step, lo, hi in removal_intervals(n, m)
            for rank, sign in ((lo, 1), (hi, -1)) if rank < factorial(n)]


def interactions(masks: DataFrame, filters: Sequence[str] = FILTERS, measures: Sequence[str] = ()) -> DataFrame:
    """The audit of counted masks: columns ``part`` (string, not null), ``mask``
    (int, bit i: fails filter i), ``n`` (documents) and, for each of
    ``measures``, how many of them have it.

    One row per part, order and step: ``part``, ``filter_order``, ``step``,
    ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``<measure>_lost``,
    ``shapley``. Rows of the same part and mask are added up."""
    k = len(filters)
    if not 0 < k <= MAX_FILTERS:
        raise ValueError(f"1 to {MAX_FILTERS} filters, not {k}")
    spark, sums = masks.sparkSession, ["n", *measures]
    counted = masks.groupBy("part", "mask").agg(*[F.sum(c).cast("bigint").alias(c) for c in sums])

    def fails(i: int) -> Column:
        return F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col("n")).otherwise(0))

    parts = counted.groupBy("part").agg(
        F.sum("n").alias("total"), F.array(*[fails(i) for i in range(k)]).alias("fails"),
        F.array(*[F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)) for i in range(k)]).alias("alone"))
    grid = (parts.select("*", F.explode(F.sequence(F.lit(0), F.lit(factorial(k) - 1))).alias("rank"))
            .select("*", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step")))
    orders = spark.createDataFrame([(r, s + 1, "".join(filters[f] for f in p), p[s])
                                    for r, p in enumerate(permutations(range(k))) for s in range(k)],
                                   "rank int, step int, filter_order string, filter int")
    ends = spark.createDataFrame(interval_ends(k), "mask int, step int, rank int, sign int")
    change = counted.join(F.broadcast(ends), "mask").groupBy("part", "step", "rank").agg(
        *[F.sum(F.col(c) * F.col("sign")).alias(f"{c}_change") for c in sums])
    ranks = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    steps = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    gone = (grid.join(change, ["part", "step", "rank"], "left").join(F.broadcast(orders), ["rank", "step"])
            .select("*", *[F.sum(F.coalesce(f"{c}_change", F.lit(0))).over(ranks).alias(f"{c}_gone") for c in sums]))
    return gone.select(
        "part", "filter_order", "step", (F.col("total") - F.sum("n_gone").over(steps)).alias("kept"),
        F.col("n_gone").alias("removed"), (F.col("fails")[F.col("filter")] - F.col("n_gone")).alias("redundant"),
        F.col("alone")[F.col("filter")].alias("unique_fails"),
        *[F.col(f"{c}_gone").alias(f"{c}_lost") for c in measures],
        F.sum("n_gone").over(Window.partitionBy("part", "filter")).alias("shapley"))


def text_conditions(text: Column) -> Column:
    """Bits 0 to 3: the conditions A to D of a text (not null)."""
    words = F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " "), "")
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    n = F.size(words).cast("bigint")
    tests = [n < 100, F.size(F.array_distinct(words)) * F.lit(100).cast("bigint") < n * 80,
             capitals * F.lit(100).cast("bigint") > F.length(text) * F.lit(10).cast("bigint"), text.rlike("[#$%&*|]")]
    bits = [F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests)]
    return (bits[0] + bits[1] + bits[2] + bits[3]).cast("int")


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """The audit of the filters A to E on documents (see the module docstring),
    with ``good_lost`` (quality = 1) and ``toxic_lost`` (toxic = 1).

    The texts are read once; what is shuffled of a document is its id, part,
    mask and digest."""
    with scratch(docs.sparkSession, "filter-audit") as tables:
        x = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                        text_column().alias("t"))
        rows = tables.save(x.select("doc_id", "part", text_conditions(F.col("t")).alias("mask"),
                                    F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("digest")))
        first = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
        # texts of one id only can make nothing fail: they need not meet their rows
        first = first.where("last_id > first_id").select(F.col("digest").alias("d"), "first_id")
        known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("l_id")).agg(
            F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
        copies = split_join(rows, first, "digest", "d", "left")
        copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
        marked = copies.select("doc_id", "part", (F.col("mask") + F.when(copy, 1 << 4).otherwise(0)).alias("mask"))
        # equal ids are counted together before they meet their label
        marked = marked.groupBy("doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
        counted = split_join(marked, known, "doc_id", "l_id", "left").groupBy("part", "mask").agg(
            F.sum("n").alias("n"), *[F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")])
        return interactions(kept(counted), FILTERS, ("good", "toxic"))
