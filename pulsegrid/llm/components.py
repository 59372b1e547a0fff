"""Connected components by alternating large-star and small-star steps.

DataFrame operations only. Each round is a few equi-joins and minima, with
map-side partial aggregation; a node with very many neighbours is spread by
Spark's skew-join splitting. Every round is checkpointed to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulsegrid.llm.common import kept, split_join


def _large_star(e: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the node's smallest neighbour."""
    n = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    m = n.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("mu"), F.least("u", "m").alias("m"))
    return (split_join(n.where("v > u"), m, "u", "mu")
            .select(F.col("v").alias("a"), F.col("m").alias("b")))


def _small_star(e: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    n = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    m = n.groupBy("u").agg(F.min("v").alias("m"))
    linked = split_join(n, m.withColumnRenamed("u", "mu"), "u", "mu")
    return (linked.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
            .unionAll(m.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge, its component's smallest node as
    the root (root included). Null ends, loops and repeated edges are ignored;
    no edges give an empty result."""
    e = kept(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b").distinct())
    state = _state(e)
    for _ in range(max_rounds):
        if not state[0]:
            break
        e = kept(_small_star(_large_star(e)))
        before, state = state, _state(e)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
