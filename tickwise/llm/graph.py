"""Connected components of an undirected link table, wholly in Spark.

Alternating large-star and small-star rounds; each round is written to the shared scratch folder, so lineage
stays short and a lost executor costs one round. Links are never collected; a hub's links are never grouped
into one list, only its smallest neighbour is aggregated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import written


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """pairs: (u, v) with v a neighbour of u. Hooks neighbours to the smallest vertex seen around u."""
    least = pairs.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("low")).select(
        "c", F.least("c", "low").alias("low"))
    hooked = pairs.join(least, pairs["u"] == least["c"])
    if large:
        new = hooked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        new = hooked.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
            least.select(F.col("c").alias("u"), F.col("low").alias("v")))
    return new.where(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """links: (a, b) vertex pairs. Returns (id, component) for every linked vertex; component is its smallest id."""
    edges = written(links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = written(_star(_star(both, True).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")),
                              False), "components")
        new = _state(edges)
        if new == state:
            break
        state = new
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
