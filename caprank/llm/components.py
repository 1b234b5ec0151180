"""Connected components by alternating large-star and small-star steps.

Every step is a combining aggregate and a join on narrow (long, long) rows; the
edges of a round are written to the shared folder, so no lineage grows and no
link reaches the driver.  Rounds end as soon as all components are stars.  A hub is reduced by the aggregate's map side.

What the driver holds for a round is its plan, so both rows that a step makes of
an edge come from one pass (``inline``): a union would repeat all that is below it,
and the second step stands on the first one twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caprank.llm.common import release, written


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("u").alias("c")).agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _each(frame: DataFrame, *pairs: tuple[Column, Column]) -> DataFrame:
    """(u, v): a row of every pair for each row of ``frame``."""
    return frame.select(F.inline(F.array(*[F.struct(u.alias("u"), v.alias("v")) for u, v in pairs])))


def _large_star(edges: DataFrame) -> DataFrame:
    both = _each(edges, (F.col("u"), F.col("v")), (F.col("v"), F.col("u")))
    return (both.join(_smallest(both), F.col("u") == F.col("c")).where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = down.join(_smallest(down), F.col("u") == F.col("c"))
    return _each(joined, (F.col("v"), F.col("m")), (F.col("u"), F.col("m"))).where("u <> v").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every edge (u > v, no edge twice) is the only one of its u, and no v is
    a u: then each v is the smallest node of its component."""
    ends = edges.select(F.inline(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")),
                                         F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n")).where("up > 1 or (up > 0 and up < n)").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has
    a link to another one.  Null ends and self links are ignored."""
    u, v = F.col(a).cast("long"), F.col(b).cast("long")
    edges = links.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()
    edges = written(edges, "links")
    while not _stars(edges):
        edges = written(_small_star(_large_star(edges)), "star")
    release(edges.sparkSession)  # the rounds' plans, before the driver's heap grows for them
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
