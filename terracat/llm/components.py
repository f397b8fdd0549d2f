"""Connected components of an edge table by alternating large-star and
small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("m", "u").alias("m"))
    return (both.join(low.hint("merge"), F.col("u") == F.col("_u")).where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") != F.col("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    hook = down.join(low.hint("merge"), "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hook.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour that has none itself."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("n"), (F.col("u") > F.col("v")).cast("int").alias("down"),
                                                   (F.col("u") < F.col("v")).cast("int").alias("up")),
                                          F.struct(F.col("v").alias("n"), (F.col("v") > F.col("u")).cast("int").alias("down"),
                                                   (F.col("v") < F.col("u")).cast("int").alias("up")))).alias("e")).select("e.*")
    per = ends.groupBy("n").agg(F.sum("down").alias("down"), F.sum("up").alias("up"))
    return not per.where("down > 1 or (down = 1 and up > 0)").limit(1).count()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge: ``edges`` has columns u and v
    of a type with an order (long, or structs of it); component is the smallest node reachable, itself included.  Rows
    with a null are ignored.  Every round is written to the shared checkpoint
    folder; the rounds end when the edges are stars (about log n rounds).  Joins are by
    merge: no table of nodes passes through the driver."""
    now = materialize(edges.where((F.col("u") != F.col("v"))).select("u", "v").distinct(), "cc")
    while not _stars(now):
        now = materialize(_small_star(_large_star(now)), "cc")
    high, low = F.greatest("u", "v"), F.least("u", "v").alias("component")
    return (now.select(high.alias("node"), low).unionByName(now.select(F.least("u", "v").alias("node"), low).distinct()))
