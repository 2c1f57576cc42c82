"""Connected components of a link table, all on executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: each node of ``links`` and the smallest node that it reaches.

    Parents are hooked to the smallest grandparent among a node's neighbours and paths are halved, round by round (the FastSV scheme),
    so rounds grow with the logarithm of the longest path. Every round is a written table; its joins are between written tables, so that
    Spark can split those of a node with very many links, and its minima are pre-aggregated. Links with a null end are ignored, loops and
    repeated links do no harm, and no links give no rows.
    """
    ends = links.select(F.col(a).cast("long").alias("x"), F.col(b).cast("long").alias("y")).where("x is not null and y is not null and x <> y")
    edges = settle(ends.union(ends.select("y", "x")).distinct())
    parents = settle(edges.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.col("node")).alias("f")))
    before = None
    while True:
        now = parents.agg(F.sum(F.col("f").cast("decimal(38,0)"))).first()[0]  # parents only ever fall
        if now == before:
            return parents.select("node", F.col("f").alias("component"))
        before = now
        p, g = parents.alias("p"), parents.alias("g")
        grand = settle(p.join(g, F.col("p.f") == F.col("g.node")).select("p.node", "p.f", F.col("g.f").alias("gf")))
        near = edges.join(grand, edges.y == grand.node).groupBy("x").agg(F.min("gf").alias("m"))
        hooks = near.join(grand, near.x == grand.node).select(F.explode(F.array(F.struct("f", "m"), F.struct(F.col("x").alias("f"), "m"))).alias("h"))
        moves = grand.select("node", "gf").union(hooks.select("h.f", "h.m"))
        parents = settle(moves.groupBy("node").agg(F.min("gf").alias("f")))
