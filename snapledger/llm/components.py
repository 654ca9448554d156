"""Connected components of a graph by alternating stars, with no vertex or edge on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import forget, stored


def _moved(edges: DataFrame, least: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((v, m) for each edge (u, v) and the least ``m`` of its ``u``, the written table of least ones).

    The table is written so that the join reads it as it reads the edges; then Spark may split a vertex with very many
    edges over several tasks, which it doesn't where one side comes out of an aggregation.
    """
    least = stored(least, "cc-least")
    return edges.join(least, "u").select("v", "m"), least


def _large(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each vertex links its larger neighbours to the least of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved, least = _moved(both.where("v > u"), both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), least


def _small(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each vertex links its smaller neighbours and itself to the least of them. Edges go from large to small."""
    moved, least = _moved(edges, edges.groupBy("u").agg(F.min("v").alias("m")))
    out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct(), least


def components(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(u, root) for every vertex of ``edges`` (u, v), whole numbers, but the roots, which are the least of their components.

    Every half of a round is written to the shared folder, and what came before it is deleted. Loops and repeated edges
    do no harm. Ends when a round changes nothing; raises if that takes more than ``most_rounds``.
    """
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    before = None
    for _ in range(most_rounds):
        figures = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if figures == before or not figures[0]:
            return now.select("u", F.col("v").alias("root"))
        before = figures
        for half in (_large, _small):
            plan, least = half(now)
            new = stored(plan, "cc")
            forget(now, least)
            now = new
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
