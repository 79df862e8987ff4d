"""Connected components of an edge table, in rounds of large and small stars.

Each round hangs every vertex on the smallest neighbour, first the larger
neighbours, then the smaller; the number of rounds grows with the logarithm of the
longest chain. A round is stored in the shared folder before the next reads it, and
removed when that one is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from featloom.llm.common import let_go, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")).withColumnRenamed("a", "of")
    return both.where("b > a").join(least, F.col("a") == F.col("of")).select(
        F.col("b").alias("a"), F.col("m").alias("b")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges from a vertex (a) to smaller ones (b)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "of")
    linked = edges.join(least, F.col("a") == F.col("of"))
    return (
        linked.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select(F.col("of").alias("a"), F.col("m").alias("b")))
        .distinct()
    )


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """For ``edges`` (a, b) of any ordered type, (vertex, label), label being the
    smallest vertex of the component; labels themselves are not listed."""
    ordered = edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    now = stored(ordered, "component-edges")
    for _ in range(rounds):
        new = stored(_small_star(_large_star(now).where("a != b")), "component-edges")
        # Done when every vertex hangs on one that hangs on none.
        hanging = new.select(F.col("a").alias("of")).distinct()
        more = new.join(hanging, F.col("b") == F.col("of"), "left_semi")
        several = new.groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
        let_go(now)
        now = new
        if more.isEmpty() and several.isEmpty():
            return now.select(F.col("a").alias("vertex"), F.col("b").alias("label"))
    raise RuntimeError("components did not settle")
