"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm.rows import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node with a link to another one.

    ``links`` has two columns of whole numbers. The root is the smallest node reachable.
    A link of a node to itself, a repeated link and a link with a null are no links; an
    empty table gives an empty table. A round points each node at its smallest
    neighbour, links its other neighbours to that one, and then skips over parents that
    have parents themselves. Rounds are written out, and end when nothing moves. A node
    with very many links only meets a minimum, which is combined before the shuffle, and
    joins whose hot side adaptive execution can split.
    """
    one, two = (F.col(c) for c in links.columns[:2])
    edges = written(
        links.select(F.greatest(one, two).alias("node"), F.least(one, two).alias("parent"))
        .where(one.isNotNull() & two.isNotNull() & (one != two))
        .distinct(),
        "links",
    )
    while True:
        best = edges.groupBy("node").agg(F.min("parent").alias("best"))
        hooked = (
            edges.join(best, "node")
            .select(
                F.explode(
                    F.when(F.col("parent") == F.col("best"), F.array(F.struct("node", "best", F.lit(False).alias("moved"))))
                    .otherwise(
                        F.array(
                            F.struct("node", "best", F.lit(True).alias("moved")),
                            F.struct(F.col("parent").alias("node"), "best", F.lit(True).alias("moved")),
                        )
                    )
                ).alias("edge")
            )
            .select("edge.*")
        )
        above = best.select(F.col("node").alias("best"), F.col("best").alias("above"))
        moved = (
            hooked.join(above, "best", "left")
            .select(
                "node",
                F.coalesce("above", "best").alias("parent"),
                (F.col("moved") | F.col("above").isNotNull()).alias("moved"),
            )
            .groupBy("node", "parent")
            .agg(F.max("moved").alias("moved"))
        )
        moved = written(moved, "links")
        edges = moved.select("node", "parent")
        if not moved.where("moved").take(1):
            return edges.withColumnRenamed("parent", "root")
