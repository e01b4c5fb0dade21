"""Connected components of an edge table, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outagegrid.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links to (id, label): the smallest id reachable. Smallest neighbour labels and pointer jumps alternate until
    nothing changes; every round is stored, so a lost executor repeats one round at most. Messages to one node are
    combined before the shuffle, and joins are plain equi-joins, so a hub neither gathers nor multiplies rows."""
    both = stored(
        edges.select(F.col("a").alias("src"), F.col("b").alias("dst"))
        .unionByName(edges.select(F.col("b").alias("src"), F.col("a").alias("dst")))
        .distinct(),
        "links",
    )
    labels = stored(
        both.groupBy("src").agg(F.min("dst").alias("m")).select(
            F.col("src").alias("id"), F.least("src", "m").alias("label"), F.lit(True).alias("moved")
        ),
        "labels",
    )
    while labels.where("moved").limit(1).count():
        heard = (
            both.join(labels.select(F.col("id").alias("dst"), "label"), "dst")
            .groupBy("src").agg(F.min("label").alias("heard"))
        )
        nearer = labels.join(heard, F.col("id") == F.col("src")).select(
            "id", F.col("label").alias("old"), F.least("label", "heard").alias("label")
        )
        jump = labels.select(F.col("id").alias("via"), F.col("label").alias("root"))
        labels = stored(
            nearer.join(jump, F.col("label") == F.col("via"), "left").select(
                "id", F.least("label", F.coalesce("root", "label")).alias("label"), "old"
            ).select("id", "label", (F.col("label") != F.col("old")).alias("moved")),
            "labels",
        )
    return labels.select("id", "label")
