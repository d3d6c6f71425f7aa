"""Connected components of links between integer ids, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import keep


def components(links: DataFrame) -> DataFrame:
    """Least reachable id of every id in ``links`` (columns ``a`` and ``b``).

    Each round takes the least label around every id and then follows labels of labels, so
    the rounds grow with the logarithm of the longest chain. Both steps aggregate partially
    and join on ids, so one large component is spread like many small ones.
    """
    edges = keep(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).filter("a <> b").distinct(), "edges")
    labels = keep(edges.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("l")), "labels")
    while True:
        around = (
            edges.join(labels.withColumnRenamed("v", "b"), "b")
            .groupBy(F.col("a").alias("v"))
            .agg(F.min("l").alias("m"))
        )
        lowered = labels.join(around, "v").select("v", "l", F.least("l", "m").alias("m"))
        follow = labels.select(F.col("v").alias("m"), F.col("l").alias("next"))
        stepped = keep(
            lowered.join(follow, "m", "left").select("v", F.col("l").alias("old"), F.least("m", F.coalesce("next", "m")).alias("l")),
            "labels",
        )
        changed = stepped.filter("old <> l").limit(1).count()
        labels = stepped.select("v", "l")
        if not changed:
            return labels
