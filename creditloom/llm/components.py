"""Connected components of a link table, by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import stage


def components(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Map every node of ``links`` (a, b) to the smallest node it can reach: (node, label).

    Each round takes the smallest label of the neighbours (aggregated before the shuffle, so a node
    with any number of links is no large group) and then the label's own label. Both tables of every
    join are written tables, so Spark can split a hot key. A round's labels are written to the shared
    folder: lineage ends there. Nulls, loops and repeated links are ignored; an empty table gives an
    empty one. Raises if the labels still change after ``max_rounds`` rounds.
    """
    both = links.filter("a is not null and b is not null and a <> b").select("a", "b")
    both = stage(both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stage(
        both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label"), F.lit(True).alias("changed")),
        "labels",
    )
    for _ in range(max_rounds):
        if labels.filter("changed").isEmpty():
            return labels.select("node", "label")
        near = both.join(labels.select("node", "label"), F.col("a") == F.col("node"))
        near = near.groupBy(F.col("b").alias("node")).agg(F.min("label").alias("near"))
        hooked = stage(
            labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")),
            "hooked",
        )
        jump = hooked.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = stage(
            hooked.join(jump, "label").select(
                "node", F.least("label", "next").alias("label"), (F.least("label", "next") < F.col("old")).alias("changed")
            ),
            "labels",
        )
    raise RuntimeError(f"components still change after {max_rounds} rounds")
