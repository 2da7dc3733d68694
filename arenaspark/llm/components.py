"""Connected components of an undirected link table, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenaspark.llm.common import shared_table


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node reachable.

    Each round every node takes the smallest label among itself and its
    neighbours, then the label of its label (pointer jumping), so a chain of n
    links needs about log n rounds. Minima are combined map-side, hence a node
    with very many links never gathers them in one task, and each round is cut
    with a table in the shared folder. Links with a null end and self links are
    ignored; an empty table gives an empty result.
    """
    pairs = (links.select(F.col(a).alias("u"), F.col(b).alias("v"))
             .where("u is not null and v is not null and u <> v"))
    both = shared_table(pairs.union(pairs.select("v", "u")).distinct(), "links")
    labels = shared_table(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("root"))
                          .withColumnRenamed("u", "node"), "labels")
    for _ in range(max_rounds):
        near = (both.join(labels.withColumnRenamed("node", "v"), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("root").alias("seen")))
        step = labels.join(near, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "seen").alias("root"))
        parent = labels.select(F.col("node").alias("root"), F.col("root").alias("grand"))
        step = (step.join(parent, "root", "left")
                .select("node", "old", F.coalesce(F.least("root", "grand"), F.col("root")).alias("root")))
        step = shared_table(step, "labels")
        changed = step.where("old <> root").limit(1).count()
        labels = step.select("node", "root")
        if not changed:
            return labels
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
