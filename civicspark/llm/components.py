"""Connected components of an undirected edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.common import few_tasks
from civicspark.session import materialize, materialize_counted


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, comp)`` for every node of an edge, ``comp`` the smallest node it reaches.

    Each round takes the smallest label among a node's neighbours and then
    the label of its label (pointer jumping), so chains halve. The rounds end
    when a round changes nothing. Labels are written and re-read each round;
    a node with very many edges is pre-aggregated, and AQE splits its join.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).unionByName(edges.select(F.col(b).alias("u"), F.col(a).alias("v")))
    both, n = materialize_counted(both.where("u <> v").distinct(), "cc-edges")
    labels = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("v"))
    labels = materialize(few_tasks(labels, n).select("node", F.least("node", "v").alias("comp")), "cc-labels")
    while True:
        seen = few_tasks(both.join(labels.select(F.col("node").alias("v"), "comp"), "v"), n)
        seen = seen.groupBy(F.col("u").alias("node")).agg(F.min("comp").alias("near"))
        nearest = few_tasks(labels.join(seen, "node", "left"), n)
        nearest = nearest.select("node", F.col("comp").alias("was"), F.least("comp", F.coalesce("near", "comp")).alias("comp"))
        nearest = materialize(nearest, "cc-nearest")
        jump = nearest.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        after = few_tasks(nearest.join(jump, "comp", "left"), n)
        after = materialize(after.select("node", "was", F.least("comp", F.coalesce("further", "comp")).alias("comp")), "cc-labels")
        labels = after.select("node", "comp")
        if after.where("was <> comp").isEmpty():
            return labels
