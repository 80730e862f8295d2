"""Connected components of a link table, as repeated joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.common import materialize
from .common import shuffles_removed

#: Links or labels a task: a round moves two short columns, which a task of the session's shuffle would hold few of.
TASK_ROWS = 1 << 16


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, component): the smallest node reachable, for every node that has an edge.

    Each round every node takes the smallest label among its neighbours' (a map-side minimum per node, so a
    node with very many links is no single task), then the label of its label. Rounds end when no label
    changes; every round's labels are checkpointed, its shuffle files are removed then. The tasks of a round, and so
    the files they leave, follow the number of links, not the session's number of shuffle partitions."""
    with shuffles_removed(edges.sparkSession):
        both = materialize(edges.select("a", "b").where("a <> b").distinct())
        tasks = 1 + both.count() // TASK_ROWS
        both = both.coalesce(tasks)
        both = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
        labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_m"))
                             .select("node", F.least("node", "_m").alias("component")).coalesce(tasks))
        while True:
            # merged, not broadcast: a broadcast would be read by a task for each shuffle partition
            near = (both.join(labels.select(F.col("node").alias("b"), "component").hint("merge"), "b").coalesce(tasks)
                    .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("_near")))
            step = labels.join(near.hint("merge"), "node").select("node", "component", F.least("component", "_near").alias("_new"))
            up = labels.select(F.col("node").alias("_new"), F.col("component").alias("_up"))
            # the label of the label, as far as the last round knew it
            new = materialize(step.coalesce(tasks).join(up.hint("merge"), "_new", "left").select(
                "node", F.col("component").alias("_old"), F.least("_new", "_up").alias("component")).coalesce(tasks))
            changed = new.where("_old <> component").limit(1).count()
            labels = new.select("node", "component")
            if not changed:
                return labels
