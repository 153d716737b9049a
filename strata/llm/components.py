"""Connected components over an edge table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp) for every node of the undirected ``edges``; ``comp`` is the
    smallest node value reachable.

    Each round every node takes the smallest label among its neighbours, then
    the label of its label (which halves what is left of a chain). Labels are
    written between rounds, so a round never recomputes the ones before it.
    Nothing but one changed-row count reaches the driver. Edges with a null
    end are ignored; repeated edges and self loops change nothing.
    """
    e = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    both = stage(e.select(F.col(a).alias("u"), F.col(b).alias("v"))
                 .unionByName(e.select(F.col(b).alias("u"), F.col(a).alias("v"))).distinct(), "cc-edges")
    labels = stage(both.groupBy(F.col("u").alias("node"))
                   .agg(F.least(F.min("v"), F.first("u")).alias("comp")), "cc-labels")
    while True:
        near = both.join(labels, both.v == labels.node).groupBy("u").agg(F.min("comp").alias("near"))
        step = labels.join(near, labels.node == near.u) \
            .select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        up = labels.select(F.col("node").alias("n2"), F.col("comp").alias("up"))
        nxt = stage(step.join(up, step.comp == up.n2)
                    .select("node", "old", F.least("comp", "up").alias("comp")), "cc-labels")
        if nxt.where("comp <> old").isEmpty():
            return nxt.select("node", "comp")
        labels = nxt.select("node", "comp")
