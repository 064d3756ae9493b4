"""Connected components: nodes hung on their least neighbours, then least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from menulake.llm.common import Tables


def components(t: Tables, edges: DataFrame) -> DataFrame:
    """``node, root``: the least node that each node of ``edges (a, b)`` reaches.

    First every node is hung on its least neighbour that is no larger, and its
    other such neighbours are linked to that one instead: what many nodes have
    in common becomes one edge, and nodes that are no one's lesser neighbour
    leave the graph. They get the root of the node they hang on. The rounds run on
    what is left.
    """
    down = t.cut(edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("low")).distinct(), "down")
    hung = t.cut(down.groupBy("node").agg(F.min("low").alias("least")), "hung")
    inner = down.select(F.col("low").alias("node")).distinct()
    linked = down.join(hung, "node").where("low != least").select(F.col("low").alias("a"), F.col("least").alias("b"))
    core = hung.join(inner, "node", "left_semi").select(F.col("node").alias("a"), F.col("least").alias("b"))
    labels = _rounds(t, linked.union(core))
    tops = inner.join(hung, "node", "left_anti").select("node", F.col("node").alias("least"))
    roots = hung.unionByName(tops).join(labels.withColumnRenamed("node", "least"), "least", "left")
    roots = t.cut(roots.select("node", F.coalesce("root", "least").alias("root")), "roots")
    t.drop(down, hung, labels)
    return roots


def _rounds(t: Tables, edges: DataFrame) -> DataFrame:
    """``node, root`` of the edges' nodes.

    Each round takes the least label among the neighbours and then the label
    of that label, so chains shrink by half and more a round. Labels are
    tables in the shared folder; nothing but a count reaches the driver. A node
    with very many edges is a skewed key of plain joins and of sums that are
    made before the shuffle.
    """
    both = t.cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = t.cut(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        own = labels.join(near, labels["node"] == near["a"]).select("node", "root", F.least("root", "near").alias("next"))
        step = t.cut(own, "step")
        far = step.select(F.col("node").alias("next"), F.col("next").alias("far"))
        jumped = step.join(far, "next").select("node", F.col("root").alias("was"), F.col("far").alias("root"))
        after = t.cut(jumped, "jumped")
        changed = after.where(F.col("was") != F.col("root")).limit(1).count()
        t.drop(step, labels)
        labels = after
        if not changed:
            t.drop(both)
            return labels
