"""Connected components of an edge table, by smallest label."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import staged


#: Nodes of a task's forest; a larger one is written out and begun anew.
FOREST_NODES = 1 << 18


class Forest:
    """Union-find that keeps the smallest member as root."""

    def __init__(self):
        self.above: dict = {}

    def root(self, x):
        while self.above.setdefault(x, x) != x:
            self.above[x] = x = self.above[self.above[x]]
        return x

    def join(self, x, y) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.above[max(x, y)] = min(x, y)


def forest(edges: DataFrame) -> DataFrame:
    """Edges (x, y) that connect the same nodes as ``edges``, at most one a node in each task.

    A node's edges are brought to one task, which keeps a tree of them and those of its other nodes; roots are hubs,
    which many nodes share, so few edges are left beside one a node.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Forest()
        kind = None

        def kept() -> pa.RecordBatch:
            pairs = [(x, trees.root(x)) for x in list(trees.above)]
            pairs = [(x, root) for x, root in pairs if x != root]
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], kind) for k in (0, 1)], names=["x", "y"])

        for batch in batches:
            kind = batch.schema.field("x").type
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                trees.join(x, y)
            if len(trees.above) > FOREST_NODES:
                yield kept()
                trees = Forest()
        if kind is not None:
            yield kept()

    return edges.repartition("x").mapInArrow(run, edges.schema)


def _roots(edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes of a task's edges (x, y), by one forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, kind = Forest(), None
        for batch in batches:
            kind = batch.schema.field("x").type
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                trees.join(x, y)
        if kind is not None:
            nodes = list(trees.above)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array([trees.root(x) for x in nodes], kind)], names=["node", "label"])

    return edges.mapInArrow(run, edges.select(F.col("x").alias("node"), F.col("y").alias("label")).schema)


def components(edges: DataFrame, a: str = "a", b: str = "b", task_edges: int = FOREST_NODES // 2) -> DataFrame:
    """(node, label): the smallest node reachable over ``edges``, for every node that has one.

    Edges are brought down to forests in tasks first.  Up to ``task_edges`` edges that are left fit into one more forest, which
    ends there.  With more, each round takes the smallest label among neighbours and then the label of the label, so paths
    halve; rounds are written to the shared folder.  Hubs are summed in tasks first, and joins on them can be split.
    """
    trees = staged(forest(edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x <> y")), "forest")
    if trees.count() <= task_edges:
        return staged(_roots(trees.coalesce(1)), "labels")
    pairs = staged(trees.withColumn("both", F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"))))).select("both.*").distinct(), "edges")
    labels = staged(pairs.groupBy("x").agg(F.min("y").alias("low")).select(F.col("x").alias("node"), F.least("x", "low").alias("label")), "labels")
    while True:
        near = pairs.join(labels.withColumnRenamed("node", "y"), "y").groupBy("x").agg(F.min("label").alias("near"))
        lower = labels.join(near.withColumnRenamed("x", "node"), "node").select("node", "label", F.least("label", "near").alias("near"))
        jump = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        new = staged(lower.join(jump, "near").select("node", F.least("near", "far").alias("label"), (F.least("near", "far") < F.col("label")).alias("moved")), "labels")
        labels = new.select("node", "label")
        if new.filter("moved").isEmpty():
            return labels
