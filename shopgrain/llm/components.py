"""Connected components of an undirected graph by contraction."""

from pyspark.sql import DataFrame, functions as F

from shopgrain.operators.lookup import by_size
from shopgrain.sources.scratch import Size, materialise, measured


def _roots(parents: DataFrame, size: Size) -> DataFrame:
    """node, parent with every parent a root: pointer jumping, so the rounds grow with the log of the depth.

    ``size`` is that of ``parents``: rows stay, and parents only get smaller.
    """
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        jumped = materialise(
            parents.join(by_size(up, size), "parent", "left").select(
                "node",
                F.coalesce("grand", "parent").alias("parent"),
                F.coalesce(F.col("grand") != F.col("parent"), F.lit(False)).alias("moved"),
            ),
            "roots",
        )
        parents = jumped.drop("moved")
        if jumped.where("moved").isEmpty():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of ``edges`` (a, b)."""
    return sized_components(edges)[0]


def sized_components(edges: DataFrame) -> tuple[DataFrame, Size]:
    """The written ``components`` and their size.

    Each round hooks every component to its smallest neighbour and contracts; at least half of the components
    of a connected part go, so rounds grow with the log of the nodes. Only edges between different components are
    carried on. Repeated edges and loops are harmless; without edges the result is empty.
    """
    labels = labels_size = None
    rest = edges.select("a", "b")
    while True:
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("b"), F.col("a")).alias("parent")
        )
        hooks, size = measured(hooked, "hooks")
        parents = _roots(hooks, size)
        if labels is None:
            labels_size = size
            labels = parents.withColumnRenamed("parent", "component")
        else:
            moved = parents.select(F.col("node").alias("component"), "parent")
            labels = labels.join(by_size(moved, size), "component", "left").select(
                "node", F.coalesce("parent", "component").alias("component")
            )
        labels = materialise(labels, "labels")
        of = {
            side: parents.select(F.col("node").alias(side), F.col("parent").alias(f"{side}_new"))
            for side in "ab"
        }
        rest = materialise(
            rest.join(by_size(of["a"], size), "a")
            .join(by_size(of["b"], size), "b")
            .where("a_new <> b_new")
            .select(F.col("a_new").alias("a"), F.col("b_new").alias("b"))
            .distinct(),
            "edges",
        )
        if rest.isEmpty():
            return labels, labels_size
