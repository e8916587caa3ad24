"""Connected components of a graph that no single task can hold."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """Component of every node that has an edge: rows (``node``, ``root``).

    ``edges`` has two long columns ``a`` and ``b``; the root is the smallest node.
    Every round hooks each node to its smallest neighbour, shortens the resulting
    trees by pointer jumping, and goes on with the edges between their roots. At
    least every second node with an edge goes in a round, so rounds are few.
    Nulls and loops are ignored; an empty table gives an empty table.
    """
    smaller, larger = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    present = F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))
    left = materialise(edges.filter(present).select(smaller, larger).distinct())
    found = left.select(F.col("b").alias("node"), F.col("a").alias("root")).limit(0)
    while not left.isEmpty():
        hooks = left.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
        trees = shorten(hooks)
        # A node found earlier points to a root of its round, which may have moved on.
        found = materialise(follow(found, trees, "root").unionByName(trees))
        moved = follow(follow(left, trees, "a"), trees, "b")
        left = materialise(
            moved.filter(F.col("a") != F.col("b")).select(smaller, larger).distinct()
        )
    return found


def follow(rows: DataFrame, trees: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``column`` replaced by its root where it has one."""
    to = trees.select(F.col("node").alias("__node"), F.col("root").alias("__root"))
    joined = rows.join(to, F.col(column) == F.col("__node"), "left")
    return joined.withColumn(column, F.coalesce("__root", column)).drop("__node", "__root")


def shorten(pointers: DataFrame) -> DataFrame:
    """Every node's root in trees given by pointers to smaller nodes."""
    trees = materialise(pointers)
    while True:
        to = trees.select(F.col("node").alias("__node"), F.col("root").alias("__next"))
        jumped = materialise(
            trees.join(to, F.col("root") == F.col("__node"), "left").select(
                "node",
                F.coalesce("__next", "root").alias("root"),
                F.col("__next").isNotNull().alias("__moved"),
            )
        )
        trees = jumped.select("node", "root")
        if jumped.filter("__moved").isEmpty():
            return trees
