"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): ``label`` is the smallest node of its component.

    Each round, a node goes up to its smallest neighbour, if that is smaller than itself, and on to where
    that one goes; edges are kept between where their ends went to, as long as these differ. As
    whole trees merge, a long chain takes few rounds, and the edges get fewer with each. At the
    end the steps are followed back, from the last and smallest round to the first. Rounds are
    written to the shared folder. An edge of a node with itself makes no component.
    """
    edges = edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct()
    edges = staged(edges, "edges")
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label")).where(F.lit(False))
    steps = []
    while not edges.isEmpty():
        up = staged(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up")).select("node", F.least("node", "up").alias("up")), "up")
        further = up.select(F.col("node").alias("up"), F.col("up").alias("further"))
        up = staged(up.join(further, "up").select("node", F.col("further").alias("up")), "up")
        steps.append(up)
        of = lambda end, up=up: up.select(F.col("node").alias(end), F.col("up").alias(f"up_{end}"))
        edges = edges.join(of("a"), "a").join(of("b"), "b").where("up_a != up_b")
        edges = staged(edges.select(F.col("up_a").alias("a"), F.col("up_b").alias("b")).distinct(), "edges")
    for up in reversed(steps):
        later = labels.select(F.col("node").alias("up"), "label")
        labels = staged(up.join(later, "up", "left").select("node", F.coalesce("label", "up").alias("label")), "labels")
    return labels
