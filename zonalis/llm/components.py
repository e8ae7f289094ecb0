"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.session import materialise


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that some link joins to another; component is
    the smallest node reachable.  Null ends and self links say nothing.

    Every round points each node at its smallest neighbour, follows the pointer once
    more, and replaces the ends of links by what they point at; links shrink by a
    constant share or more a round.  Minima combine before the shuffle, so a node with
    a third of all links costs no task more than others.  Rounds are written tables.
    """
    x, y = F.col(a), F.col(b)
    edges = materialise(
        links.filter(x.isNotNull() & y.isNotNull() & (x != y))
        .select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct(), "links")
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        ends = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialise(
            ends.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("up")), "least")
        step = materialise(
            least.join(least.select(F.col("node").alias("up"), F.col("up").alias("top")), "up").select("node", "top"), "step")
        steps.append(step)
        of = lambda end, step=step: step.select(F.col("node").alias(end), F.col("top").alias(f"_{end}"))
        edges = materialise(
            edges.join(of("a"), "a").join(of("b"), "b").filter(F.col("_a") != F.col("_b"))
            .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "links")
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = steps[-1].select("node", F.col("top").alias("component"))
    for step in reversed(steps[:-1]):
        later = out.select(F.col("node").alias("top"), "component")
        out = step.join(later, "top", "left").select("node", F.coalesce("component", "top").alias("component"))
    return out
