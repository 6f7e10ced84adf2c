"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermart.session import materialise


def _stars(edges: DataFrame) -> DataFrame:
    """(node, root) edges with node > root, once each."""
    return edges.where(F.col("node") != F.col("root")).distinct()


def _linked(edges: DataFrame, small: bool) -> DataFrame:
    """Link neighbours of every node to the smallest of them.

    A large step does so for neighbours above the node, a small step for those below it and the
    node itself. The minima are stored before the join, so that Spark may broadcast
    them, and may divide a node with very many neighbours otherwise.
    """
    if small:
        sides = edges.select(F.col("node").alias("hub"), F.col("root").alias("other"))
    else:
        sides = edges.select(F.col("node").alias("hub"), F.col("root").alias("other")).union(
            edges.select(F.col("root"), F.col("node"))
        )
    minima = materialise(
        sides.groupBy("hub").agg(F.least(F.min("other"), F.col("hub")).alias("least")), "minima"
    )
    joined = sides.join(minima, "hub")
    if small:
        rest = joined.select(F.col("other").alias("node"), F.col("least").alias("root"))
        own = minima.select(F.col("hub").alias("node"), F.col("least").alias("root"))
        return _stars(rest.union(own))
    return _stars(
        joined.where(F.col("other") > F.col("hub")).select(
            F.col("other").alias("node"), F.col("least").alias("root")
        )
    )


def _print(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "root"))).first()
    return row[0], row[1] or 0


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) of every node that some edge joins to another one.

    `component` is the smallest node that edges reach. Alternates steps that link large and small
    neighbours of every node to the smallest one until nothing changes, which takes
    about as many rounds as the logarithm of the longest path. Each
    round is written to the shared folder. Edges with a null end or
    with equal ends are ignored, repeated ones count once; no edges give no rows.
    """
    both = edges.where(F.col(left).isNotNull() & F.col(right).isNotNull())
    current = materialise(
        _stars(
            both.select(
                F.greatest(left, right).alias("node"), F.least(left, right).alias("root")
            )
        ),
        "edges",
    )
    before = _print(current)
    while before[0]:
        large = materialise(_linked(current, small=False), "edges")
        current = materialise(_linked(large, small=True), "edges")
        now = _print(current)
        if now == before:
            break
        before = now
    nodes = current.select("node", F.col("root").alias("component"))
    return nodes.union(nodes.select("component", "component")).distinct()
