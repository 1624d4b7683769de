"""Connected components of a table of links, by alternating star contractions.

Each round hangs every node's larger neighbours on its smallest one, then does
the same for the smaller ones, until all components are stars. Only minima are
gathered per node, so a node with very many links is a partial aggregate and a
join of written tables, which adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tastegraph.workspace import materialize


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node with a link to another; `root` is the
    smallest node of its component. Links may repeat and go either way."""
    edges = materialize(
        links.where(F.col(left) != F.col(right))
        .select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).distinct(), "edges")
    seen = None
    while (found := _fingerprint(edges)) != seen:
        seen = found
        low = materialize(edges.union(edges.select("v", "u")).groupBy("u").agg(F.min("v").alias("least"))
                          .select(F.col("u").alias("v"), F.least("u", "least").alias("least")), "low")
        large = materialize(edges.join(low, "v").select("u", F.col("least").alias("v")).distinct(), "large")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("least")), "least")
        small = large.join(least, "u").where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        edges = materialize(small.union(least).distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select("v", "v").distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    """Count and two sums of hashes: equal for equal sets of edges."""
    mixed = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(mixed), F.sum(F.shiftright(mixed, 20))).first())
