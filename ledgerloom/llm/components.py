"""Connected components of links that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.tables import written


def _least(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(F.col("u").alias("k")).agg(F.min("v").alias(name))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (u, v) but the roots; a root is the smallest node of its component.

    Stars are built in turns: every node first sends its larger neighbours, then its smaller ones, to the smallest
    node it knows. The number of rounds grows with the logarithm of the longest path. Each round is written to the
    shared folder, so no round is computed twice and lost executors cost at most one. A node with very many links
    is a skewed join key, not a group: only minima are gathered per node.
    """
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    before = None
    while True:
        edges = written(edges, "links")
        state = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if state[0] == 0 or state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = _least(both, "m").select("k", F.least("k", "m").alias("m"))
        large = both.join(near, F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = _least(large, "m")
        joined = large.join(near, F.col("u") == F.col("k"))
        edges = joined.select("u", F.col("m").alias("v")).unionByName(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
