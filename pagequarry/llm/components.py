"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, stage_table


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"] or 0


def connected_components(edges: DataFrame) -> DataFrame:
    """Label the nodes of an undirected graph with the least node that they reach.

    ``edges`` has the long columns ``u`` and ``v``; direction, repeats and loops
    don't matter, rows with a null are no edges. Returns ``node, component`` for
    each node with an edge to another node. Every round is written to the shared
    folder, the minimum of each neighbourhood is aggregated before the shuffle,
    and no neighbourhood is ever gathered in one row. The number of rounds grows
    with the logarithm of the longest path.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), (F.col("u") != F.col("v")).alias("_ok"))
    now = stage_table(edges.filter("_ok").select("u", "v").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage_table(large.filter("u <> v").distinct(), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stage_table(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        drop_table(large)
        drop_table(now)
        now, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
