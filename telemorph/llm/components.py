"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemorph.llm.shared import stage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node
    of its component. Repeated links, loops and both directions may occur; rows
    with a null end are ignored; no links give no rows.

    Alternates two steps until nothing changes: every node links its larger
    neighbours to the smallest one it sees, then its smaller neighbours too. The
    links stay as many or get fewer, and a star around the smallest node is
    left. Each round is a grouping and a join by node; a hub's rows are combined
    before the shuffle, and its join partition can be split.
    """
    edges = stage(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct()
    )
    nodes = edges.select(F.col("hi").alias("node")).union(edges.select("lo")).distinct()
    while True:
        # Large star: all larger neighbours of a node go to its smallest neighbour or itself.
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select(F.col("lo"), F.col("hi")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        # Small star: a node's smaller neighbours, and itself, go to the smallest one.
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(F.col("lo").alias("n"), "m").where("n <> m").union(low.select(F.col("hi").alias("n"), "m"))
        after = stage(small.select(F.col("n").alias("hi"), F.col("m").alias("lo")).distinct())
        moved = after.join(edges, ["hi", "lo"], "left_anti").limit(1).count() + edges.join(after, ["hi", "lo"], "left_anti").limit(1).count()
        edges = after
        if not moved:
            break
    roots = edges.groupBy("hi").agg(F.min("lo").alias("root"))
    return nodes.join(roots, nodes["node"] == roots["hi"], "left").select("node", F.coalesce("root", "node").alias("root"))
