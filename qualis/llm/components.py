"""Connected components of a table of links, by repeated joins on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.llm.common import checkpointed, few


def components(links: DataFrame) -> DataFrame:
    """(a, b) links of longs to (node, root): root is the smallest node of the component.

    Alternates two steps until nothing changes: every node points its larger
    neighbours, then its smaller ones, to the smallest node it knows.  Links
    only ever move towards the root, so the table never grows, and each step
    is an aggregate and a join on nodes.
    """
    n = links.count()
    edges = checkpointed(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), n)
    while True:
        both = few(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), n)
        least = few(both.groupBy("a").agg(F.min("b").alias("m")), n).select("a", F.least("a", "m").alias("m"))
        # larger neighbours of a node get its least known node
        up = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = few(few(up.where("a <> b"), n).distinct(), n)
        # of each node's smaller neighbours, all point to the least
        lowest = few(large.groupBy("a").agg(F.min("b").alias("m")), n)
        down = few(large.join(lowest, "a"), n)
        small = few(down.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                    .unionByName(lowest.select("a", F.col("m").alias("b"))), n).distinct()
        new = checkpointed(small, n)
        # done when every node has one link, to a node that links nowhere itself
        tangled = new.groupBy("a").count().where("count > 1").limit(1).count() or new.join(new.select(F.col("a").alias("b")).distinct(), "b", "left_semi").limit(1).count()
        edges = new
        if not tangled:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
