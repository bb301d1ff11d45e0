"""Following pointers and finding connected components in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.sources.staging import discard, stage


def follow_to_root(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows (id, root) for a forest given as (child, parent) edges.

    Every round doubles the distance a node looks ahead.
    """
    roots = stage(
        nodes.join(edges.withColumnRenamed("child", "id"), "id", "left").select(
            "id", F.coalesce("parent", "id").alias("root")
        ),
        "roots",
    )
    last = roots
    while True:
        onward = roots.select(F.col("id").alias("root"), F.col("root").alias("_next"))
        moved = stage(
            roots.join(onward, "root").select("id", F.col("_next").alias("root"), (F.col("_next") != F.col("root")).alias("_moved")),
            "roots",
        )
        # the round is written: what it was made from is not read again
        discard(last)
        last, roots = moved, moved.select("id", "root")
        if moved.where("_moved").isEmpty():
            return roots


def connected(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows (id, root): the smallest id each node (id) is linked to by (a, b) edges.

    In each round a node and its root both take the smallest root among the
    node's neighbours, and pointers are then shortened by one step. Every round
    is one written table; the number of rounds grows with the logarithm of the
    longest path.
    """
    links = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = stage(links.where(F.col("a") != F.col("b")).distinct(), "links")
    roots = stage(nodes.select("id", F.col("id").alias("root")).distinct(), "roots")
    none = F.lit(None).cast("bigint")
    last = roots
    while True:
        to = roots.select(F.col("id").alias("b"), F.col("root").alias("_low"))
        lowest = links.join(to, "b").groupBy(F.col("a").alias("id")).agg(F.min("_low").alias("_low"))
        seen = roots.join(lowest, "id", "left").select("id", "root", F.coalesce("_low", "root").alias("_low"))
        offers = seen.select("id", F.least("root", "_low").alias("_to"), F.col("root").alias("_old")).unionByName(
            seen.where(F.col("_low") < F.col("root")).select(F.col("root").alias("id"), F.col("_low").alias("_to"), none.alias("_old"))
        )
        hooked = offers.groupBy("id").agg(F.min("_to").alias("_to"), F.max("_old").alias("_old"))
        jump = hooked.select(F.col("id").alias("_to"), F.col("_to").alias("root"))
        moved = stage(
            hooked.join(jump, "_to").select("id", "root", (F.col("root") != F.col("_old")).alias("_moved")),
            "roots",
        )
        # the round is written: what it was made from is not read again
        discard(last)
        last, roots = moved, moved.select("id", "root")
        if moved.where("_moved").isEmpty():
            discard(links)
            return roots
