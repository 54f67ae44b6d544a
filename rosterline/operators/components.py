"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.session import cut, merged


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (columns ``u``, ``v``): the smallest node it can reach.

    Each round gives every label the smallest of its neighbours' labels and draws the links between labels anew, so the
    links shrink from round to round; minima are combined before the shuffle.  Null ends and links of a node with itself
    are ignored.
    """
    links = cut(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    labels = links.select(F.col("u").alias("node")).union(links.select("v")).distinct().withColumn("component", F.col("node"))
    while not links.isEmpty():
        lower = cut(links.groupBy(F.col("u").alias("_from")).agg(F.min("v").alias("_to")))
        moved = lambda df, c: df.join(merged(lower), F.col(c) == F.col("_from"), "left").withColumn(c, F.coalesce("_to", c)).drop("_from", "_to")  # noqa: E731, B023
        labels = cut(moved(labels, "component"))
        links = moved(moved(links, "u"), "v").where("u <> v")
        links = cut(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    return labels
