"""Connected components of a table of links.

Each task first joins its own links in a disjoint set, in time and memory proportional to them, and returns a forest.
While the forest is larger than one task may hold, alternating large-star and small-star rounds go on; a forest of
``LOCAL`` links or fewer is joined by one task at once.  Both ways give the same exact result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import ship_code, stage

#: Links that one task joins (about 200 bytes each while it does).
LOCAL = 500_000


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A star for each component of the task's links: u, and v the smallest node of its component."""
    parent: dict = {}

    def top(x):
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    for part in batches:
        for u, v in zip(part["u"].tolist(), part["v"].tolist()):
            a, b = top(u), top(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    for k in range(0, len(nodes), 65536):
        some = nodes[k : k + 65536]
        yield pd.DataFrame({"u": some, "v": [top(x) for x in some]})


def _minimum_of(pairs: DataFrame) -> DataFrame:
    """u, v, m: every pair with the smallest of u and its partners.

    The minimum is combined before the shuffle and written, so that both sides of the join are plain shuffles, which
    adaptive execution can split where one node has a large share of all links.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("w", "m").alias("m"))
    least = stage(least, "least")
    return pairs.join(least, F.col("u") == F.col("w")).select("u", "v", "m")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _minimum_of(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _minimum_of(down)
    kept = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(linked.select("u", F.col("m").alias("v")))
    return kept.where("u <> v").distinct()


def components(links: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """node, component (smallest node reachable) of every node of ``links`` that isn't its component's smallest.

    Each round is written to the shared folder, so a lost executor costs one round at most.  Star rounds end when a
    round changes no link, which takes about log(diameter) of them.  Links with a null end and links of a node with
    itself are ignored; repeated links count once.
    """
    ship_code(links.sparkSession)
    now = links.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v")
    schema = f"u {now.schema['u'].dataType.simpleString()}, v {now.schema['u'].dataType.simpleString()}"
    now = stage(now.mapInPandas(_joined, schema), "links")
    if now.count() <= LOCAL:
        now = stage(now.repartition(1).mapInPandas(_joined, schema), "components")
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    seen = None
    while True:
        now = stage(_small_star(_large_star(now)), "links")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = state
