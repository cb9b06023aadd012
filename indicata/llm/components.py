"""Connected components of a link table (alternating large-star / small-star).

Every round is two joins of the edges with one row per node, so a node with a
third of all links is split by AQE's skew join and its minimum is aggregated
before the shuffle. Rounds grow with the logarithm of the component's width;
the driver only sees one row (count and checksum of the edges) per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import Steps


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _round(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    large = (both.join(least, "u").filter(F.col("v") > F.col("u"))
             .select(F.col("v").alias("hi"), F.col("m").alias("lo")).filter("hi > lo").distinct())
    lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
    small = large.join(lowest, "hi")
    return (small.filter(F.col("lo") > F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .union(lowest.select("hi", F.col("m").alias("lo"))).distinct())


def component_labels(links: DataFrame, steps: Steps) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``links`` (a, b) but the smallest ones. The
    edges of the last round are a step of the caller's."""
    edges = steps.write(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                        .filter("hi > lo").distinct(), "edges")
    state, before = _state(edges), None
    while state[0] and state != before:
        following = steps.write(_round(edges), "edges")
        steps.drop(edges)
        edges, before, state = following, state, _state(following)
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
