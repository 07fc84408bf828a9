"""Connected components of a graph whose links are rows, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.runtime import materialize


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """One star step over links (u, v) with u > v: hang neighbours under the smallest node of a neighbourhood.

    The minimum is a partial aggregate joined back to the rows, so a node with many links is never gathered in one row.
    """
    both = links.select("u", "v").union(links.select(F.col("v"), F.col("u")).toDF("u", "v")) if large else links
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    near = both.join(least, "u").select("u", "v", F.least("m", "u").alias("m"))
    if large:
        moved = near.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(near.select("u", F.col("m").alias("v")))
    return moved.filter("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v) links of any orientation -> (node, root): the smallest node of the component of each linked node."""
    now = materialize(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct())
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
        now = materialize(_stars(_stars(now, True), False))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
