"""Half-open spans in documents: containment, partial overlap, greedy selection and tiling."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def covered(units: DataFrame, spans: DataFrame) -> DataFrame:
    """Add `inside` to units (k, start, end, ...): whether one span (k, start, end) contains the unit.

    The greatest end among the spans that start at or before a unit reaches its end if and only if one of them contains it, so one
    running maximum in document order replaces a range join.
    """
    rest = [c for c in units.columns if c not in ("k", "start", "end")]
    own = units.select("k", "start", "end", F.struct(*rest).alias("_u") if rest else F.lit(0).alias("_u"), F.lit(1).alias("_is_unit"))
    other = spans.select("k", "start", "end", F.lit(None).cast(own.schema["_u"].dataType).alias("_u"), F.lit(0).alias("_is_unit"))
    reach = F.max(F.when(F.col("_is_unit") == 0, F.col("end"))).over(Window.partitionBy("k").orderBy("start").rangeBetween(Window.unboundedPreceding, 0))
    out = own.unionByName(other).withColumn("_reach", reach).filter("_is_unit = 1")
    return out.select("k", "start", "end", *([F.col("_u")[c].alias(c) for c in rest]), F.coalesce(F.col("_reach") >= F.col("end"), F.lit(False)).alias("inside"))


def not_running_out(units: DataFrame, spans: DataFrame) -> DataFrame:
    """The units that no span overlaps in part: each that meets a unit contains it.

    A span that meets a unit without containing it starts or ends inside the unit. So the first edge of a span after a unit's start
    isn't before its end, and one running minimum from the document's end replaces a join of places.
    """
    rest = [c for c in units.columns if c not in ("k", "start", "end")]
    own = units.select("k", "start", "end", F.struct(*rest).alias("_u") if rest else F.lit(0).alias("_u"), F.lit(1).alias("_is_unit"))
    edges = spans.filter("k is not null").select("k", F.explode(F.array("start", "end")).alias("start"))
    other = edges.select("k", "start", F.col("start").alias("end"), F.lit(None).cast(own.schema["_u"].dataType).alias("_u"), F.lit(0).alias("_is_unit"))
    after = Window.partitionBy("k").orderBy(-F.col("start")).rangeBetween(Window.unboundedPreceding, -1)
    out = own.unionByName(other).withColumn("_edge", F.min(F.when(F.col("_is_unit") == 0, F.col("start"))).over(after))
    kept = out.filter("_is_unit = 1 and (_edge is null or _edge >= end)")
    return kept.select(*[F.col("_u")[c].alias(c) if c in rest else F.col(c) for c in units.columns])


def greedy(spans: DataFrame) -> DataFrame:
    """Spans taken from the left, the longer of two that start together first, each from where the last one taken ends. One document a group."""

    def take(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["start", "end"], ascending=[True, False])
        kept, at = [], -1
        for n, (s, e) in enumerate(zip(group["start"], group["end"], strict=True)):
            if s >= at:
                kept.append(n)
                at = e
        return group.iloc[kept]

    return spans.groupBy("k").applyInPandas(take, spans.schema)


def parts_of(spans: DataFrame, units: DataFrame) -> DataFrame:
    """(k, start, end, parts): the readings of the units that tile a span exactly, at least two of them, in order.

    A span is dealt out to its places and meets the units that start there. Its units tile it if they don't overlap,
    their lengths sum to its own, the first starts with it and the last ends with it.
    """
    places = spans.select("k", "start", "end", F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("at"))
    inner = units.select("k", F.col("start").alias("at"), F.col("end").alias("to"), "reading")
    met = places.join(inner, ["k", "at"]).filter("to <= end and not (at = start and to = end)")
    found = met.groupBy("k", "start", "end").agg(F.array_sort(F.collect_list(F.struct("at", "to", "reading"))).alias("p"), F.sum(F.col("to") - F.col("at")).alias("n"), F.min("at").alias("lo"), F.max("to").alias("hi"))
    tiled = found.filter("size(p) >= 2 and n = end - start and lo = start and hi = end and forall(sequence(1, size(p) - 1), i -> p[i].at = p[i - 1].to)")
    return tiled.select("k", "start", "end", F.transform("p", lambda x: x["reading"]).alias("parts"))
