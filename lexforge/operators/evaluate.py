"""How well a dictionary ranks held-out units: ranks, losses, pages, totals, reasons and differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGE = 9


def ranked(dictionary: DataFrame) -> DataFrame:
    """Add `rank` to (reading, surface, cost): the place among a reading's candidates, by cost, then surface."""
    return dictionary.withColumn("rank", F.row_number().over(Window.partitionBy("reading").orderBy("cost", "surface")))


def attempts(units: DataFrame, dictionary: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, reading, surface, n, rank): the held-out units by surface, with the rank they are offered at, null if they aren't. Units are counted before the join."""
    keys = keys or []
    n = units.groupBy(*keys, "reading", "surface").agg(F.count("*").alias("n"))
    return n.join(ranked(dictionary).select("reading", "surface", "rank"), ["reading", "surface"], "left")


def by_key(attempts_: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, reading, units, missing, first, best_first, page, best_page): what is found, and what the best order would find, of each key."""
    keys = [*(keys or []), "reading"]
    offered = attempts_.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("rank").isNull(), F.desc("n"), "surface")))
    n = F.col("n")
    some = F.col("rank").isNotNull()
    total = lambda when: F.coalesce(F.sum(F.when(when, n)), F.lit(0))
    return offered.groupBy(*keys).agg(
        F.sum(n).alias("units"),
        total(~some).alias("missing"),
        total(F.col("rank") == 1).alias("first"),
        total(some & (F.col("place") == 1)).alias("best_first"),
        total(F.col("rank") <= PAGE).alias("page"),
        total(some & (F.col("place") <= PAGE)).alias("best_page"),
    )


def scores(tallies: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, units, missing, loss, page_loss): the sums over all keys of a group; loss is what the best order finds more."""
    s = lambda c: F.coalesce(F.sum(c), F.lit(0))
    loss, page_loss = F.col("best_first") - F.col("first"), F.col("best_page") - F.col("page")
    return tallies.groupBy(*keys).agg(s("units").alias("units"), s("missing").alias("missing"), s(loss).alias("loss"), s(page_loss).alias("page_loss"))


def diff(before: DataFrame, after: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(keys, v_before, v_after, v_change) of the keys whose values differ; a key that a side lacks counts 0 there."""
    b = before.select(*keys, *[F.col(v).alias(f"{v}_before") for v in values])
    a = after.select(*keys, *[F.col(v).alias(f"{v}_after") for v in values])
    both = b.join(a, keys, "full_outer").na.fill(0, [f"{v}_{x}" for v in values for x in ("before", "after")])
    both = both.withColumns({f"{v}_change": F.col(f"{v}_after") - F.col(f"{v}_before") for v in values})
    changed = F.lit(False)
    for v in values:
        changed |= F.col(f"{v}_change") != 0
    return both.filter(changed)


def reasons(attempts_: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(reason, n): why units aren't found first: the reading is unknown, the surface is known otherwise, unseen, or ranked lower or off the page."""
    known = lexicon.select("surface").distinct().withColumn("known", F.lit(True))
    readings = lexicon.select("reading").distinct().withColumn("read", F.lit(True))
    rows = attempts_.join(known, "surface", "left").join(readings, "reading", "left")
    why = (
        F.when(F.col("rank") == 1, "first")
        .when(F.col("rank") <= PAGE, "lower")
        .when(F.col("rank").isNotNull(), "off page")
        .when(F.col("known"), "other reading")
        .when(F.col("read"), "other surfaces")
        .otherwise("unseen")
    )
    return rows.groupBy(why.alias("reason")).agg(F.sum("n").alias("n"))


def agreement(reading: Column, paths: Column) -> Column:
    """Whether a second analyzer's paths read a surface so: unread if it has no path that reads it, agrees if one does, else disagrees."""
    read = F.array_compact(paths)
    return F.when(F.size(read) == 0, "unread").when(F.array_contains(read, reading), "agrees").otherwise("disagrees")


def mismatches(labels: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(label, expected, offered): labels (label, readings) whose surface the dictionary has, but with none of their readings."""
    offered = dictionary.groupBy(F.col("surface").alias("label")).agg(F.array_sort(F.collect_set("reading")).alias("offered"))
    return labels.join(offered, "label").filter(~F.arrays_overlap("readings", "offered"))


def check_words(cases: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(category, reading, rank): the best rank at which an accepted surface (array `accepted`) of a case is offered, null if none is."""
    one = cases.select("case_id", "category", "reading", F.explode("accepted").alias("surface"))
    found = one.join(ranked(dictionary).select("reading", "surface", "rank"), ["reading", "surface"], "left")
    return found.groupBy("case_id", "category", "reading").agg(F.min("rank").alias("rank"))


def word_scores(results: DataFrame) -> DataFrame:
    """(category, cases, first, page, missing) by category and for all."""
    n = lambda when: F.count_if(when)
    out = results.rollup("category").agg(F.count("*").alias("cases"), n(F.col("rank") == 1).alias("first"), n(F.col("rank") <= PAGE).alias("page"), n(F.col("rank").isNull()).alias("missing"))
    return out.withColumn("category", F.coalesce("category", F.lit("all")))


def agreed_readings(first: DataFrame, second: DataFrame) -> DataFrame:
    """(surface, reading): the readings that both analyzers give a surface."""
    return first.select("surface", "reading").distinct().join(second.select("surface", "reading").distinct(), ["surface", "reading"])


def shares_of_total(counts: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """(keys, n, percent): sums by key and their share of the whole in percent, to two places."""
    by = counts.groupBy(*keys).agg(F.sum(n).alias("n"))
    total = by.agg(F.sum("n").alias("_total"))
    return by.join(F.broadcast(total)).select(*keys, "n", F.round(100 * F.col("n") / F.greatest(F.lit(1), F.col("_total")), 2).alias("percent"))
