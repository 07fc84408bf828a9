"""Composite jobs: each takes DataFrames and returns the tables it makes, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.functions import words
from lexforge.operators import chains, dictionary, evaluate, select, units
from lexforge.runtime import materialize


def cut_units(docs: DataFrame) -> dict[str, DataFrame]:
    """The units of keyed documents (k, kind, b, text), written once for the jobs that follow, and their counts by kind."""
    table = materialize(units.tokens(docs))
    return {"units": table, "summary": table.groupBy("kind").agg(F.count("*").alias("units"))}


def build_dictionary(unit_table: DataFrame, lexicon: DataFrame | None = None, *, train_only: bool = False, min_count: int = 2) -> dict[str, DataFrame]:
    """The ranked dictionary of all units, or of the training split: counted words, lexicon words, okurigana-like and pair lines, chains."""
    t = unit_table.filter("b >= 10") if train_only else unit_table
    total = materialize(t.agg(F.count("*").alias("total")))
    counted = dictionary.counted(t, ["reading", "surface"], min_count)
    lines = counted.select("reading", "surface", "cost")
    if lexicon is not None:
        seen = t.groupBy("surface").agg(F.count("*").alias("n")).join(F.broadcast(total)).select("surface", (words.cost_of(F.col("n"), F.col("total")) + 1000).alias("c"))
        lines = dictionary.merged(lines, lexicon.select("reading", "surface").distinct().join(seen, "surface", "left").select("reading", "surface", F.coalesce("c", F.lit(3000)).alias("cost")))
    pairs = t.withColumn("nx", F.lead("reading").over(units.in_order())).filter(F.length("nx") <= 3)
    pairs = pairs.select(words.particle_line(F.col("reading"), F.col("surface"), F.col("nx")).alias("l")).select("l.*")
    return {"dictionary": lines, "pairs": dictionary.pair_lines(pairs, total, 10), "chains": chains.chains(t, 2, 10, 5)}


def evaluate_dictionary(unit_table: DataFrame, lines: DataFrame, before: DataFrame | None = None) -> dict[str, DataFrame]:
    """Tallies by key, scores by kind and for all, reasons, and the difference from an earlier run's keys, on the held-out split."""
    held = unit_table.filter("b between 1 and 9")
    by_kind = materialize(evaluate.attempts(held, lines, ["kind"]))
    whole = by_kind.groupBy("reading", "surface").agg(F.sum("n").alias("n"), F.any_value("rank").alias("rank"))
    keys = materialize(evaluate.by_key(whole))
    out = {
        "keys": keys,
        "scores": evaluate.scores(evaluate.by_key(by_kind, ["kind"]), ["kind"]),
        "total": evaluate.scores(keys, []),
        "reasons": evaluate.reasons(whole, unit_table.filter("b >= 10").select("reading", "surface").distinct()),
    }
    if before is not None:
        out["diff"] = evaluate.diff(before, keys, ["reading"], ["missing", "first", "page"])
    return out


def additional(lines: DataFrame, base: DataFrame, start: int | None = None) -> dict[str, DataFrame]:
    """A domain dictionary's lines that the base lacks, checked, with costs from `start` if given; and the lines both have."""
    kept = dictionary.without(lines, base, ["reading", "surface"])
    shared = lines.select("reading", "surface").join(base.select("reading", "surface"), ["reading", "surface"], "left_semi")
    return {"dictionary": kept if start is None else dictionary.shifted(kept, start), "shared": shared}


def check_sample(lines: DataFrame, per_stratum: int) -> dict[str, DataFrame]:
    """Lines for people to judge: the same number of each stratum, chosen by hash."""
    text = F.concat_ws("\t", "reading", "surface", F.col("cost").cast("string"))
    strata = lines.withColumn("stratum", words.stratum_of(F.lit("base"), F.col("reading"), F.lit(None).cast("string"), F.col("cost")))
    return {"sample": select.sample_by_hash(strata, text, per_stratum, ["stratum"]).select("stratum", "line")}
