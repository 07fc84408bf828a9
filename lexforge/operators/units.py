"""Documents to units: keys, tokens with positions, lines and their offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.functions.words import kind_of, split_bucket

TOKEN = "(\\p{L}+)"


def keyed(docs: DataFrame, *parts: str) -> DataFrame:
    """(k, kind, b, text): the key of a document, its kind and its split bucket."""
    k = F.concat_ws(":", *parts)
    return docs.select(k.alias("k"), "text").select("k", kind_of(F.col("k")).alias("kind"), split_bucket(F.col("k")).alias("b"), "text")


def tokens(docs: DataFrame, pattern: str = TOKEN, near: dict[str, tuple[str, int]] | None = None) -> DataFrame:
    """(k, kind, b, i, surface, reading): the tokens of the Latin profile with their ordinal; a narrow operation.

    `near` adds columns of neighbours: name -> (surface or reading, how many places on, or back if negative), null beyond the ends.
    They come from the document's own array of tokens, so no shuffle brings neighbours together.
    """
    found = docs.select("k", "kind", "b", F.regexp_extract_all("text", F.lit(pattern), 1).alias("_all"))
    if not near:
        return found.select("k", "kind", "b", F.posexplode("_all").alias("i", "surface")).withColumn("reading", F.lower("surface"))
    own = lambda x, i: F.struct(i.alias("i"), x.alias("surface"), *[F.get("_all", i + at).alias(name) for name, (_, at) in near.items()])
    out = found.select("k", "kind", "b", F.inline(F.transform("_all", own))).withColumn("reading", F.lower("surface"))
    return out.withColumns({name: F.lower(name) for name, (what, _) in near.items() if what == "reading"})


def readings(units: DataFrame) -> DataFrame:
    """(k, readings): the readings of each document in order, from its text (k, text), or gathered from its units (k, i, reading)."""
    if "text" in units.columns:
        found = units.select("k", F.regexp_extract_all("text", F.lit(TOKEN), 1).alias("_all"))
        return found.select("k", F.transform("_all", F.lower).alias("readings"))
    own = units.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("i", "reading"))).alias("_u"))
    return own.select("k", F.col("_u.reading").alias("readings"))


def ahead(n: int) -> dict[str, tuple[str, int]]:
    """The neighbours n2, ..., nn of `ngrams`, for `tokens`."""
    return {f"n{j}": ("reading", j - 1) for j in range(2, n + 1)}


def lines(docs: DataFrame) -> DataFrame:
    """(k, kind, line, offset, text): each line with its first code point's place in the document."""
    parts = F.split("text", "\n")
    found = docs.select("k", "kind", F.posexplode(parts).alias("line", "text"))
    before = Window.partitionBy("k").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("offset", F.coalesce(F.sum(F.length("text") + 1).over(before), F.lit(0)))


def in_order(by: str = "i", key: str = "k"):
    """The window of a document's units in order; a document is the largest group, never a corpus."""
    return Window.partitionBy(key).orderBy(by)


def ngrams(units: DataFrame, n: int) -> DataFrame:
    """Add n2, n3, ...: the readings of the next n - 1 units of the document, null at its end; units that `tokens` gave them stay as they are."""
    if f"n{n}" in units.columns:
        return units
    w = in_order()
    return units.withColumns({f"n{j}": F.lead("reading", j - 1).over(w) for j in range(2, n + 1)})


def runs(units: DataFrame, inside) -> DataFrame:
    """(k, run, start, end, n): the maximal stretches of touching units that satisfy a condition (gaps and islands)."""
    w = in_order()
    own = units.filter(inside).withColumn("run", F.col("i") - F.row_number().over(w))
    return own.groupBy("k", "run").agg(F.min("i").alias("start"), (F.max("i") + 1).alias("end"), F.count("*").alias("n"))


#: Characters after which a line may be cut.
BREAKS = "。、．，！？」）\\x{20}\\x{3000}\\t"


def pieces(line_table: DataFrame, *, most_bytes: int = 40_000) -> DataFrame:
    """(..., at, text): lines of up to `most_bytes` bytes whole; longer ones in pieces of a quarter as many characters, each cut after the last break in its second half, if it has one. `at` counts code points from 0."""
    step, half = most_bytes // 4, most_bytes // 8
    rest = [c for c in line_table.columns if c != "text"]
    # A piece ends with a break in its second half, or is full, or is the last one.
    pattern = f"(?s)(.{{{step}}}$|.{{1,{step}}}$|.{{{half},{step - 1}}}[{BREAKS}]|.{{{step}}})"
    cut = F.when(F.octet_length("text") <= most_bytes, F.array("text")).otherwise(F.regexp_extract_all("text", F.lit(pattern), 1))
    starts = F.transform(cut, lambda x, i: F.struct(F.aggregate(F.slice(cut, 1, i), F.lit(0), lambda a, y: a + F.length(y)).alias("at"), x.alias("text")))
    return line_table.select(*rest, F.inline(starts))


def compound_units(compounds: DataFrame, units: DataFrame, is_convertible: Column) -> DataFrame:
    """The compounds (k, start, surface, ...) that take a conversion and aren't units already at their place."""
    return compounds.filter(is_convertible).join(units.select("k", "start", "surface"), ["k", "start", "surface"], "left_anti")


def typed_units(units: DataFrame, compounds: DataFrame) -> DataFrame:
    """The units (k, start, end, ...) that are typed on their own: those inside no compound."""
    from lexforge.operators.intervals import covered

    return covered(units, compounds).filter(~F.col("inside")).drop("inside")
