"""Dictionaries of (reading, surface, conjugation, cost): counting, merging, derived lines, rendering."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lexforge.functions.kana import KANJI, voicings
from lexforge.functions.words import cost_of

KEY = ["reading", "surface", "conjugation"]


def counted(units: DataFrame, keys: list[str], min_count: int = 2) -> DataFrame:
    """(keys, n, cost): the units that occur often enough, with a cost by their share of all units.

    The total comes from the counts, as a window over the aggregate would gather them in one task.
    """
    counts = units.groupBy(*keys).agg(F.count("*").alias("n"))
    total = units.agg(F.count("*").alias("total"))
    return counts.filter(F.col("n") >= min_count).join(F.broadcast(total)).withColumn("cost", cost_of(F.col("n"), F.col("total"))).drop("total")


def merged(*dictionaries: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The union, each key at its least cost."""
    keys = keys or ["reading", "surface"]
    out = dictionaries[0].select(*keys, "cost")
    for d in dictionaries[1:]:
        out = out.unionByName(d.select(*keys, "cost"))
    return out.groupBy(*keys).agg(F.min("cost").alias("cost"))


def without(lines: DataFrame, base: DataFrame, keys: list[str]) -> DataFrame:
    """The lines whose key isn't in the base; nulls match nulls."""
    same = [lines[k].eqNullSafe(base[k]) for k in keys]
    return lines.join(base, same, "left_anti")


def fragments(units: DataFrame, min_places: int = 1) -> DataFrame:
    """(surface, inside, places): the surfaces of which three quarters stand inside longer units; rows have `inside` as a boolean."""
    n = units.groupBy("surface").agg(F.count_if("inside").alias("inside"), F.count("*").alias("places"))
    return n.filter((F.col("inside") * 4 >= F.col("places") * 3) & (F.col("places") >= min_places))


def pair_lines(pairs: DataFrame, total: DataFrame, min_count: int, penalty: int = 400) -> DataFrame:
    """(reading, surface, n, cost) of words with what often follows, at a penalty."""
    n = pairs.groupBy("reading", "surface").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)
    return n.join(F.broadcast(total)).withColumn("cost", cost_of(F.col("n"), F.col("total")) + penalty).drop("total")


def okuri_lines(lines: DataFrame, rare_cost: int | None = None, penalty: int = 0) -> DataFrame:
    """(reading, surface, cost): the least cost of the words that share an okurigana line; those only rare ones have cost more."""
    out = lines.groupBy("reading", "surface").agg(F.min("cost").alias("cost"))
    return out if rare_cost is None else out.withColumn("cost", F.when(F.col("cost") >= rare_cost, F.col("cost") + penalty).otherwise(F.col("cost")))


def shifted(lines: DataFrame, start: int) -> DataFrame:
    """The lines with costs moved so that the cheapest is at `start`, none below 0."""
    least = lines.agg(F.min("cost").alias("least"))
    return lines.join(F.broadcast(least)).withColumn("cost", F.greatest(F.lit(0), F.col("cost") + start - F.col("least"))).drop("least")


def rendered(lines: DataFrame) -> DataFrame:
    """(reading, cost, surface, conjugation, line): the text of each line, tab-separated; the caller orders and writes it."""
    text = F.concat_ws("\t", "reading", "surface", F.coalesce("conjugation", F.lit("")), F.col("cost").cast("string"))
    return lines.select("reading", "cost", "surface", "conjugation", text.alias("line"))


def in_text_order(lines: DataFrame) -> DataFrame:
    return lines.orderBy("reading", F.desc("cost"), "surface", F.asc_nulls_first("conjugation"))


def parsed(text_lines: DataFrame) -> DataFrame:
    """(reading, surface, conjugation, cost, valid) of raw lines (value); headers and empty lines are left out."""
    p = F.split("value", "\t")
    rows = text_lines.filter(~F.col("value").startswith("#") & (F.trim("value") != ""))
    cost = F.try_to_number(F.get(p, 3), F.lit("9999999999")).cast("long")
    out = rows.select(F.get(p, 0).alias("reading"), F.get(p, 1).alias("surface"), F.nullif(F.get(p, 2), F.lit("")).alias("conjugation"), cost.alias("cost"), F.size(p).alias("fields"))
    return out.withColumn("valid", (F.col("fields") >= 2) & (F.length("reading") > 0) & (F.length("surface") > 0)).drop("fields")


def checked(lines: DataFrame) -> DataFrame:
    """The lines, if all are valid; ValueError names one that isn't, before anything is written."""
    bad = lines.filter(~F.coalesce("valid", F.lit(False))).limit(1).collect()
    if bad:
        raise ValueError(f"an invalid line: {bad[0].asDict()}")
    return lines


def listed(items: DataFrame, order: str, first: int = 8192, most: int = 16383) -> DataFrame:
    """(reading, surface, cost): each pair once, at its first place; the cost is `first` plus its rank in its reading, at most `most`."""
    once = items.groupBy("reading", "surface").agg(F.min(order).alias("_at"))
    rank = F.row_number().over(Window.partitionBy("reading").orderBy("_at", "surface")) - 1
    return once.withColumn("cost", F.least(F.lit(most), F.lit(first) + rank)).drop("_at")


def shares(rows: DataFrame, names: Column, total: DataFrame) -> DataFrame:
    """(name, n, cost): how many rows have a name, each row counting it once."""
    n = rows.select(F.explode(F.array_distinct(names)).alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    return n.join(F.broadcast(total)).withColumn("cost", cost_of(F.col("n"), F.col("total"))).drop("total")


def bearers(people: DataFrame, min_bearers: int = 2) -> DataFrame:
    """(name, weight, bearers): the greatest weight and the number of distinct bearers of each name."""
    return people.groupBy("name").agg(F.max("weight").alias("weight"), F.count_distinct("item").alias("bearers")).filter(F.col("bearers") >= min_bearers)


def weighted(rows: DataFrame, keys: list[str], item: str, weight: str) -> DataFrame:
    """(keys, weight): the sum of weights, each item once for a key."""
    once = rows.groupBy(*keys, item).agg(F.max(weight).alias("_w"))
    return once.groupBy(*keys).agg(F.sum("_w").alias("weight"))


def counted_words(counters: DataFrame, numbers: DataFrame, written: DataFrame, penalty: int = 230) -> DataFrame:
    """(reading, surface, cost): each counter with each of the small numbers; the least of the written word's cost and the counter's plus a penalty."""
    all_ = counters.join(F.broadcast(numbers))  # ten numbers
    made = all_.select(F.concat("number_reading", "reading").alias("reading"), F.concat("number", "surface").alias("surface"), (F.col("cost") + penalty).alias("made"))
    return made.join(written.select("surface", F.col("cost").alias("as_written")), "surface", "left").groupBy("reading", "surface").agg(F.min(F.least("made", F.coalesce("as_written", "made"))).alias("cost"))


def alignment_shares(alignments: DataFrame) -> DataFrame:
    """(reading, kanji, weight): each word's weight in equal parts over its alignments; rows of (word, way, reading, kanji, cost)."""
    ways = Window.partitionBy("word")
    out = alignments.withColumn("ways", F.size(F.collect_set("way").over(ways)))
    return out.groupBy("reading", "kanji").agg(F.sum(F.exp(-F.col("cost") / 100) / F.col("ways")).alias("weight"))


def nihon(lines: DataFrame) -> DataFrame:
    """(reading, surface, cost): the にほん readings of the lines that read 日本 only as にっぽん, at their cost; those there already stay away."""
    from lexforge.functions.words import nihon_readings

    own = lines.select(nihon_readings(F.col("reading"), F.col("surface")).alias("reading"), "surface", "cost").filter("reading is not null")
    read = lines.filter(F.col("reading").contains("にほん")).select("surface").distinct()
    return own.join(read, "surface", "left_anti").select("reading", "surface", "cost")


def numeric_entries(units: DataFrame, total: DataFrame, is_voiced_freely: Column, min_count: int = 2) -> DataFrame:
    """(reading, surface, cost) of numbers with what they count; where voicing is free, each way to voice the reading has the cost, at its least."""
    n = units.groupBy("reading", "surface").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)
    n = n.join(F.broadcast(total)).withColumn("cost", cost_of(F.col("n"), F.col("total")))
    each = F.when(is_voiced_freely, F.array_append(voicings(F.col("reading")), F.col("reading"))).otherwise(F.array("reading"))
    return n.select(F.explode(each).alias("reading"), "surface", "cost").groupBy("reading", "surface").agg(F.min("cost").alias("cost"))


def counting_small_numbers(numeric: DataFrame, by_nouns: DataFrame) -> DataFrame:
    """The numeric lines that words of small numbers are made from: those after kanji numerals, and those that no plain noun makes (reading, surface)."""
    known = by_nouns.select("reading", "surface", F.lit(True).alias("_noun")).distinct()
    return numeric.join(known, ["reading", "surface"], "left").filter(F.col("surface").startswith("{kanji}") | F.col("_noun").isNull()).drop("_noun")


def title_entries(titles: DataFrame, unit_counts: DataFrame, text_counts: DataFrame, total: DataFrame, min_count: int = 2) -> DataFrame:
    """(reading, surface, n, cost): titles (reading, surface) of two characters or more that occur often enough, as units where that is counted, else as whole words of the texts."""
    t = titles.filter(F.length("surface") >= 2).distinct()
    t = t.join(unit_counts.select("surface", F.col("n").alias("_u")), "surface", "left").join(text_counts.select("surface", F.col("n").alias("_t")), "surface", "left")
    t = t.withColumn("n", F.coalesce("_u", "_t", F.lit(0).cast("long"))).filter(F.col("n") >= min_count)
    return t.join(F.broadcast(total)).select("reading", "surface", "n", cost_of(F.col("n"), F.col("total")).alias("cost"))


def unnamed_entries(entries: DataFrame, chains: DataFrame, total: DataFrame, conjugation: str = "サ行変格", min_count: int = 2) -> DataFrame:
    """(reading, surface, conjugation, cost): the entries of the chains taken, and as stems those that end in kanji and are followed by する (suru) often enough."""
    stems = chains.filter(F.col("taken") & (F.col("suru") >= min_count) & F.col("surface").rlike(f"[{KANJI}]$")).join(F.broadcast(total))
    stems = stems.select("reading", "surface", F.lit(conjugation).alias("conjugation"), cost_of(F.col("suru"), F.col("total")).alias("cost"))
    return entries.select("reading", "surface", F.lit(None).cast("string").alias("conjugation"), "cost").unionByName(stems)


def needless_readings(added: DataFrame, dropped: DataFrame) -> DataFrame:
    """(reading, surface, why): added readings (reading, surface, use) that the base drops, or has without them (rare or given)."""
    drops = dropped.select("surface", F.lit("dropped").alias("_why")).distinct()
    why = F.coalesce("_why", F.when(F.col("use").isin("rare", "given"), F.col("use")))
    return added.join(drops, "surface", "left").select("reading", "surface", why.alias("why")).filter("why is not null")


def without_rendaku(words: DataFrame) -> DataFrame:
    """The conjugating words (reading, surface, conjugation, ...) without those whose reading is another's of the same word with its first kana voiced."""
    voiced = words.select(F.explode(voicings(F.col("reading"))).alias("reading"), "surface", "conjugation").distinct()
    return words.join(voiced, ["reading", "surface", "conjugation"], "left_anti")


def dropped(tables: dict[str, DataFrame], is_dropped: Callable[[DataFrame], Column]) -> dict[str, DataFrame]:
    """Each table of a dictionary without the lines that a condition names."""
    return {name: t.filter(~F.coalesce(is_dropped(t), F.lit(False))) for name, t in tables.items()}


def okurigana_variants(units: DataFrame) -> DataFrame:
    """The units that are okurigana variants, as plain ones, to build a dictionary of their own from."""
    return units.filter("okurigana_variant").withColumn("okurigana_variant", F.lit(False)).withColumn("parts", F.lit(None).cast(units.schema["parts"].dataType) if "parts" in units.columns else F.lit(None).cast("array<string>"))


def preferred(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of the first table, and those of the second whose key it doesn't have."""
    return first.unionByName(without(second, first, keys))


#: Rows from which a worker keeps the first of each key before they're sorted: some 100 MB.
BUFFERED = 500_000


def first_examples(rows: DataFrame, keys: list[str], order: Column, example: Column) -> DataFrame:
    """(keys, n, example): how often each key occurs, and its first example by `order`, a struct.

    Spark sorts the rows for such an aggregate, since its state has strings; so workers reduce them to one for each key of a buffer first.
    """
    own = rows.select(*keys, example.alias("example"), order.alias("_o"))
    by = own.schema["_o"].dataType.names
    sent = own.select(*keys, "example", *[F.col("_o")[name].alias(f"_o{j}") for j, name in enumerate(by)])
    buffered = BUFFERED

    def first(table: pa.Table) -> list[pa.RecordBatch]:
        table = table.take(pc.sort_indices(table, sort_keys=[(f"_o{j}", "ascending") for j in range(len(by))], null_placement="at_start"))
        at = table.select(keys).append_column("_at", pa.array(range(table.num_rows), pa.int64()))
        groups = at.group_by(keys, use_threads=False).aggregate([("_at", "min"), ("_at", "count")])
        return table.take(groups["_at_min"]).append_column("n", groups["_at_count"]).combine_chunks().to_batches()

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= buffered:
                yield from first(pa.Table.from_batches(held))
                held, size = [], 0
        if size:
            yield from first(pa.Table.from_batches(held))

    reduced = sent.mapInArrow(reduce, StructType([*sent.schema.fields, StructField("n", LongType())]))
    place = F.struct(*[f"_o{j}" for j in range(len(by))])
    return reduced.groupBy(*keys).agg(F.sum("n").alias("n"), F.min_by("example", place).alias("example"))


def report(**kinds: DataFrame) -> DataFrame:
    """(kind, n, reading, surface, line): the lines of a report, to be ordered by kind, then count from the greatest, reading and surface."""
    out = None
    for kind, t in kinds.items():
        part = t.select(F.lit(kind).alias("kind"), F.col("n").cast("long").alias("n"), "reading", "surface")
        out = part if out is None else out.unionByName(part)
    return out.withColumn("line", F.concat_ws("\t", "kind", F.col("n").cast("string"), "reading", "surface"))


def readings_by_surface(lines: DataFrame) -> DataFrame:
    """(surface, readings): the distinct readings of each surface, sorted."""
    return lines.groupBy("surface").agg(F.array_sort(F.collect_set("reading")).alias("readings"))


def readings_after(seed: DataFrame, more: DataFrame) -> DataFrame:
    """(surface, readings): the seed's readings (surface, readings), then the others' in their order, each once."""
    both = seed.select("surface", F.col("readings").alias("_a")).join(more.select("surface", F.col("readings").alias("_b")), "surface", "full")
    none = F.array().cast("array<string>")
    return both.select("surface", F.array_distinct(F.concat(F.coalesce("_a", none), F.coalesce("_b", none))).alias("readings"))
