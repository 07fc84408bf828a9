"""Document fingerprints by SpotSigs: chains of content words that follow common words.

Words are runs of letters and digits in lower case. A signature is a common word (the nearest, if several stand in a row) with the
`CHAIN` content words after it, other common words skipped; it doesn't change when boilerplate without running prose does.
A text in which no common word stands takes a chain at each word. A fingerprint is the set of its signatures, sorted,
and the likeness of two is the Jaccard similarity of the sets. `similar` finds all pairs of at least
a threshold: sets are partitioned by length so that only neighbouring partitions can reach it, joined on the rarest signatures of each
set, pruned by length, and compared in full.

Only DataFrame functions are used. Defined results: a null text counts as empty; a text without words has no signatures
and the likeness of two such texts is 1 if the texts are equal, else 0; the next document of the last one is the first; of
documents with the same id, the one with the smaller text comes first, and null ids come first of all, in the order of their texts'
xxhash64; ids may be numbers or strings; repeated rows are each other's next; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from os.path import commonprefix

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from lexforge.runtime import materialize

CHAIN = 3
#: Common words of four languages.
ANCHORS = """a an and are as at be by for from in is it of on or that the this to was with
das dem den der des die ein eine für im ist mit nicht und von zu auf als
au avec dans de du en est et la le les par pas pour que qui sur un une ou
al con del el es lo los las no para por se su una y""".split()
MARK = "\x01"
#: Rows of the id order that a block holds, about, once there are more blocks than a few for each shuffle partition.
BLOCK_ROWS = 100_000


def _one_of(words: list[str]) -> str:
    """A pattern of any of the words, by their first characters, so that other words are left at once."""
    heads: dict[str, list[str]] = {}
    for w in words:
        heads.setdefault(w[:1], []).append(w[1:])
    parts = [head + _one_of(tails) for head, tails in heads.items() if head]
    return f"(?:{'|'.join(parts)}){'?' if '' in heads else ''}" if parts else ""


def signatures(text: Column) -> Column:
    """The sorted distinct signatures of a text: the first 8 hexadecimal digits of the MD5 of each chain."""
    words = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+", " ")), F.lit(" "))
    # A common word and the space after it become the word and a mark, so that each content word carries those before it.
    marked = F.regexp_replace(words, f"(?<= )({_one_of(list(dict.fromkeys(ANCHORS)))}) ", f"$1{MARK}")
    spots = F.filter(F.split(marked, " "), lambda x: (F.length(x) > 0) & ~x.endswith(MARK))

    def chains(tokens: Column) -> Column:
        plain = F.transform(tokens, lambda x: F.substring_index(x, MARK, -1))
        anchored = F.exists(tokens, lambda x: x.contains(MARK))
        pick = F.transform(tokens, lambda x, i: F.when(x.contains(MARK) | ~anchored, i))
        heads = F.transform(tokens, lambda x: F.substring_index(x, MARK, -2))
        chain = lambda p, h, i: F.substring(F.md5(F.concat_ws(" ", F.get(h, i), *[F.coalesce(F.get(p, i + k), F.lit("")) for k in range(1, CHAIN)])), 1, 8)
        bound = F.struct(plain.alias("p"), heads.alias("h"), F.filter(pick, lambda i: i.isNotNull()).alias("i"))
        return F.get(F.transform(F.array(bound), lambda b: F.array_sort(F.array_distinct(F.transform(b["i"], lambda i: chain(b["p"], b["h"], i))))), F.lit(0))

    return F.get(F.transform(F.array(spots), chains), F.lit(0))


def fingerprint(signatures: Column) -> Column:
    """A set of signatures as text, in order."""
    return F.array_join(signatures, "")


def jaccard(a: Column, b: Column) -> Column:
    """The Jaccard similarity of two sets; null if both are empty. Sets that one empty side prunes aren't intersected."""
    shared = F.size(F.array_intersect(a, b))
    least = F.least(F.size(a), F.size(b))
    return F.when(F.greatest(F.size(a), F.size(b)) == 0, None).when(least == 0, 0.0).otherwise(shared / (F.size(a) + F.size(b) - shared))


def _order_key(docs: DataFrame, id_col: str) -> Column:
    """A number that rises with the id (null for null): integers as they are, other numbers as doubles, and of strings the 7 bytes after what all ids start with."""
    kind, own = docs.schema[id_col].dataType, F.col(id_col)
    if isinstance(kind, IntegralType):
        return own.cast("long")
    if not isinstance(kind, StringType):
        return own.cast("double")
    ends = docs.agg(F.min(own).alias("a"), F.max(own).alias("b")).first()
    shared = len(commonprefix([(ends["a"] or "").encode(), (ends["b"] or "").encode()]))
    return F.conv(F.rpad(F.hex(F.substring(F.encode(own, "UTF-8"), shared + 1, 7)), 14, "0"), 16, 10).cast("long")


def _count_at_most(cuts: list, key: Column, kind: str) -> Column:
    """How many of the ascending cuts are at or below a key, by halving; the cuts are one folded literal, so the expression's size is that of their number."""
    cut = F.split(F.lit(",".join(map(str, cuts))), ",").cast(f"array<{kind}>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    # A place beyond the last cut gives null, which isn't at or below anything.
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.get(cut, at + step - 1) <= key, step).otherwise(0))


def with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", also: dict[str, Callable[[Column], Column]] | None = None, blocks: int | None = None) -> DataFrame:
    """(id, text, next_text): the text of the next document by id, null texts as empty; for each of `also`, what it makes of both texts, as name and next_name.

    Ids are cut into blocks at quantiles, rows without an id by the hash that orders them; there are a few blocks for each
    shuffle partition, and more once a block would hold over `BLOCK_ROWS` rows. The first document of a block is also
    dealt to the block before it, and the first of all to the last block, so each block finds its rows' next ones alone and texts are
    shuffled once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"), _order_key(docs, id_col).alias("key"))
    kind = dict(rows.dtypes)["key"]
    size = rows.agg(F.count("*").alias("n"), F.count("key").alias("known")).first()
    if not size["n"]:
        return rows.select(F.col("id").alias(id_col), "text", F.col("text").alias("next_text"), *[make(F.col("text")).alias(p + k) for k, make in (also or {}).items() for p in ("", "next_")])
    wanted = lambda n: min(n, blocks or max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BLOCK_ROWS)))
    unknown, known = wanted(size["n"] - size["known"]), wanted(size["known"])
    cuts = []
    if known > 1:
        shares = F.split(F.lit(",".join(str(i / known) for i in range(1, known))), ",").cast("array<double>")
        cuts = rows.agg(F.percentile_approx("key", shares, max(10_000, 4 * known)).alias("q")).first()["q"]
    cuts = sorted(set(cuts))
    by_hash = F.floor((F.col("hash") / F.lit(2.0**64) + 0.5) * unknown).cast("int")
    by_key = F.lit(unknown) + (_count_at_most(cuts, F.col("key"), kind) if cuts else F.lit(0))
    rows = rows.withColumn("hash", F.when(F.col("key").isNull(), F.xxhash64("text")).otherwise(0))
    blocked = rows.withColumn("block", F.when(F.col("key").isNull(), F.least(by_hash, F.lit(unknown - 1))).otherwise(by_key))
    # A row for each block that has any: the order of its first document, and the block before it (of the first one, the last).
    firsts = blocked.groupBy("block").agg(F.min(F.struct("key", "hash")).alias("first"))
    firsts = sorted((r["block"], r["first"]["key"], r["first"]["hash"]) for r in firsts.collect())
    before = [(key, h, firsts[i - 1][0] if i else firsts[-1][0], int(i == 0)) for i, (_, key, h) in enumerate(firsts)]
    handed = spark.createDataFrame(before, f"f_key {kind}, f_hash long, f_block int, f_late int")
    blocked = blocked.withColumns({k: make(F.col("text")) for k, make in (also or {}).items()})
    carried = ["id", "text", *(also or {}), "key", "hash"]
    same = F.col("key").eqNullSafe(F.col("f_key")) & (F.col("hash") == F.col("f_hash"))
    met = blocked.join(F.broadcast(handed), same, "left")
    own = F.struct(F.col("block"), F.lit(0).alias("late"), F.lit(False).alias("ghost"))
    ghost = F.struct(F.col("f_block").alias("block"), F.col("f_late").alias("late"), F.lit(True).alias("ghost"))
    dealt = met.select(*carried, F.explode(F.when(F.col("f_block").isNull(), F.array(own)).otherwise(F.array(own, ghost))).alias("to"))
    dealt = dealt.select(*carried, "to.block", "to.late", "to.ghost")
    order = Window.partitionBy("block").orderBy("late", "key", "id", "hash", "text")
    # The last of all, if it is alone, has itself as next one.
    following = {f"next_{k}": F.coalesce(F.lead(k).over(order), k) for k in ("text", *(also or {}))}
    out = dealt.withColumns(following).filter("not ghost")
    return out.select(F.col("id").alias(id_col), "text", "next_text", *[p + k for k in also or {} for p in ("", "next_")])


def edited(text: Column, following: Column) -> Column:
    """The last half of a text's code points replaced by the first as many, or all, of the following one."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def similar(docs: DataFrame, threshold: float = 0.8, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, likeness): all pairs of different fingerprints with at least the threshold, by the smallest id of each; empty sets have none."""
    own = docs.select(F.col(id_col).alias("id"), signatures(F.col(text_col)).alias("s"))
    sets = materialize(own.filter(F.size("s") > 0).groupBy("s").agg(F.min("id").alias("id")).withColumn("n", F.size("s")))
    spread = sets.select("id", "n", F.explode("s").alias("sig"))
    common = spread.groupBy("sig").agg(F.count("*").alias("df"))
    rank = Window.partitionBy("id").orderBy("df", "sig")
    prefix = F.col("n") - F.ceil(threshold * F.col("n") - 1e-9) + 1
    # Lengths n and m can only reach the threshold if their partitions are the same or neighbours.
    part = F.floor(F.log(F.col("n")) / -math.log(threshold)).cast("int")
    keys = spread.join(common, "sig").withColumn("r", F.row_number().over(rank)).filter(F.col("r") <= prefix).withColumn("part", part).select("id", "n", "sig", "part")
    left = keys.select(F.col("id").alias("a"), F.col("n").alias("na"), "sig", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    right = keys.select(F.col("id").alias("b"), F.col("n").alias("nb"), "sig", "part")
    reach = F.col("na") >= threshold * F.col("nb") - 1e-9
    met = left.join(right, ["sig", "part"]).filter(((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))) & reach).select("a", "b").distinct()
    full = met.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    return full.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), jaccard(F.col("sa"), F.col("sb")).alias("likeness")).filter(F.col("likeness") >= threshold)
