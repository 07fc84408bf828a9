"""Quality rules whose thresholds adapt to each language and source.

Every document gets a few ratios. Each ratio is counted into logarithmic buckets of 2 % width for each language and source:
a quantile sketch with a relative error of at most 1 % whose merge is the addition of counts, so it doesn't depend on the
order of rows, tasks or retries, and holds at most about 700 buckets whatever the number of documents. The sketches
of a language's sources merge into the language's, and those into one of everything. A document is compared with
q75 + 3 * (q75 - q25) of its own group's sketch, plus a slack for ratios that hardly vary; a group of fewer documents than
`MIN_DOCS` is judged by its language, a small language by the whole. Documents join their group's thresholds and
keep those within all of them.

Only DataFrame functions are used. Defined results: a null text has no words and fails the base rules, as an empty one
does; a null language or source is a group of its own; repeated rows are judged each on their own and alike; an empty
table gives an empty result; columns other than the four named ones are carried by `filter_quality` and never read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.runtime import materialize

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
GAMMA = math.log(1.02)
TINY = 1e-6
MIN_DOCS = 100
SPREAD = 3.0
#: Ratios that have an upper threshold, each with the slack that is always allowed above the fence.
SLACK = {"r_symbols": 0.1, "r_upper": 0.1, "r_exclaim": 0.1, "r_adjacent": 0.1, "r_repeat": 0.25, "r_dup_lines": 0.35}
#: Groups up to this many are sent to all executors (a row is under 100 bytes); beyond it the join is salted.
MAX_BROADCAST_GROUPS = 20_000
SALTS = 16


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def measure(text: Column) -> Column:
    """A struct of the base counts and the ratios of a whole text."""
    white = lambda x: F.translate(x, WHITE, "")
    pick = lambda xs, k: F.get(xs, k)

    def places(s: Column) -> Column:
        """The places of windows that occur twice, in order, from the windows' (hash, place) in order."""
        equal = lambda a, b: F.coalesce(pick(s, a)["h"] == pick(s, b)["h"], F.lit(False))
        twice = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: equal(k, k - 1) | equal(k, k + 1))
        return F.array_sort(F.transform(twice, lambda k: pick(s, k)["i"]))

    def covered(p: Column) -> Column:
        gaps = F.transform(F.sequence(F.lit(0), F.size(p) - 2), lambda k: F.least(F.lit(WINDOW), pick(p, k + 1) - pick(p, k)))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x) + WINDOW

    def repeated(win: Column) -> Column:
        # Equal windows stand next to each other once sorted with their places; texts without any skip the sort.
        by_hash = F.array_sort(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(win)) < F.size(win), let(let(by_hash, places), covered)).otherwise(0)

    def of_hashes(h: Column) -> Column:
        window = lambda i: F.xxhash64(*[pick(h, i + k) for k in range(WINDOW)])
        windows = F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), window)
        adjacent = F.size(F.filter(F.sequence(F.lit(1), F.size(h) - 1), lambda i: pick(h, i) == pick(h, i - 1)))
        return F.struct(
            F.size(h).cast("long").alias("n_words"),
            F.when(F.size(h) >= WINDOW, let(windows, repeated)).otherwise(0).cast("long").alias("n_repeat_words"),
            F.when(F.size(h) > 1, adjacent).otherwise(0).alias("adjacent"),
        )

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).alias("lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    def of_text(t: Column) -> Column:
        hashes = F.transform(F.filter(F.split(t, "[\\x20\\x09-\\x0D]+"), lambda w: w != ""), lambda w: F.xxhash64(w))
        lines = F.filter(F.split(t, "\n"), lambda x: F.length(white(x)) > 0)
        without = lambda drop: F.length(t) - F.length(F.translate(t, drop, ""))
        return F.struct(
            let(hashes, of_hashes).alias("w"),
            let(lines, of_lines).alias("l"),
            F.length(white(t)).cast("long").alias("word_chars"),
            without(SYMBOLS).cast("long").alias("n_symbols"),
            without("!").alias("exclaim"),
            (F.length(t) - F.length(F.regexp_replace(t, "\\p{Lu}", ""))).alias("upper"),
        )

    def whole(m: Column) -> Column:
        of = lambda a, b: a / F.greatest(b, F.lit(1))
        n, repeat = m["w"]["n_words"], m["w"]["n_repeat_words"]
        return F.struct(
            n.alias("n_words"),
            m["word_chars"].alias("word_chars"),
            m["n_symbols"].alias("n_symbols"),
            m["l"]["n_dup_lines"].alias("n_dup_lines"),
            repeat.alias("n_repeat_words"),
            ((n < 20) | (100 * repeat > 30 * n)).alias("base_failed"),
            of(m["n_symbols"], n).alias("r_symbols"),
            of(m["upper"], m["word_chars"]).alias("r_upper"),
            of(m["exclaim"], n).alias("r_exclaim"),
            of(m["w"]["adjacent"], n).alias("r_adjacent"),
            of(repeat, n).alias("r_repeat"),
            of(m["l"]["n_dup_lines"], m["l"]["lines"]).alias("r_dup_lines"),
        )

    return let(let(F.coalesce(text, F.lit("")), of_text), whole)


def measured(df: DataFrame, text: Column) -> DataFrame:
    """Add the base counts and the ratios of each whole text as columns."""
    # rand() is below 2, always: it only keeps the optimiser from computing the struct again in filters on its fields.
    m = df.withColumn("_m", F.when(F.rand() < 2, measure(text)))
    return m.select(*df.columns, "_m.*")


def sketches(rows: DataFrame) -> DataFrame:
    """(level, lang, source, rule, bucket, n): mergeable quantile sketches of each ratio by group, language and all."""
    ratios = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("x")) for r in SLACK]))
    bucket = F.when(F.col("r.x") <= TINY, -(10**6)).otherwise(F.ceil(F.log(F.col("r.x")) / GAMMA)).cast("int")
    counts = rows.select("lang", "source", ratios.alias("r")).select("lang", "source", "r.rule", bucket.alias("bucket"))
    counts = counts.groupBy("lang", "source", "rule", "bucket").agg(F.count("*").alias("n"))
    level = F.explode(F.array(*[F.lit(k) for k in (0, 1, 2)]))
    up = counts.withColumn("level", level).withColumn("source", F.when(F.col("level") == 0, F.col("source"))).withColumn("lang", F.when(F.col("level") < 2, F.col("lang")))
    return up.groupBy("level", "lang", "source", "rule", "bucket").agg(F.sum("n").alias("n"))


def thresholds(rows: DataFrame) -> DataFrame:
    """(level, lang, source, docs, limits): the upper limit of each ratio, from the sketches of the rows that pass the base rules."""
    from pyspark.sql import Window

    group = ["level", "lang", "source", "rule"]
    by = Window.partitionBy(*group)
    s = sketches(rows.filter(~F.col("base_failed")))
    s = s.withColumn("total", F.sum("n").over(by)).withColumn("below", F.sum("n").over(by.orderBy("bucket")))
    value = F.when(F.col("bucket") == -(10**6), 0.0).otherwise(2 * F.exp(F.col("bucket") * GAMMA) / (1 + math.exp(GAMMA)))
    at = lambda q: F.min(F.when(F.col("below") >= q * F.col("total"), value))
    limits = s.groupBy(*group).agg(F.first("total").alias("docs"), at(0.25).alias("q25"), at(0.75).alias("q75"))
    slack = F.create_map(*[x for k, v in SLACK.items() for x in (F.lit(k), F.lit(v))])
    fence = F.col("q75") + SPREAD * (F.col("q75") - F.col("q25")) + slack[F.col("rule")]
    one = [F.max(F.when(F.col("rule") == r, fence)).alias(f"max_{r}") for r in SLACK]
    return limits.groupBy("level", "lang", "source").agg(F.max("docs").alias("docs"), *one)


def judged(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Join each measured row with the limits of the first of its group, language and whole that has enough documents, and add `kept`."""
    limits = materialize(limits)
    groups = limits.filter("level = 0").select("lang", "source", "docs", *[F.col(f"max_{r}").alias(f"g_{r}") for r in SLACK])
    langs = limits.filter("level = 1").select("lang", F.col("docs").alias("lang_docs"), *[F.col(f"max_{r}").alias(f"l_{r}") for r in SLACK])
    # One row for each language and source: the limits that hold there.
    whole = limits.filter("level = 2").first()  # one row, or none
    table = groups.alias("g").join(langs.alias("l"), F.col("g.lang").eqNullSafe(F.col("l.lang")))
    own, by_lang = F.col("docs") >= MIN_DOCS, F.col("lang_docs") >= MIN_DOCS
    table = table.select(F.col("g.lang").alias("t_lang"), F.col("g.source").alias("t_source"), *[F.when(own, F.col(f"g_{r}")).when(by_lang, F.col(f"l_{r}")).otherwise(F.lit(whole and whole[f"max_{r}"])).alias(f"max_{r}") for r in SLACK])
    same = F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source"))
    if groups.count() <= MAX_BROADCAST_GROUPS:
        joined = rows.join(F.broadcast(table), same, "left")
    else:
        salted = table.withColumn("t_salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("word_chars", "n_words", "n_symbols"), F.lit(SALTS)).cast("int")).join(salted, same & (F.col("salt") == F.col("t_salt")), "left").drop("salt", "t_salt")
    # A group whose documents all fail the base rules has no limits; none of its documents is kept.
    within = F.lit(True)
    for r in SLACK:
        within &= F.coalesce(F.col(r) <= F.col(f"max_{r}"), F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & within).drop("t_lang", "t_source", *[f"max_{r}" for r in SLACK])


def quality(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(id, counts, ratios, base_failed, kept), one row for each document; texts are read once."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("_text"))
    rows = materialize(measured(rows, F.col("_text")).drop("_text"))
    return judged(rows, thresholds(rows)).withColumnRenamed("id", id_col).drop("lang", "source")


def filter_quality(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The documents that are kept, with all their columns.

    Texts are measured once; the verdicts, by id, language, source and text, meet the documents in a join whose keys
    hardly repeat, so that copies of one text don't land in one task.
    """
    names = docs.columns
    parts = [F.sha2(F.coalesce(F.col(c).cast("string"), F.lit("\0")), 256) for c in (lang_col, source_col, text_col)]
    key = F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_doc"), F.xxhash64(F.col(id_col)).alias("a"), key.alias("b"))
    rows = packed.select("a", "b", F.col("_doc")[lang_col].alias("lang"), F.col("_doc")[source_col].alias("source"), F.col("_doc")[text_col].alias("_text"))
    rows = materialize(measured(rows, F.col("_text")).drop("_text"))
    kept = judged(rows, thresholds(rows)).filter("kept").select("a", "b").distinct()
    return packed.join(kept, ["a", "b"], "left_semi").select("_doc.*")
