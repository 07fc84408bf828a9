"""Where patterns stand in texts, what surrounds them, and what is new."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of all patterns up to which one automaton holds them on each executor: some 100 bytes for each.
AUTOMATON_CHARS = 2_000_000


def occurrences(docs: DataFrame, patterns: DataFrame, *, automaton_chars: int = AUTOMATON_CHARS) -> DataFrame:
    """(k, at, pattern, before, after): all places, overlapping ones too, where a pattern (pattern) stands in a text (k, text).

    `at` counts code points from 1; `before` and `after` are the neighbouring characters, null at the edges of the text. Patterns
    whose measured size is within `automaton_chars` are sent to all executors, where one pass of an automaton over each
    text finds them and nothing but the places found is shuffled later. Larger sets meet the texts' substrings of their lengths by
    equality; both ways give the same rows.
    """
    found = patterns.select("pattern").filter(F.length("pattern") > 0).distinct()
    size = found.agg(F.sum(F.length("pattern"))).first()[0] or 0
    if size <= automaton_chars:
        return _by_automaton(docs, [r["pattern"] for r in found.collect()])  # within the bound
    return _by_equality(docs, found)


def _by_automaton(docs: DataFrame, patterns: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(patterns)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for p in shared.value:
            automaton.add_word(p, p)
        automaton.make_automaton()
        names = ["k", "at", "pattern", "before", "after"]
        for batch in batches:
            for row in range(batch.num_rows if shared.value else 0):
                text = batch.column(1)[row].as_py() or ""
                hits = [(end + 1 - len(p), end + 1, p) for end, p in automaton.iter(text)]
                if hits:
                    columns = [pa.array([s + 1 for s, _, _ in hits], pa.int32()), pa.array([p for _, _, p in hits], pa.string()), pa.array([text[s - 1] if s else None for s, _, _ in hits], pa.string()), pa.array([text[e] if e < len(text) else None for _, e, _ in hits], pa.string())]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([row] * len(hits))), *columns], names)

    rows = docs.select("k", "text")
    return rows.mapInArrow(scan, f"k {dict(rows.dtypes)['k']}, at int, pattern string, before string, after string")


def _by_equality(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """Substrings of each length that occurs, each found by one linear pass of a lookahead, meet the patterns; both sides may grow."""
    lengths = sorted(r["n"] for r in patterns.select(F.length("pattern").alias("n")).distinct().collect())  # as many as the longest pattern has characters
    edged = F.concat(F.lit("\0"), F.col("text"), F.lit("\0"))  # so that each substring has a neighbour on both sides
    none = F.array().cast("array<struct<at:int,g:string>>")
    grams = lambda n: F.transform(F.regexp_extract_all(edged, F.lit(f"(?s)(?=(.{{{n + 2}}}))."), 1), lambda g, i: F.struct((i + 1).alias("at"), g.alias("g")))
    dealt = docs.select("k", F.length("text").alias("size"), F.explode(F.concat(none, *[grams(n) for n in lengths])).alias("x"))
    n = F.length("x.g") - 2
    rows = dealt.select("k", "x.at", F.substring("x.g", F.lit(2), n).alias("pattern"), F.when(F.col("x.at") > 1, F.substring("x.g", 1, 1)).alias("before"), F.when(F.col("x.at") + n <= F.col("size"), F.substring("x.g", n + 2, F.lit(1))).alias("after"))
    return rows.join(patterns, "pattern").select("k", "at", "pattern", "before", "after")


def sides(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, side, ch, n): the characters before and after each place, null at the edge of a text."""
    both = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("ch")) for s in ("before", "after")]))
    return occurrences(docs, patterns).select("pattern", both.alias("x")).groupBy("pattern", "x.side", "x.ch").agg(F.count("*").alias("n"))


def word_counts(docs: DataFrame, patterns: DataFrame, letter: str = "\\p{L}") -> DataFrame:
    """(pattern, n): how often each pattern stands as a whole word, with no letter on either side; patterns that don't occur count 0.

    A pattern of letters alone stands so where it's a whole run of letters, so the runs are counted and meet the patterns by equality.
    Only patterns with other characters are sought in the texts.
    """
    wanted = patterns.select("pattern").distinct()
    runs = docs.select(F.explode(F.regexp_extract_all("text", F.lit(f"((?:{letter})+)"), 1)).alias("pattern"))
    counts = runs.groupBy("pattern").agg(F.count("*").alias("n"))
    others = wanted.filter(~F.col("pattern").rlike(f"^(?:{letter})+\\z"))
    if not others.isEmpty():
        apart = lambda c: ~F.coalesce(F.col(c).rlike(letter), F.lit(False))
        counts = counts.unionByName(occurrences(docs, others).filter(apart("before") & apart("after")).groupBy("pattern").agg(F.count("*").alias("n")))
    return wanted.join(counts, "pattern", "left").select("pattern", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def entropy(counts: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """(keys, total, entropy): the entropy in bits of the counts of each group."""
    # -sum p log2 p = log2 N - sum(n log2 n) / N: one aggregate, no join with the totals.
    c = F.col(n).cast("double")
    return counts.groupBy(*keys).agg(F.sum(n).alias("total"), (F.log2(F.sum(c)) - F.sum(c * F.log2(c)) / F.sum(c)).alias("entropy"))


def novel(counts: DataFrame, new_chars: float, old_chars: float, ratio: float = 10.0) -> DataFrame:
    """The rows (new, old counts) whose rate in the new texts is at least `ratio` times that in the old ones, with one more occurrence assumed there."""
    return counts.filter(F.col("new") / max(new_chars, 1.0) >= ratio * (F.col("old") + 1) / max(old_chars, 1.0))
