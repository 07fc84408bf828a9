"""Documents that every operator has to take, and checks that all share."""

import random

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType()), StructField("n_chars", LongType())])
WORDS = "the river of stone and a quiet house by green light was under old trees with seven birds that sang for rain in autumn while nobody came to hear it again".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (r.choice("abcdefgh") * 2 if r.random() < 0.4 else "") + (r.choice([".\n", ", ", ""]) if r.random() < 0.1 else "") for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    base = prose(1, 80)
    rows = [(i, prose(i, 40 + i), ["en", "de"][i % 2], "src0" if i % 3 else "src1", 1) for i in range(2, 30)]
    rows += [(100, None, "en", "src0", None), (101, "", None, None, 0), (102, " \n\t ", "en", None, 4), (103, base, None, "src0", 1), (103, base, None, "src0", 1), (104, base, "de", "src1", 1)]
    rows += [(None, "no id here", "en", "src0", 1), (105, prose(7, 6000), "en", "src0", 1), (106, "x" * 50_000, "en", "src0", 1), (107, "日本語 ñ é 😀 " * 9, "fr", "src2", 1), (108, "a", "en", "src0", 1)]
    return rows


def frame(spark, rows, parts: int = 3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def clashing(df):
    """Extra columns with names that operators use inside."""
    names = "node size bands bucket class ids key score spans rank shard kept base_failed n_words id lang_pred label u v k word r_symbols _id _node _least _text _doc _m doc text_ lang_ a b least f_key block late to unknown quality toxic".split()
    return df.select("*", *[F.lit("clash").alias(n) for n in names])


def same_rows(a, b) -> bool:
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def check_robust(spark, operator, rows_out=None):
    """`operator` takes the odd rows, extra columns and an empty table; other partitions and columns don't change its result."""
    rows = odd_rows()
    first = operator(frame(spark, rows)).cache()
    assert first.count() == (len(rows) if rows_out is None else rows_out)
    assert same_rows(first, operator(clashing(frame(spark, rows, 5))))
    assert operator(frame(spark, [])).count() == 0
    return first
