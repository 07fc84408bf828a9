"""Unit counts of arriving documents by kind: documents may come late or twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.operators import units

SCHEMA = "doc_id string, source_id string, text string, retrieved_at timestamp"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON Lines files as they arrive."""
    return spark.readStream.schema(SCHEMA).json(path)


def counts_by_kind(documents: DataFrame, late: str = "1 day", window: str = "1 day") -> DataFrame:
    """(window, kind, docs, units) of each window of arrival; a document that comes again within the delay counts once. State older than the delay goes."""
    once = documents.withWatermark("retrieved_at", late).dropDuplicatesWithinWatermark(["doc_id"])
    n = F.size(F.regexp_extract_all("text", F.lit(units.TOKEN), 1))
    rows = once.select("retrieved_at", F.substring_index("doc_id", ":", 1).alias("kind"), n.alias("n"))
    return rows.groupBy(F.window("retrieved_at", window), "kind").agg(F.count("*").alias("docs"), F.sum("n").alias("units"))
