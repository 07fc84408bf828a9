"""A corpus pipeline: quality rules, language ID, near-dedup, secret scans and packing, each on what the stage before kept."""

from __future__ import annotations

import uuid

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexforge.llm import bagminhash, language_id, packing, quality_rules, secrets
from lexforge.llm.arrow import map_texts
from lexforge.runtime import ensure_checkpoint_dir, table

#: What stands in a text where a secret was.
MARK = "[secret]"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that pass the base rules and the thresholds of their language and source."""
    return quality_rules.filter_quality(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language can be told; `lang` becomes the predicted one."""
    found = language_id.predict(docs, language_id.train(docs)).filter(F.col("lang_pred") != language_id.UNKNOWN)
    return found.select(*[F.col("lang_pred").alias(c) if c == "lang" else F.col("doc").getField(c).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each class of near-duplicates, once; one without an id if none of the class has one."""
    heads = bagminhash.near_duplicates(docs).filter("node = head").select(F.col("class").alias("least"), "node").distinct()
    return bagminhash.rows_of(docs, heads).select("doc.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace each secret in the texts; `n_chars` follows. A null text stays null."""
    names = docs.columns
    common, rarer = secrets.word_lists(docs)
    rows = secrets.beside(docs.select(F.struct(*names).alias("doc"), F.col("text").alias("_text")), "_text", rarer)
    shared = spark.sparkContext.broadcast(common)

    def step(batch: pa.RecordBatch, texts: list[str]) -> dict:
        known = zip(texts, secrets.ranks_of(batch, shared.value), strict=True)
        return {"doc": batch.column(0), "clean": [secrets.redacted(t, MARK, r) for t, r in known]}

    out = map_texts(rows, "_text", StructType([rows.schema["doc"]]).add("clean", "string"), step)
    clean = F.when(F.col("doc.text").isNotNull(), F.col("clean"))
    new = {"text": clean, "n_chars": F.coalesce(F.length(clean).cast("long"), F.col("doc.n_chars"))}
    return out.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in names])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the texts into windows of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality), ("language ID", language), ("MinHash near-dedup", near_dedup), ("secret scans", secret_scan), ("packing", pack)]

#: SQL can't express the tokenizer, the signatures or the guess cost; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written to the shared folder and read again."""
    ensure_checkpoint_dir(spark)
    top = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{top}/pipeline-{uuid.uuid4().hex}-{name.replace(' ', '-')}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
