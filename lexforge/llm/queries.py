"""One query for each operator of this subpackage, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.llm import bagminhash, bpe, importance, language_id, licenses, packing, quality_rules, secrets, spotsigs, toxicity
from lexforge.llm.labelled import labelled_sample
from lexforge.llm.oracle import ORACLE
from lexforge.runtime import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe_pair_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = bpe.decode(bpe.encode(docs, BYTE_BPE), BYTE_BPE)
    return decoded.select(
        "doc_id",
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op2_adaptive_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _digest(kinds: tuple[str, ...]) -> F.Column:
    own = F.filter("spans", lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op4_secret_guess_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(k) for k in secrets.KINDS],
        F.sha2(F.encode(_digest(secrets.KINDS[:3]), "UTF-8"), 256).alias("base_sha256"),
        _digest(secrets.KINDS).alias("spans"),
    )


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE)


def op8_bagminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bagminhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("class").alias("class_id"))


def op9_word_first_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_id.predict(docs.select("doc_id", "text"), language_id.train(docs))
    return found.select("doc.doc_id", language_id.held_out("doc.doc_id").alias("held_out"), "lang_pred", "score")


def op3_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic"))
    found = toxicity.score(docs, model)
    return found.select(
        "doc_id",
        language_id.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("n_passages"),
    )


def op5_license_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").alias("first_word"),
        F.array_max("starts").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op7_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sample = labelled_sample(docs, table(spark, sf_dir, "labels"), "quality")
    return importance.resample(docs, sample).select("doc_id", language_id.held_out("doc_id").alias("held_out"), "log_weight", "selected")


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A text's own set serves as well for the document before it.
    rows = spotsigs.with_next(table(spark, sf_dir, "documents"), also={"s": spotsigs.signatures})
    rows = rows.withColumn("edited", spotsigs.edited(F.col("text"), F.col("next_text"))).withColumn("e", spotsigs.signatures(F.col("edited")))
    sets = {"e": "edited", "next_s": "next_text"}
    same = lambda v: F.when(F.col("text") == F.col(v), 1.0).otherwise(0.0)
    likeness = lambda k: F.coalesce(spotsigs.jaccard(F.col("s"), F.col(k)), same(sets[k]))
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        spotsigs.fingerprint(F.col("s")).alias("fingerprint"),
        spotsigs.fingerprint(F.col("e")).alias("edited_fingerprint"),
        likeness("e").alias("near_edited"),
        likeness("next_s").alias("near_next"),
    )


_ALL = (
    op1_bpe_pair_index,
    op2_adaptive_quality_rules,
    op3_toxic_segments,
    op4_secret_guess_cost,
    op5_license_expressions,
    op6_best_fit_packing,
    op7_importance_resampling,
    op8_bagminhash_near_dedup,
    op9_word_first_language,
    op10_spotsigs,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}
__all__ = ["ORACLE", "QUERIES"]
