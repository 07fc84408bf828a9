"""Quality by importance resampling: the ratio of two hashed n-gram models, sampled by Gumbel top-k.

The target model counts the hashed words and word pairs of good documents (a bounded labelled sample), the raw model those
of all documents. A document's log weight is the mean, over its n-grams, of the log ratio of both models. As n-grams depend on
each other, neither the mean nor the sum is the log of an odds ratio; a logistic curve fitted on the sample says how many
times the mean that is (`sharpness`). Documents are drawn without replacement in proportion to exp(sharpness * log weight), which is
taking the k largest of sharpness * log weight plus Gumbel noise. The noise comes from a hash of the id and the text, so a draw can be repeated,
and k is the share of good rows among the labelled ones, at the upper end of its 95 % interval (Wilson's), so that a share that
the sample shows too low costs no good documents. The k-th largest key is found exactly by counting digits, without sorting rows.

Defined results: a null or empty text has no n-grams and log weight 0, a neutral one; documents whose keys equal the k-th
are all taken, so repeated rows go together; without good labelled rows all weights are 0; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.llm.arrow import blocks, map_texts
from lexforge.llm.bagminhash import mix
from lexforge.llm.labelled import fit_curve
from lexforge.runtime import materialize

BUCKETS, SMOOTHING = 10_000, 1.0
#: Standard deviations of the interval of the share of good labels.
Z = 1.96
TOKENS = re.compile(r"\w+|[^\w\s]+")
_seen: dict[str, int] = {}


def grams(text: str) -> np.ndarray:
    """The buckets of the words and word pairs of a text."""
    tokens = TOKENS.findall(text)
    if len(_seen) > 500_000:
        _seen.clear()
    for t in {t for t in tokens if t not in _seen}:
        _seen[t] = xxhash.xxh3_64_intdigest(t)
    h = np.fromiter(map(_seen.__getitem__, tokens), np.uint64, len(tokens))
    pairs = mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) if len(h) > 1 else h[:0]
    return (np.concatenate((h, pairs)) % np.uint64(BUCKETS)).astype(np.int64)


def gram_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts by bucket over all documents: a vector of fixed size from each task, added up."""
    rows = docs.select(F.col(text_col).alias("text"))

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for _, texts in blocks(batches, "text"):
            for t in texts:
                total += np.bincount(grams(t), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for r in rows.mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """The log ratio of both smoothed models; 0 everywhere if either has seen nothing."""
    if not target.sum() or not raw.sum():
        return np.zeros(BUCKETS)
    p = (target + SMOOTHING * raw / raw.sum() * BUCKETS) / (target.sum() + SMOOTHING * BUCKETS)
    q = (raw + 1e-9) / raw.sum()
    return np.where(raw > 0, np.log(np.maximum(p, 1e-12) / q), 0.0)


def upper_share(good: int, n: int, z: float = Z) -> float:
    """The upper end of Wilson's interval of a share."""
    p = good / n
    return min(1.0, (p + z * z / (2 * n) + z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n))


def sharpness(sample: DataFrame, ratio: np.ndarray) -> float:
    """The slope of the log odds of a good label over the log weight; 1 without labels of both kinds or where good texts don't weigh more."""
    shared = sample.sparkSession.sparkContext.broadcast(ratio)

    def step(batch: pa.RecordBatch, texts: list[str]) -> dict:
        return {"label": batch.column(1), "w": [float(shared.value[g].mean()) if len(g := grams(t)) else 0.0 for t in texts]}

    known = map_texts(sample.select("text", F.col("label").cast("int").alias("label")), "text", "label int, w double", step).toArrow()  # as many rows as the sample at most
    y, w = (known.column("label").to_numpy() == 1).astype(float), known.column("w").to_numpy()
    if len(y) == 0 or y.min() == y.max():
        return 1.0
    scale = max(float(w.std()), 1e-9)
    return max(1.0, fit_curve((w - w.mean()) / scale, y)[0] / scale)


def weigh(docs: DataFrame, ratio: np.ndarray, sharp: float, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, log_weight, key) of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def step(batch: pa.RecordBatch, texts: list[str]) -> dict:
        weights = [float(shared.value[g].mean()) if len(g := grams(t)) else 0.0 for t in texts]
        keys = []
        for i, t, w in zip(batch.column(0).to_pylist(), texts, weights, strict=True):
            u = ((xxhash.xxh3_64_intdigest(f"{i}\n{t}") >> 11) + 0.5) * 2.0**-53
            keys.append(sharp * w - math.log(-math.log(u)))
        return {"id": batch.column(0), "log_weight": weights, "key": keys}

    return map_texts(rows, "text", f"id {dict(rows.dtypes)['id']}, log_weight double, key double", step).withColumnRenamed("id", id_col)


def kth_largest(rows: DataFrame, column: str, k: int) -> int | None:
    """The code of the k-th largest value, exactly: four rounds, each counting the next 16 bits of an order-preserving code."""
    code = code_of(F.col(column))
    now, prefix = rows.select(code.alias("c")), 0
    left = k
    for shift in (48, 32, 16, 0):
        digit = F.shiftrightunsigned("c", shift).bitwiseAND(F.lit(0xFFFF))
        counts = {r["d"]: r["n"] for r in now.groupBy(digit.alias("d")).agg(F.count("*").alias("n")).collect()}  # 65,536 rows at most
        for d in sorted(counts, reverse=True):
            if left <= counts[d]:
                break
            left -= counts[d]
        else:
            return None
        prefix = prefix << 16 | d
        now = now.filter(digit == d)
    return prefix


def code_of(x: F.Column) -> F.Column:
    """A non-negative long in the order of a double between -1024 and 1024, to 2^-42; keys are far inside."""
    return F.floor((F.greatest(F.least(x, F.lit(1024.0)), F.lit(-1024.0)) + 1024.0) * 2.0**42).cast("long")


def resample(docs: DataFrame, sample: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, log_weight, key, selected) of each document; `sample` has (text, label), label 1 for good texts."""
    shares = sample.agg(F.count("*").alias("n"), F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("good")).first()
    ratio = log_ratio(gram_counts(sample.filter("label = 1")), gram_counts(docs, text_col))
    rows = materialize(weigh(docs, ratio, sharpness(sample, ratio), id_col=id_col, text_col=text_col))
    k = math.ceil(rows.count() * upper_share(shares["good"], shares["n"])) if shares["good"] else 0
    least = kth_largest(rows, "key", k) if k else None
    selected = code_of(F.col("key")) >= F.lit(least).cast("long") if least is not None else F.lit(False)
    return rows.withColumn("selected", selected)
