"""A ranker of candidates: hashed features, softmax with AdaGrad, and a small model file.

Each epoch is one pass over the examples with the weights broadcast (their size is 2^bits floats), partial gradients on the
executors, one aggregate by feature and one step on the driver, whose state is the weight vector and doesn't grow with the data.
Steps are synchronous, so results don't depend on the order of rows; published per-example training isn't reproduced.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexforge.operators.units import in_order

BITS, RATE, EPOCHS, SMALLEST = 20, 0.5, 10, 1e-6
MAGIC = b"LXRANK01"


def examples(units: DataFrame, dictionary: DataFrame, bits: int = BITS, most: int = 9) -> DataFrame:
    """(k, i, features, correct): for each unit (k, i, reading, surface) with several candidates, one of them right, their features and the right one's place.

    Features are hashes of a candidate alone and with the units before it. Those that all candidates share say nothing and are dropped.
    """
    place = F.row_number().over(Window.partitionBy("reading").orderBy("cost", "surface"))
    tops = dictionary.withColumn("_p", place).filter(F.col("_p") <= most)
    candidates = tops.groupBy("reading").agg(F.transform(F.array_sort(F.collect_list(F.struct("_p", "surface"))), lambda x: x["surface"]).alias("candidates")).filter("size(candidates) > 1")
    w = in_order()
    context = units.select("k", "i", "reading", "surface", F.lag("surface").over(w).alias("a"), F.lag("surface", 2).over(w).alias("b"))
    rows = context.join(candidates, "reading").withColumn("correct", F.array_position("candidates", F.col("surface")).cast("int") - 1).filter("correct >= 0")
    bucket = lambda tag, *x: F.pmod(F.xxhash64(F.lit(tag), *x), F.lit(1 << bits)).cast("int")
    own = lambda c: F.array(bucket("c", c), bucket("ac", F.col("a"), c), bucket("bac", F.col("b"), F.col("a"), c), bucket("lc", F.length("a"), c), bucket("r", F.col("reading")))
    features = F.transform("candidates", own)
    shared = lambda fs: F.aggregate(fs, F.get(fs, 0), lambda a, x: F.array_intersect(a, x))
    return rows.withColumn("_f", features).select("k", "i", F.transform("_f", lambda f: F.array_except(f, shared(F.col("_f")))).alias("features"), "correct")


def gradients(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """(feature, g, loss): the summed gradient of the softmax loss by feature; feature -1 carries the loss."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, total, loss = shared.value, np.zeros(len(shared.value)), 0.0
        for batch in batches:
            for candidates, correct in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                score = np.array([w[f].sum() for f in candidates])
                p = np.exp(score - score.max())
                p /= p.sum()
                loss -= float(np.log(max(p[correct], 1e-300)))
                p[correct] -= 1
                for f, g in zip(candidates, p, strict=True):
                    np.add.at(total, f, g)
        at = np.flatnonzero(np.abs(total) > SMALLEST)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(total[at], loss))], ["feature", "g"])

    return rows.select("features", "correct").mapInArrow(run, "feature bigint, g double").groupBy("feature").agg(F.sum("g").alias("g"))


def train(rows: DataFrame, bits: int = BITS, epochs: int = EPOCHS, rate: float = RATE) -> tuple[np.ndarray, list[float]]:
    """The weights, and the loss before each epoch. `rows` should be a table, as each epoch reads it."""
    weights, squares, losses = np.zeros(1 << bits), np.zeros(1 << bits), []
    for _ in range(epochs):
        found = gradients(rows, weights).toPandas()  # at most 2^bits rows
        losses.append(float(found.loc[found["feature"] == -1, "g"].sum()))
        found = found[found["feature"] >= 0]
        at, g = found["feature"].to_numpy(), found["g"].to_numpy()
        squares[at] += g * g
        weights[at] -= rate * g / np.sqrt(squares[at] + 1e-12)
    return weights, losses


def write_model(weights: np.ndarray) -> bytes:
    """A header of 32 bytes (magic, bits, scale, checksum) and one signed byte for each weight."""
    scale = float(np.abs(weights).max()) / 127 or 1.0
    body = np.clip(np.round(weights / scale), -127, 127).astype(np.int8).tobytes()
    return struct.pack("<8sIId8s", MAGIC, int(len(weights)).bit_length() - 1, 0, scale, xxhash.xxh3_64_digest(body)) + body


def read_model(content: bytes) -> np.ndarray:
    magic, bits, _, scale, check = struct.unpack("<8sIId8s", content[:32])
    body = content[32:]
    if magic != MAGIC or len(body) != 1 << bits or xxhash.xxh3_64_digest(body) != check:
        raise ValueError("not a model, or a damaged one")
    return np.frombuffer(body, np.int8) * scale


def reranked(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """(k, i, rank): the rank of the right candidate by score; of equals the earlier one wins."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = shared.value
        for frame in batches:
            ranks = []
            for candidates, correct in zip(frame["features"], frame["correct"], strict=True):
                score = np.array([w[np.asarray(f, np.int64)].sum() for f in candidates])
                ranks.append(1 + int((score > score[correct]).sum() + (score[:correct] == score[correct]).sum()))
            yield pd.DataFrame({"k": frame["k"], "i": frame["i"], "rank": ranks})

    return rows.mapInPandas(run, "k string, i int, rank int")
