"""Toxic passages as maximum-scoring segments of token log-odds.

Training counts the toxic and other labelled documents of each word (in a bounded sample). A word's log-odds has a Dirichlet prior
in proportion to its overall frequency, and is shrunk towards 0 by 1.96 standard deviations, so that rare words say
nothing. With a small constant taken off every word, an ordinary text's running sum falls, and toxic passages are segments
of high sum. A word that repeats the one before it adds nothing. One linear scan finds all maximal segments: each word that adds starts a candidate, which absorbs earlier ones while that
raises its sum. For random text the best segment's sum has an extreme-value distribution with parameters lambda and K;
lambda is the root of sum p(w) exp(lambda s(w)) = 1 over ordinary words, and K follows from the best segments of the sample's
ordinary texts, as lambda S - ln n has mean ln K + 0.5772 (Euler's constant). A segment is significant if its expected number in
a random text of that length, K n exp(-lambda S), is below `EXPECT`. A document's evidence is the sum of the
normalised scores of its significant segments, or of its best one, and a logistic curve fitted on the sample turns it into the score.

Defined results: a null or empty text, or one without words, has no segments and the lowest score; repeated rows score
alike; ties between segments don't change any result; without labelled rows of both kinds every score is next to 0; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.llm.arrow import map_texts
from lexforge.llm.labelled import fit_curve
from lexforge.runtime import materialize

WORDS = re.compile(r"\w+")
EULER = 0.5772156649015329
#: Evidence outside these says nothing more.
REACH = (-10.0, 60.0)
#: The prior's weight as a share of all counts, deviations that log-odds are shrunk by, what each word costs, and the expected number of chance segments.
PRIOR_SHARE, Z, DRIFT, EXPECT = 0.1, 1.96, 0.1, 0.01


class Model:
    """Word scores, extreme-value parameters and the logistic curve."""

    def __init__(self, scores: dict[str, float], lam: float, log_k: float = 0.0):
        self.scores, self.lam, self.log_k = scores, lam, log_k
        self.slope, self.shift = 0.0, -50.0

    def segments(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """The number of words, and the maximal segments (first word, end, sum)."""
        get, words = self.scores.get, WORDS.findall(text.lower())
        own = np.fromiter((get(w, 0.0) for w in words), float, len(words)) - DRIFT
        # Training counts a word once for each document; at once repeated, it says nothing more.
        for i in np.flatnonzero(own > 0).tolist():
            if i and words[i] == words[i - 1]:
                own[i] = -DRIFT
        sums = np.concatenate(([0.0], np.cumsum(own)))
        # Candidates keep the sums before (l) and after (r) them; `below` is the nearest earlier one with a smaller l.
        found: list[list] = []
        below: list[int] = []
        for i in np.flatnonzero(own > 0).tolist():
            first, l, r = i, sums[i], sums[i + 1]
            j = len(found) - 1
            while True:
                while j >= 0 and found[j][2] >= l:
                    j = below[j]
                if j < 0 or found[j][3] >= r:
                    break
                first, l = found[j][0], found[j][2]
                del found[j:], below[j:]
                j -= 1
            found.append([first, i + 1, l, r])
            below.append(j)
        return len(words), [(s, e, float(r - l)) for s, e, l, r in found]

    def passages(self, text: str) -> tuple[list[tuple[int, int, float]], float]:
        """The significant segments with their normalised scores, and the document's evidence."""
        n, found = self.segments(text)
        if not found:
            return [], REACH[0]
        floor = self.log_k + math.log(n)
        scored = [(s, e, self.lam * v - floor) for s, e, v in found]
        kept = [x for x in scored if x[2] > -math.log(EXPECT)]
        return kept, sum(x[2] for x in kept) if kept else max(x[2] for x in scored)

    def score(self, evidence: float) -> float:
        z = self.slope * max(REACH[0], min(evidence, REACH[1])) + self.shift
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def _lambda(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive root of sum share * exp(lambda * score) = 1."""
    low, high = 1e-6, 1.0
    f = lambda x: float((share * np.exp(np.minimum(x * scores, 500))).sum()) - 1
    while f(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return low


def train(sample: DataFrame) -> Model:
    """Fit on (text, label) rows; the counts are made on the executors, and what comes back is bounded by the model and the sample."""

    def count(batches):
        from collections import Counter

        counts = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[label == 1].update(set(WORDS.findall((text or "").lower())))
        words = list(counts[0].keys() | counts[1].keys())
        for s in range(0, len(words), 50_000):
            part = words[s : s + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *(pa.array([c[w] for w in part], pa.int64()) for c in counts)], ["word", "n0", "n1"])

    counts = materialize(sample.mapInArrow(count, "word string, n0 bigint, n1 bigint").groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))
    total = counts.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).first()
    n0, n1 = total["n0"] or 0, total["n1"] or 0
    if not n0 or not n1:
        return Model({}, 1.0)
    prior = PRIOR_SHARE * (n0 + n1)
    a = PRIOR_SHARE * (F.col("n0") + F.col("n1"))
    odds = lambda n, whole: F.log((n + a) / (whole + prior - n - a))
    delta = odds(F.col("n1"), n1) - odds(F.col("n0"), n0)
    deviation = F.sqrt(1 / (F.col("n1") + a) + 1 / (F.col("n0") + a))
    shrunk = F.signum(delta) * F.greatest(F.lit(0.0), F.abs(delta) - Z * deviation)
    found = counts.select("word", "n0", shrunk.alias("s")).filter("s <> 0").orderBy("word").collect()  # words of the sample that tell the labels apart
    scores = {r["word"]: r["s"] for r in found}
    values = np.array([r["s"] for r in found] + [0.0]) - DRIFT
    share = np.array([r["n0"] for r in found], float)
    share = np.append(share, max(n0 - share.sum(), 0)) / n0
    if not (values > 0).any():
        return Model(scores, 1.0)
    # Words that only occur in toxic texts have no share among ordinary ones; give them half an occurrence.
    share = np.maximum(share, 0.5 / n0)
    model = Model(scores, _lambda(values, share / share.sum()))
    calm = sample.filter("label is null or label <> 1").select("text")
    first = sample.sparkSession.sparkContext.broadcast(model)

    def best(batch: pa.RecordBatch, texts: list[str]) -> dict:
        found = [first.value.segments(t) for t in texts]
        return {"x": [first.value.lam * max(v for *_, v in s) - math.log(n) if s else None for n, s in found]}

    mean = map_texts(calm, "text", "x double", best).agg(F.avg("x").alias("m")).first()["m"]
    model.log_k = (mean if mean is not None else 0.0) - EULER
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch, texts: list[str]) -> dict:
        return {"label": batch.column(1), "x": [shared.value.passages(t)[1] for t in texts]}

    known = map_texts(sample.select("text", "label"), "text", "label int, x double", step).collect()  # as many rows as the sample at most
    if len({r["label"] for r in known}) > 1:
        model.slope, model.shift = fit_curve(np.clip([r["x"] for r in known], *REACH), np.array([float(r["label"] == 1) for r in known]))
    return model


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, passages): passages are arrays of (first word, end, normalised score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(id_col, text_col)

    def step(batch: pa.RecordBatch, texts: list[str]) -> dict:
        found = [shared.value.passages(t) for t in texts]
        passages = [[{"first_word": s, "end": e, "score": v} for s, e, v in kept] for kept, _ in found]
        return {id_col: batch.column(0), "score": [shared.value.score(x) for _, x in found], "passages": passages}

    kind = dict(rows.dtypes)[id_col]
    return map_texts(rows, text_col, f"`{id_col}` {kind}, score double, passages array<struct<first_word:bigint,end:bigint,score:double>>", step)
