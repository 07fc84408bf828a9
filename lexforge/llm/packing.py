"""Packing token sequences into windows by best-fit decreasing.

Overlong documents are first cut into full windows; what remains of each document is an item. Best fit looks at open
windows only by their remaining capacity and at items only by their length, and both are whole numbers up to the window's
size. So the whole table's plan follows from one histogram of lengths, whatever the number of documents: lengths are
taken in descending order, a segment tree indexed by remaining capacity finds the tightest open capacity that still fits,
and all items of a length that would go to windows of that capacity are placed at once, as a run. The plan equals
that of placing one item after another. Runs number at most a few per length and capacity and are sent to all executors.

An item finds its run by its rank among the items of its length. Ranks come from counts in hash shards of the ids, so
no task holds all items of a length. The token ids are computed once; afterwards only lengths and checksums move.

Defined results: a null text counts as empty; a document's tokens end with `end_id`, so an empty one has one token; each
row is packed, repeated rows too; windows are numbered from 0 without gaps; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexforge.llm.arrow import map_texts
from lexforge.llm.bpe import broadcast_tokenizer, library_words, shared_encoder
from lexforge.runtime import materialize

WINDOW, END_ID, SHARDS = 1024, 0, 512


class CapacityTree:
    """The smallest capacity, at least a given one, that has open windows: a segment tree over the capacities 0..size."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, capacity: int, is_open: bool) -> None:
        i = self.leaves + capacity
        self.any[i] = is_open
        while i > 1:
            i >>= 1
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        """Climb until a right sibling has an open leaf, then descend to its leftmost one."""
        i = self.leaves + least
        if self.any[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return None


def plan(histogram: dict[int, int], window: int) -> tuple[np.ndarray, int]:
    """Runs (length, first rank, items, first window, items per window, offset in the window), and the number of windows.

    Within a run, item k of it goes to window `first + k // per`, at `offset + (k % per) * length`.
    """
    tree = CapacityTree(window)
    open_by: dict[int, list[tuple[int, int]]] = {}  # capacity -> ranges (first window, number of windows)
    runs, windows = [], 0

    def put(capacity: int, first: int, n: int) -> None:
        if n and capacity:
            held = open_by.setdefault(capacity, [])
            if not held:
                tree.set(capacity, True)
            held.append((first, n))

    for length in sorted((k for k, n in histogram.items() if n), reverse=True):
        rank, left = 0, histogram[length]
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                per = window // length
                n = -(-left // per)
                first, capacity = windows, window
                windows += n
            else:
                held = open_by[capacity]
                first, n = held.pop()
                if not held:
                    tree.set(capacity, False)
                per = capacity // length
            used = min(n, -(-left // per))
            items = min(left, used * per)
            runs.append((length, rank, items, first, per, window - capacity))
            full, rest = divmod(items, per)
            put(capacity - per * length, first, full)
            if rest:
                put(capacity - rest * length, first + full, 1)
            put(capacity, first + used, n - used)
            rank, left = rank + items, left - items
    return np.array(runs, np.int64).reshape(-1, 6), windows


def _measured(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, window: int, end_id: int) -> DataFrame:
    """(id, tokens, crcs): the number of tokens of each document and the checksums of its full windows and remainder."""
    spec = broadcast_tokenizer(docs, tokenizer)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def step(batch: pa.RecordBatch, texts: list[str]) -> dict:
        ids = [x + end_id.to_bytes(4, "little") for x in shared_encoder(spec, library_words).encode(texts)]
        crcs = [[zlib.crc32(x[i : i + 4 * window]) for i in range(0, len(x), 4 * window)] for x in ids]
        return {"id": batch.column(0), "tokens": [len(x) // 4 for x in ids], "crcs": crcs}

    return map_texts(rows, "text", f"id {dict(rows.dtypes)['id']}, tokens bigint, crcs array<bigint>", step)


def pack(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID, shards: int = SHARDS) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row for each piece."""
    sized = materialize(_measured(docs, id_col, text_col, tokenizer, window, end_id))
    rest = (F.col("tokens") % window).cast("int")
    items = sized.withColumn("full", F.floor(F.col("tokens") / window)).withColumn("rest", rest).withColumn("shard", F.pmod(F.xxhash64("id", "tokens", "crcs"), F.lit(shards)).cast("int"))
    order = ["id", "crcs"]
    in_length = Window.partitionBy("shard", "rest").orderBy(*order)
    items = items.withColumn("rank", F.row_number().over(in_length) - 1).withColumn("full_before", F.coalesce(F.sum("full").over(in_length.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    items = materialize(items)
    # Counts by shard and length; at most shards * window rows, whatever the input.
    counts = items.groupBy("shard", "rest").agg(F.count("*").alias("n"), F.sum("full").alias("full"))
    before = Window.partitionBy("rest").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = materialize(counts.withColumn("first_rank", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("first_full", F.coalesce(F.sum("full").over(before), F.lit(0))))
    totals = {r["rest"]: (r["n"], r["full"]) for r in counts.groupBy("rest").agg(F.sum("n").alias("n"), F.sum("full").alias("full")).collect()}
    histogram = {k: n for k, (n, _) in totals.items() if k}
    histogram[window] = sum(f for _, f in totals.values())
    runs, _ = plan(histogram, window)
    base, at = {}, 0
    for k in sorted(totals):
        base[k], at = at, at + totals[k][1]
    shared = docs.sparkSession.sparkContext.broadcast((runs, base))
    placed = items.join(counts.select("shard", "rest", "first_rank", "first_full"), ["shard", "rest"])
    placed = placed.select("id", "tokens", "crcs", "rest", (F.col("rank") + F.col("first_rank")).alias("rank"), (F.col("full_before") + F.col("first_full")).alias("full"))

    def run(batches):
        table, bases = shared.value
        by_length = {int(k): table[table[:, 0] == k] for k in np.unique(table[:, 0])}
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens, rank, full_rank, rests = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 4, 5, 3))
            crcs = batch.column(2)
            pieces = np.diff(crcs.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), pieces)
            number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = number * window
            length = np.minimum(window, tokens[row] - start)
            place = np.where(length == window, full_rank[row] + number + np.array([bases[int(k)] for k in rests])[row], rank[row])
            sequence, offset = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
            for k in np.unique(length):
                at, own = np.flatnonzero(length == k), by_length[int(k)]
                found = own[np.searchsorted(own[:, 1], place[at], side="right") - 1]
                nth = place[at] - found[:, 1]
                sequence[at] = found[:, 3] + nth // found[:, 4]
                offset[at] = found[:, 5] + nth % found[:, 4] * k
            crc = crcs.flatten().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), *map(pa.array, (start, length, crc, tokens[row], sequence, offset))], [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    kind = dict(placed.dtypes)["id"]
    return placed.mapInArrow(run, f"`{id_col}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")
