"""Near-duplicate documents by BagMinHash over the multiset of their five-word shingles.

Each shingle with its number of occurrences w is a weighted element. The weights 1, 2, 3, ... are grouped into dyadic
intervals (0,1], (1,2], (2,4], (4,8], ...; each interval of each element has a Poisson process of its own whose rate is the
interval's width, seeded by the shingle and the interval. A process yields points in ascending order; a point carries a
register and a position inside the interval, and belongs to the element if the position is within its weight, which is what
repeated halving of the interval decides bit by bit. A register keeps its smallest point, so two documents agree in a
register with a probability equal to their weighted Jaccard similarity. A process ends when its next point lies beyond the
largest register of its document, so the work is about n + k log k points, not n * k.

Registers are cut into bands. Within a bucket of equal bands, every other text is compared with the bucket's leader, texts
that then share a component are settled, and whatever members of different components remain are compared as well, in
blocks of bounded size, so that no link inside a bucket is lost. Each comparison computes the exact multiset overlap from the whole texts. With
24 bands of 5 rows, a pair of similarity 0.8 meets with probability 0.99993, and more similar ones more surely.

Defined results: a null text counts as empty; equal texts are always in one class, empty ones too; texts of fewer than
five words are one shingle; a text without words has no shingles and links only to its exact copies; repeated rows get
the same class; the class is the smallest doc_id in it, and null if none of its rows has an id (`head` still tells such classes apart); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexforge.llm.arrow import map_texts
from lexforge.llm.components import components
from lexforge.runtime import materialize

SHINGLE, THRESHOLD, BANDS, ROWS = 5, 0.8, 24, 5
#: Members of a bucket that one task compares with as many others.
BLOCK = 256
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _Words(dict):
    """64-bit hashes of recent words; forgetting costs time only."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Words()


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, occurrences) of the distinct shingles of each text, by document and shingle."""
    cut = [t.lower().split() for t in texts]
    lengths = np.fromiter(map(len, cut), np.int64, len(cut))
    flat = np.fromiter((h for ws in cut for h in map(_words.__getitem__, ws)), np.uint64, int(lengths.sum()))
    starts = np.cumsum(lengths) - lengths
    n = np.where(lengths == 0, 0, np.maximum(lengths - SHINGLE + 1, 1))
    doc = np.repeat(np.arange(len(cut)), n)
    first = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    padded = np.concatenate((flat, np.zeros(SHINGLE, np.uint64)))
    end = np.repeat(starts + lengths, n)
    value = np.zeros(len(first), np.uint64)
    for k in range(SHINGLE):  # a short text's missing words count as 0
        value = mix(value + np.where(first + k < end, padded[first + k], np.uint64(0)) * _ODD[k])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return doc[at], value[at], np.diff(np.append(at, len(doc)))


def signatures(doc: np.ndarray, value: np.ndarray, weight: np.ndarray, documents: int, registers: int) -> np.ndarray:
    """The registers of each document as 32-bit patterns; those of a document without elements stay at infinity."""
    levels = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    element = np.repeat(np.arange(len(value)), levels)
    level = np.arange(len(element)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0, np.int64(1) << np.maximum(level - 1, 0))
    low[level == 0] = 0
    width = np.where(level == 0, 1, np.maximum(low, 1))
    owner, most = doc[element], weight[element]
    seed = mix(value[element] + level.astype(np.uint64) * _ODD[1])
    least = np.full(documents * registers, np.inf)
    reach = np.full(documents, np.inf)
    x = np.zeros(len(seed))
    step = 0
    while len(seed):
        step += 1
        a = mix(seed + np.uint64(step * 0x9E3779B97F4A7C15 % 2**64))
        x = x - np.log(((a >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / width
        live = x <= reach[owner]
        seed, x, owner, low, width, most = seed[live], x[live], owner[live], low[live], width[live], most[live]
        b = mix(seed ^ np.uint64(step * 0x165667B19E3779F9 % 2**64))
        place = low + 1 + ((b >> np.uint64(32)).astype(np.int64) & (width - 1))
        own = place <= most
        np.minimum.at(least, owner[own] * registers + ((b[own] & np.uint64(0xFFFFFFFF)) % np.uint64(registers)).astype(np.int64), x[own])
        if step < 8 or step % 4 == 0:
            reach = least.reshape(documents, registers).max(axis=1)
    return least.reshape(documents, registers).astype(np.float32).view(np.uint32)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each document."""
    part = signature[:, : bands * rows].reshape(len(signature), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _ODD[0], part.shape[:2]).copy()
    for r in range(rows):
        key = mix(key + (part[:, :, r] + np.uint64(1)) * _ODD[2])
    return key.view(np.int64)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The weighted Jaccard similarity of two bags (values ascending, occurrences); 0 if either is empty."""
    total = int(a[1].sum() + b[1].sum())
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    return shared / (total - shared) if shared else 0.0


def _bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    _, value, weight = shingles([text])
    return value, weight


def node_of(text) -> F.Column:
    """128 bits that stand for a text."""
    return F.substring(F.unhex(F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256)), 1, 16)


def _signed(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    own = docs.select(F.col(id_col), F.col(text_col), node_of(F.col(text_col)).alias("node"))

    def step(batch: pa.RecordBatch, texts: list[str]) -> dict:
        doc, value, weight = shingles(texts)
        size = np.bincount(doc, weights=weight, minlength=len(texts)).astype(np.int64)
        keys = band_keys(signatures(doc, value, weight, len(texts), bands * rows), bands, rows)
        return {id_col: batch.column(0), "node": batch.column(2), "size": size, "bands": [k.tolist() if n else [] for k, n in zip(keys, size, strict=True)]}

    kind = dict(own.dtypes)[id_col]
    return map_texts(own, text_col, f"`{id_col}` {kind}, node binary, size bigint, bands array<bigint>", step)


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (u, v) whose multiset overlap, from the whole texts, is at least the threshold."""
    rows = (
        pairs.join(texts.select(F.col("node").alias("v"), F.col("text").alias("b")), "v")
        .join(texts.select(F.col("node").alias("u"), F.col("text").alias("a")), "u")
        .select("u", "v", "a", "b")
    )

    def run(batches):
        kept = ("", _bag(""))
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                passed = []
                for a, b in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    if a != kept[0]:
                        kept = (a, _bag(a))
                    passed.append(overlap(kept[1], _bag(b)) >= threshold)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["u", "v"]).filter(pa.array(passed, pa.bool_()))

    return rows.mapInArrow(run, "u binary, v binary")


def _group_links(texts: list[str], roots: list, threshold: float) -> list[tuple[int, int]]:
    """Links between texts of different roots in a group of bounded size; one for each pair of roots that it brings together.

    A bag becomes a set by numbering the occurrences of a shingle, so that multiset overlaps are products of a 0/1 matrix. Columns
    that only one text has don't matter, and the rest are taken in slices.
    """
    doc, value, weight = shingles(texts)
    size = np.bincount(doc, weights=weight, minlength=len(texts))
    element = np.repeat(np.arange(len(value)), weight)
    nth = np.arange(len(element)) - np.repeat(np.cumsum(weight) - weight, weight)
    column = np.unique(mix(value[element] + nth.astype(np.uint64) * _ODD[3]), return_inverse=True)[1]
    row = doc[element]
    often = np.bincount(column) > 1 if len(column) else np.zeros(0, bool)
    new = np.cumsum(often) - 1
    row, column = row[often[column]], new[column[often[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((len(texts), len(texts)), np.float32)
    for start in range(0, int(new[-1]) + 1 if len(new) else 0, 8192):
        a, b = np.searchsorted(column, (start, start + 8192))
        part = np.zeros((len(texts), 8192), np.float32)
        part[row[a:b], column[a:b] - start] = 1
        shared += part @ part.T
    names = {r: i for i, r in enumerate(dict.fromkeys(roots))}
    parent = list(range(len(names)))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    own, out = [names[r] for r in roots], []
    # In whole numbers: shared / (a + b - shared) >= threshold, with room for the threshold's own rounding.
    for i, j in zip(*np.nonzero(np.triu(shared * (1 + threshold) >= threshold * (size[:, None] + size[None, :]) - 1e-3, 1)), strict=True):
        a, b = top(own[i]), top(own[j])
        if a != b and shared[i, j] / (size[i] + size[j] - shared[i, j]) >= threshold:
            parent[a] = b
            out.append((int(i), int(j)))
    return out


def _rest_verified(members: DataFrame, texts: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """Links (u, v) between members (bucket, node, root) of a bucket that have different roots.

    A bucket is cut into blocks of about `block` members, and each pair of blocks is compared in one task, so a large
    bucket takes many tasks of bounded size, and no row is made for a pair that isn't a link.
    """
    # In the order of roots, most blocks of a large component have one root, and only those beside it are compared with them.
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("root", "node")) - 1
    cut = members.withColumn("own", F.floor(place / block).cast("int"))
    last = members.groupBy("bucket").agg((F.ceil(F.count("*") / block) - 1).cast("int").alias("last"))
    dealt = cut.join(last, "bucket").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    dealt = dealt.select("bucket", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "node", "root")
    # A pair of blocks in which all have one root has nothing to compare.
    several = dealt.groupBy("bucket", "a", "b").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("bucket", "a", "b")
    rows = dealt.join(several, ["bucket", "a", "b"], "left_semi").join(texts, "node").select("bucket", "a", "b", "node", "root", "text")

    def compare(table: pa.Table) -> pa.Table:
        nodes, found = table.column("node"), _group_links([t or "" for t in table.column("text").to_pylist()], table.column("root").to_pylist(), threshold)
        return pa.table({"u": nodes.take(pa.array([i for i, _ in found], pa.int64())), "v": nodes.take(pa.array([j for _, j in found], pa.int64()))})

    return rows.groupBy("bucket", "a", "b").applyInArrow(compare, "u binary, v binary")


def rows_of(docs: DataFrame, wanted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(node, doc): one row of the documents, as a struct, for each (least, node) of `wanted`: the least id of a text, null if it has none."""
    packed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    known = wanted.filter("least is not null").select(F.col("least").alias("id"), "node")
    known = packed.join(known, "id").filter(node_of(F.col("text")) == F.col("node")).dropDuplicates(["node"])
    # Copies without an id are combined before the shuffle.
    other = packed.filter("id is null").withColumn("node", node_of(F.col("text"))).dropDuplicates(["node"])
    other = other.join(wanted.filter("least is null").select("node"), "node", "left_semi")
    return known.select("node", "doc").union(other.select("node", "doc"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, node, class, head): the content key of each row, the smallest id of its class of near-duplicates, and the content key of the text with that id."""
    signed = materialize(_signed(docs, id_col, text_col, bands, rows))
    # Exact copies are one node from here on; a group of copies is combined before the shuffle.
    nodes = materialize(signed.groupBy("node").agg(F.min(id_col).alias("least"), F.any_value("size").alias("size"), F.any_value("bands").alias("bands")))
    spread = nodes.select("node", "size", F.explode("bands").alias("bucket"))
    counts = spread.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = materialize(spread.join(counts, "bucket"))
    # A bucket's leader is the member that meets the most others in all its buckets: the text that others were made from, if it is there.
    degrees = members.groupBy("node").agg(F.sum("n").alias("degree"))
    members = members.join(degrees, "node").select("bucket", "node", "size", "degree")
    leaders = members.groupBy("bucket").agg(F.max(F.struct("degree", "node", "size")).alias("leader"))
    members = materialize(members.join(leaders, "bucket").select("bucket", "node", "size", F.col("leader.node").alias("leader"), F.col("leader.size").alias("other")))
    similar = F.least("size", "other") >= threshold * F.greatest("size", "other")
    first = materialize(members.filter("node <> leader").filter(similar).select(F.col("leader").alias("u"), F.col("node").alias("v")).distinct())
    wanted = members.select("node").distinct().join(nodes, "node").select("least", "node")
    # Written once: both comparisons read them, and would fetch them by id again.
    texts = materialize(rows_of(docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")), wanted, id_col="id", text_col="text").select("node", "doc.text"))
    links = materialize(_verified(first, texts, threshold))
    roots = materialize(components(links))
    # Members of a bucket that the leader has not brought into one component are compared with those of the others.
    placed = members.filter("node <> leader").join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    split = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("bucket")
    rest = materialize(placed.join(split, "bucket", "left_semi"))
    if not rest.isEmpty():
        more = materialize(_rest_verified(rest, texts, threshold))
        if not more.isEmpty():
            roots = materialize(components(links.union(more)))
    classes = nodes.select("node", "least").join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    heads = classes.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("unknown"), "least", "node")).alias("head"))
    named = classes.join(heads, "root").select("node", F.col("head.least").alias("class"), F.col("head.node").alias("head"))
    return signed.select(id_col, "node").join(named, "node").select(F.col(id_col), "node", "class", "head")
