"""Which documents are taken: hash-ordered and file-ordered character budgets, samples, latest records."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def before_each(rows: DataFrame, bucket: Column, order: list[str], size: Column, name: str = "before", below: int | None = None) -> DataFrame:
    """Add the sum of `size` over all rows that come before in the order. `bucket` must not decrease in that order.

    Sums by bucket (a bounded number of them) are accumulated first, so that no task sees more than a bucket's rows. With `below`,
    buckets whose first row already has that much before it are left out before their rows are shuffled.
    """
    rows = rows.withColumn("_bucket", bucket).withColumn("_size", size)
    sums = rows.groupBy("_bucket").agg(F.sum("_size").alias("_sum"))
    above = sums.select("_bucket", F.coalesce(F.sum("_sum").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_above"))
    if below is not None:
        above = above.filter(F.col("_above") < below)
    inside = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.join(above, "_bucket").withColumn(name, F.col("_above") + F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    return out.drop("_bucket", "_size", "_above")


def hash_budget(docs: DataFrame, key: str, chars: Column, budget: int) -> DataFrame:
    """The documents in order of their key's SHA-256 until the budget is reached; the one that crosses it is kept. 4,096 buckets of hashes."""
    hashed = docs.withColumn("_hash", F.sha2(F.col(key), 256))
    taken = before_each(hashed, F.substring("_hash", 1, 3), ["_hash", key], chars, below=budget)
    return taken.filter(F.col("before") < budget).drop("_hash")


def order_budget(docs: DataFrame, order: str, chars: Column, budget: int, width: int = 4096) -> DataFrame:
    """The same in the order of a number, such as a place in a file."""
    return before_each(docs, F.floor(F.col(order) / width), [order], chars, below=budget).filter(F.col("before") < budget)


def sample_by_hash(rows: DataFrame, line: Column, n: int, strata: list[str] | None = None) -> DataFrame:
    """The n rows with the smallest hash of their line in each stratum: a deterministic sample. Each is a partial top-n."""
    w = Window.partitionBy(*(strata or [F.lit(0)])).orderBy("line_hash", "line")
    # Spark plans a rank limit below the shuffle, so a stratum sends at most n rows from each task.
    return rows.withColumn("line", line).withColumn("line_hash", F.sha2("line", 256)).withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)


def latest(records: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The latest record of each key, by a partial maximum of a struct rather than a sort."""
    rest = F.struct(*[c for c in records.columns if c not in keys])
    return records.groupBy(*keys).agg(F.max_by(rest, order).alias("_r")).select(*keys, "_r.*")


def turn_of(key: Column, turns: int) -> Column:
    """A key's turn among n, by its hash."""
    return F.pmod(F.xxhash64(key), F.lit(turns)).cast("int")


def field_budget(docs: DataFrame, field: str, order: str, size: Column, budget: int, width: int = 4096) -> DataFrame:
    """The documents of each field in the order of a number until its budget is reached; the one that crosses it is kept, and a document (k) counts for its first field only.

    Sums by field and range of the order come first, so a field that holds most rows is spread over its ranges.
    """
    first = docs.groupBy("k").agg(F.min(field).alias(field))
    rows = docs.join(first, ["k", field], "left_semi").withColumn("_range", F.floor(F.col(order) / width)).withColumn("_size", size)
    sums = rows.groupBy(field, "_range").agg(F.sum("_size").alias("_sum"))
    so_far = Window.partitionBy(field).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    above = sums.select(field, "_range", F.coalesce(F.sum("_sum").over(so_far), F.lit(0)).alias("_above")).filter(F.col("_above") < budget)
    inside = Window.partitionBy(field, "_range").orderBy(order, "k").rowsBetween(Window.unboundedPreceding, -1)
    taken = rows.join(above, [field, "_range"]).withColumn("before", F.col("_above") + F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    return taken.filter(F.col("before") < budget).drop("_range", "_size", "_above")


def shuffle_key(i: Column) -> Column:
    """A number from 0 to 2^64 - 1 by which rows stand in a fixed pseudo-random order: the place times an odd constant, its bits rotated by 17."""
    odd, whole, half = (F.lit(Decimal(n)) for n in (0x9E3779B97F4A7C15, 2**64, 2**32))
    low, high = (F.pmod(i, F.lit(2**32))).cast("decimal(10,0)"), F.floor(i / 2**32).cast("decimal(10,0)")
    mixed = (low * odd + (high * odd) % half * half) % whole
    top = F.floor(mixed / 2**47)
    return ((mixed - top * 2**47) * 2**17 + top).cast("decimal(20,0)")
