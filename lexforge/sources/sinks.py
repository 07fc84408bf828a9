"""Tables as single text files in order, written beside their place and then moved there, and small values in files."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    """A path and its file system; any that Spark can open."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_lines(lines: DataFrame, path: str, *, keep_before: bool = False) -> None:
    """Write the column `line` in the order of the rows to one file at `path`, whole or not at all; the old file can stay as `path` + `.before`.

    One task writes the file, as one file in order has to be; what is written so are reports and dictionaries.
    """
    spark = lines.sparkSession
    beside = f"{path}.{uuid.uuid4().hex}"
    lines.select(F.col("line").cast("string").alias("value")).coalesce(1).write.text(beside)
    folder, fs = _path(spark, beside)
    target, _ = _path(spark, path)
    parts = [x.getPath() for x in fs.listStatus(folder) if x.getPath().getName().startswith("part-")]
    if keep_before and fs.exists(target):
        before, _ = _path(spark, f"{path}.before")
        fs.delete(before, False)
        fs.rename(target, before)
    fs.delete(target, False)
    if parts:
        fs.rename(parts[0], target)
    else:
        fs.create(target).close()
    fs.delete(folder, True)


def write_table(rows: DataFrame, path: str, columns: list[str], order: list[str | Column], *, header: str | None = None, keep_before: bool = False) -> None:
    """Write rows as tab-separated lines in order, nulls as empty fields, with a header line if one is given."""
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    out = rows.withColumns({"line": line, "_first": F.lit(1)})
    if header is not None:
        out = rows.sparkSession.createDataFrame([(header, 0)], "line string, _first int").unionByName(out, allowMissingColumns=True)
    out = out.orderBy("_first", *order)
    write_lines(out, path, keep_before=keep_before)


def write_value(spark: SparkSession, path: str, value: object) -> None:
    """A single value in a file, such as the cost of a word that was seen once."""
    write_lines(spark.createDataFrame([(str(value),)], "line string"), path)


def read_value(spark: SparkSession, path: str) -> str | None:
    """The value of such a file; None without one."""
    target, fs = _path(spark, path)
    return spark.read.text(path).first()["value"].strip() if fs.exists(target) else None


def write_blocks(rows: DataFrame, path: str, rows_per_block: int = 100_000) -> None:
    """Rows in files of a bounded number, each of which a reader can hold on its own."""
    rows.write.option("maxRecordsPerFile", rows_per_block).parquet(path)
