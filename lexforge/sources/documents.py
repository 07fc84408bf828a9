"""Documents and units: JSON Lines, parquet, dumps and archives; registry and manifest."""

from __future__ import annotations

import hashlib
import io
import tarfile
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.functions import markup
from lexforge.operators import select

DOCUMENT = "doc_id string, source_id string, text string"
PART = "offset long, reading string, surface string, stem_reading string, stem_surface string, conjugation string, unknown_conjugation string"
UNIT = (
    "doc_id string, position long, reading string, surface string, stem_reading string, stem_surface string, conjugation string, unknown_conjugation string, "
    "numeric struct<reading:string,surface:string,value:string,kana:string>, compound boolean, okurigana_variant boolean, "
    f"parts array<struct<{', '.join(f'{n}:{t}' for n, t in (p.split(' ') for p in PART.split(', ')))}>>, particle string, suru string, copula string"
)
MANIFEST = "source_id string, url string, sha256 string, bytes long, retrieved_at string"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """A malformed line fails the read and names itself."""
    return spark.read.schema(DOCUMENT).json(path, mode="FAILFAST")


def read_units(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(UNIT).json(path, mode="FAILFAST")


def write_units(units: DataFrame, path: str) -> None:
    """JSON Lines in document order: ranges of documents, sorted inside; no task holds them all."""
    units.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "position").write.json(path)


def write_documents(docs: DataFrame, path: str) -> None:
    docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.json(path)


def manifest_for_build(records: DataFrame) -> DataFrame:
    """The latest record of each source (line_no tells the order of appending)."""
    return select.latest(records, ["source_id"], F.col("line_no"))


def latest_for_url(records: DataFrame, url: str) -> DataFrame:
    return records.filter(F.col("url") == url).orderBy(F.desc("line_no")).limit(1)


def owned(records: DataFrame, owners: list[tuple[str, str]]) -> DataFrame:
    """Records with their source's name: the owner of the exact id, else of its prefix `x:`. ValueError names an id without owner."""
    exact = {p: n for p, n in owners if not p.endswith(":")}
    prefixes = sorted(((p, n) for p, n in owners if p.endswith(":")), key=lambda x: -len(x[0]))
    name: Column = F.lit(None).cast("string")
    for p, n in reversed(prefixes):
        name = F.when(F.col("source_id").startswith(p), n).otherwise(name)
    for p, n in exact.items():
        name = F.when(F.col("source_id") == p, n).otherwise(name)
    out = records.withColumn("owner", name)
    if bad := out.filter("owner is null").select("source_id").limit(1).collect():
        raise ValueError(f"no source owns {bad[0][0]}")
    return out


def unique_documents(docs: DataFrame) -> DataFrame:
    """The documents, if no id comes twice; ValueError names one that does."""
    if bad := docs.groupBy("doc_id").count().filter("count > 1").limit(1).collect():
        raise ValueError(f"document {bad[0][0]} comes twice")
    return docs


def joined_with_units(docs: DataFrame, units: DataFrame) -> DataFrame:
    """(doc_id, source_id, text, units): each document with its units in order. Documents without units go; units without a text are an error."""
    per_doc = units.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("position", "reading", "surface"))).alias("units"))
    if bad := per_doc.join(docs, "doc_id", "left_anti").select("doc_id").limit(1).collect():
        raise ValueError(f"the units of {bad[0][0]} have no text")
    return docs.join(per_doc, "doc_id")


def read_pages(spark: SparkSession, dump: str) -> DataFrame:
    """(ns, id, title, redirect, text) of a wiki dump; bzip2 files are split by Spark. Filter before stripping the text."""
    schema = "ns int, id long, title string, redirect struct<_title:string>, revision struct<text:string>"
    pages = spark.read.format("xml").option("rowTag", "page").option("attributePrefix", "_").schema(schema).load(dump)
    return pages.select("ns", "id", "title", F.col("redirect").isNotNull().alias("redirect"), F.col("revision.text").alias("text"))


def articles(pages: DataFrame) -> DataFrame:
    """Pages of the main namespace that neither redirect nor disambiguate."""
    return pages.filter("ns = 0 and not redirect").filter(~markup.is_disambiguation(F.col("text")))


def wikipedia(pages: DataFrame, source_id: str, budget: int = 20_000_000) -> DataFrame:
    """Documents of the articles with the smallest hashes, until the budget of characters; only those are stripped for the result."""
    own = articles(pages).select(F.concat_ws(":", F.lit(source_id), "id").alias("doc_id"), F.lit(source_id).alias("source_id"), markup.strip_wikitext("text").alias("text"))
    return select.hash_budget(own, "doc_id", F.length("text").cast("long"), budget).select("doc_id", "source_id", "text")


def field_articles(pages: DataFrame, fields: list[tuple[str, str]]) -> DataFrame:
    """(dictionary, id, title, text): articles whose categories match a field's pattern; one pass over the dump for all fields."""
    found = F.array_compact(F.array(*[F.when(F.exists(markup.categories_of(F.col("text")), lambda c, p=p: c.rlike(p)), name) for name, p in fields]))
    return articles(pages).select("id", "title", "text", F.explode(F.array_distinct(found)).alias("dictionary"))


def base_names(pages: DataFrame) -> DataFrame:
    """The names of all articles and redirects, without digits."""
    own = pages.filter("ns = 0").filter(~markup.is_disambiguation(F.coalesce("text", F.lit(""))))
    return own.select(markup.name_of(F.col("title")).alias("name")).filter(~F.col("name").rlike("[0-9０-９]")).distinct()


def read_archives(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """(path, name, text) of the files in zip and tar archives; an archive is one row, so it has to fit in a task's memory."""

    def entries(batches):
        for frame in batches:
            rows = []
            for p, content in zip(frame["path"], frame["content"], strict=True):
                if zipfile.is_zipfile(io.BytesIO(content)):
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        rows += [(p, n, z.read(n).decode(encoding, "replace")) for n in z.namelist() if not n.endswith("/")]
                else:
                    with tarfile.open(fileobj=io.BytesIO(content)) as t:
                        rows += [(p, m.name, t.extractfile(m).read().decode(encoding, "replace")) for m in t if m.isfile()]
            yield pd.DataFrame(rows, columns=["path", "name", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(entries, "path string, name string, text string")


def content_key(content: bytes) -> str:
    """The name of a stored content: its SHA-256."""
    return hashlib.sha256(content).hexdigest()


def kept_dictionaries(names: list[str]) -> list[str]:
    """The dictionaries that are shipped, in their order: the base first, then the others by name."""
    return sorted(dict.fromkeys(names), key=lambda n: (n != "base", n))


def days_of(year: Column) -> Column:
    """All days of a year, as dates in order."""
    return F.sequence(F.make_date(year, F.lit(1), F.lit(1)), F.make_date(year, F.lit(12), F.lit(31)))
