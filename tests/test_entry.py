"""The registered queries: each has rows, and those with SQL equal DuckDB's on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__
from lexforge.plans import catalogue

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables here")


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@needs_data
def test_the_flagship_runs(spark):
    assert __spark_entry__.entry(spark).columns == ["reading", "surface", "n", "cost"]


@needs_data
@pytest.mark.parametrize("name", ["split_counts", "doc_budget", "span_cover", "fragments", "eval_total", "lexicon_merge", "crosscount", "side_entropy", "ngram_match"])
def test_queries_equal_their_sql(spark, name):
    db = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        db.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    a = catalogue.QUERIES[name](spark, SF).toPandas()
    b = db.execute(catalogue.ORACLE[name]).df()
    assert sorted(a.columns) == sorted(b.columns)
    key = lambda d: sorted(map(repr, d[sorted(d.columns)].astype(object).itertuples(index=False, name=None)))
    assert key(a) == key(b)
