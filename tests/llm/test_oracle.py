"""The queries of this subpackage that SQL can express equal DuckDB's on the smallest tables."""

import os

import duckdb
import pytest

from lexforge.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables here")
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_their_sql(spark, name):
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    out = queries.QUERIES[name](spark, SF)
    found = db.execute(queries.ORACLE[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == sorted(out.columns)
    near = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
    assert sorted(tuple(near(r[c]) for c in names) for r in out.collect()) == sorted(tuple(map(near, r)) for r in found.fetchall())
