import numpy as np
import pytest
from pyspark.sql import functions as F

from lexforge.operators import dist, ranking, units
from lexforge.plans import jobs


def documents(spark):
    text = "the red fox and the red hen and The Red barn by the old red fox "
    return units.keyed(spark.createDataFrame([(f"s{i % 3}", i, text * (1 + i % 4)) for i in range(120)], "source string, doc_id long, text string"), "source", "doc_id")


def test_jobs_run_end_to_end(spark):
    t = jobs.cut_units(documents(spark))
    total = t["units"].count()
    assert t["summary"].agg(F.sum("units")).first()[0] == total
    d = jobs.build_dictionary(t["units"], train_only=True)["dictionary"]
    assert {(r["reading"], r["surface"]) for r in d.collect()} >= {("the", "the"), ("the", "The"), ("red", "red")}
    out = jobs.evaluate_dictionary(t["units"], d, before=spark.createDataFrame([("zz", 3, 0, 0)], "reading string, missing long, first long, page long"))
    held = t["units"].filter("b between 1 and 9").count()
    assert out["total"].first()["units"] == held == out["scores"].agg(F.sum("units")).first()[0] and out["total"].first()["missing"] == 0
    assert out["reasons"].agg(F.sum("n")).first()[0] == held and "zz" in {r["reading"] for r in out["diff"].collect()}
    extra = jobs.additional(spark.createDataFrame([("the", "the", 9), ("new", "New", 7)], "reading string, surface string, cost int"), d, 100)
    assert [tuple(r) for r in extra["dictionary"].collect()] == [("new", "New", 100)] and extra["shared"].count() == 1
    assert jobs.check_sample(d, 2)["sample"].count() >= 2


def test_results_do_not_depend_on_partitions(spark):
    a, b = documents(spark).repartition(1), documents(spark).repartition(7)
    make = lambda d: sorted(map(tuple, jobs.build_dictionary(units.tokens(d))["dictionary"].collect()))
    assert make(a) == make(b)


def test_ranker_learns_the_context(spark):
    rows = [(f"k{n}", i, w.lower(), w) for n in range(40) for i, w in enumerate(("In The end the In The end the").split())]
    u = spark.createDataFrame(rows, "k string, i int, reading string, surface string")
    d = spark.createDataFrame([("the", "the", 1), ("the", "The", 2), ("in", "In", 1), ("end", "end", 1)], "reading string, surface string, cost int")
    e = ranking.examples(u, d, bits=12).cache()
    assert e.count() == 160 and e.filter("exists(features, f -> size(f) > 4)").count() == 0  # what all share is gone
    weights, losses = ranking.train(e, bits=12, epochs=5)
    assert losses[-1] < losses[0] / 3 and ranking.reranked(e, weights).filter("rank <> 1").count() == 0
    model = ranking.write_model(weights)
    assert len(model) == 32 + 4096 and np.abs(ranking.read_model(model) - weights).max() <= np.abs(weights).max() / 254 + 1e-9
    with pytest.raises(ValueError):
        ranking.read_model(model[:-1] + b"\x7f")


def test_release_checks(spark):
    base = (b"base", dist.record_text(b"base", ["aozora:1"]))
    own = dist.parse_record(base[1]).sha256
    model = (b"model", dist.record_text(b"model", ["aozora:1", "law:2"], own))
    notices = {"aozora:": "A", "law:": "L"}
    out = dist.catalogue({"model": model, "base": base}, "base", notices)
    assert [x["name"] for x in out] == ["base", "model"] and out[1]["notices"] == ["A", "L"]
    for broken in ({"base": (b"other", base[1])}, {"base": base, "m": (b"m", dist.record_text(b"m", [], "0"))}, {"base": (b"base", dist.record_text(b"base", ["x"]))}):
        with pytest.raises(ValueError):
            dist.catalogue(broken, "base", notices)
    lines = spark.createDataFrame([("a", "A")], "reading string, surface string")
    assert dist.shared_line(lines, lines) == "a\tA" and dist.shared_line(lines, lines.limit(0)) is None
