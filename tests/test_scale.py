"""What the queries shuffle and spill for a row of their input, and that it's the whole result nevertheless."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexforge.operators import chains, dictionary, intervals, patterns, units
from lexforge.plans import catalogue


def shuffled(spark, df):
    """The bytes that a query shuffles and spills."""
    gateway, store = spark.sparkContext._gateway, spark.sparkContext._jsc.sc().statusStore()

    def total():
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteBytes() + stages.apply(i).diskBytesSpilled() for i in range(stages.size()))

    before = total()
    df.write.format("noop").mode("overwrite").save()
    return total() - before


def random_docs(spark, n, size, vocabulary, seed=1):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(vocabulary)]
    texts = [" ".join(r.choices(words, k=size)) for _ in range(n)]
    return texts, spark.createDataFrame([("s", i, x) for i, x in enumerate(texts)], "source string, doc_id long, text string")


def chains_of(texts, n):
    every, docs = Counter(), Counter()
    for x in texts:
        w = x.lower().split()
        own = [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
        every.update(own)
        docs.update(set(own))
    return every, docs


@pytest.mark.parametrize("n", [2, 3])
def test_rare_chains_shuffle_only_hashes(spark, monkeypatch, n):
    monkeypatch.setattr(chains, "FILTER_BITS", 1 << 16)  # the whole filter is 8 MB, whatever the input
    texts, docs = random_docs(spark, 100, 400, 5000)
    assert shuffled(spark, chains.chains(units.readings(units.keyed(docs, "source", "doc_id")), n, 10, 5)) < 20 * 100 * (400 - n)


@pytest.mark.parametrize("bits", [64, 1 << 12])
def test_chains_as_brute_force_however_full_the_filter(spark, monkeypatch, bits):
    monkeypatch.setattr(chains, "FILTER_BITS", bits)
    texts, docs = random_docs(spark, 30, 60, 12)
    texts = [*texts, "One", "", "ab bc ab bc ab bc"]
    docs = spark.createDataFrame([("s", i, x) for i, x in enumerate([*texts, None])], docs.schema)
    keyed = units.keyed(docs, "source", "doc_id")
    for n, least, in_docs in ((2, 10, 5), (3, 2, 1), (3, 1, 2), (2, 1, 1)):
        every, own = chains_of(texts, n)
        want = sorted((*c, m, own[c]) for c, m in every.items() if m >= least and own[c] >= in_docs)
        for given in (units.readings(keyed), units.tokens(keyed)):
            assert sorted(map(tuple, chains.chains(given, n, least, in_docs).collect())) == want


def queries_on(spark, tmp_path, texts, benchmark):
    """A folder with two tables of these texts, for the queries of the catalogue."""
    docs = [(i, x, f"src{i % 3}") for i, x in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(benchmark)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_title_reads_shuffles_only_titles(spark, tmp_path):
    texts, _ = random_docs(spark, 100, 400, 3000)
    sf = queries_on(spark, tmp_path, [*texts, "Red fox red fox", "", None], ["red fox runs", "Red fox", "fox hen", "single", ""])
    found = catalogue.title_reads(spark, sf)
    # As in the SQL, a text without two words gives a title that is null.
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([("red fox", 2), ("fox hen", 0), (None, 0)], key=repr)
    assert shuffled(spark, catalogue.title_reads(spark, sf)) < 20_000


@pytest.mark.parametrize("name", ["chain2", "cohesion"])
def test_rare_pairs_shuffle_only_hashes(spark, monkeypatch, tmp_path, name):
    monkeypatch.setattr(chains, "FILTER_BITS", 1 << 16, raising=False)
    texts = [f"a b {x} a b" for x in random_docs(spark, 100, 400, 10000)[0]]
    sf = queries_on(spark, tmp_path, texts, ["x"])
    found = list(map(tuple, catalogue.QUERIES[name](spark, sf).collect()))
    every, own = chains_of(texts, 2)
    if name == "chain2":
        assert sorted(found) == sorted((*c, m, own[c]) for c, m in every.items() if m >= 10 and own[c] >= 5)
    else:
        assert sorted(x[:3] for x in found) == sorted((*c, m) for c, m in every.items() if m >= 5)
    # The counts of single words are in cohesion's bytes.
    assert shuffled(spark, catalogue.QUERIES[name](spark, sf)) < (20 if name == "chain2" else 50) * 100 * 400


def test_chain_names_shuffles_only_names(spark, tmp_path):
    texts, _ = random_docs(spark, 100, 400, 3000)
    sf = queries_on(spark, tmp_path, [*texts, "Blue foxes blue foxes", "blue", None], ["blue foxes run", "hens"])
    found = catalogue.chain_names(spark, sf)
    assert sorted(map(tuple, found.collect())) == [("blue", "foxes", 2)]
    assert shuffled(spark, catalogue.chain_names(spark, sf)) < 20_000


def test_words_of_letters_are_counted_without_a_search(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "ab abc ab-cd 😀ab\nab cd"), (2, None), (3, ""), (4, "xab ab1 é ab")], "k int, text string")
    p = spark.createDataFrame([("ab",), ("ab",), ("abc",), ("é",), ("zz",), ("",), (None,), ("ab-cd",), ("ab\n",), ("ab cd",)], "pattern string")
    want = {"ab": 6, "abc": 1, "é": 1, "zz": 0, "": 0, None: 0}
    assert dict(map(tuple, patterns.word_counts(docs, p).collect())) == want | {"ab-cd": 1, "ab\n": 0, "ab cd": 1}
    monkeypatch.setattr(patterns, "occurrences", None)
    letters = p.filter(F.col("pattern").isNull() | ~F.col("pattern").rlike("[^\\p{L}]") & (F.length("pattern") > 0))
    assert dict(map(tuple, patterns.word_counts(docs, letters).collect())) == {x: n for x, n in want.items() if x != ""}


def test_first_examples_reduces_rows_before_they_are_sorted(spark, monkeypatch):
    monkeypatch.setattr(dictionary, "BUFFERED", 50, raising=False)
    r = random.Random(3)
    data = [(r.choice(["a", "b", "c", None]), r.choice(["A", "B", None]), r.choice(["s:1", "s:10", "s:2", None]), i) for i in range(1000)]
    rows = spark.createDataFrame(data, "reading string, surface string, k string, i int").repartition(3)
    found = dictionary.first_examples(rows, ["reading"], F.struct("k", "i"), F.col("surface"))
    first = {}
    for x in data:
        first.setdefault(x[0], []).append(x)
    order = lambda x: (x[2] is not None, x[2] or "", x[3])
    assert found.columns == ["reading", "n", "example"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(((k, len(v), min(v, key=order)[1]) for k, v in first.items()), key=repr)
    assert found.limit(0).count() == 0 and dictionary.first_examples(rows.filter("false"), ["reading"], F.struct("k", "i"), F.col("surface")).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "MapInArrow" in plan and plan.rindex("SortAggregate") < plan.index("MapInArrow")


def test_running_out_needs_no_join(spark):
    r = random.Random(4)
    make = lambda n: [(r.choice(["a", "b", None]), s := r.randrange(40), s + r.randrange(1, 6), r.randrange(9)) for _ in range(n)]
    us, ss = make(90), make(12)
    u, s = spark.createDataFrame(us, "k string, start long, end long, x int"), spark.createDataFrame(ss, "k string, start int, end int, y int")
    out = lambda a: any(a[0] == b[0] is not None and a[1] < b[2] and a[2] > b[1] and (a[1] < b[1] or a[2] > b[2]) for b in ss)
    found = intervals.not_running_out(u, s)
    assert found.columns == u.columns and dict(found.dtypes) == dict(u.dtypes)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted((a for a in us if not out(a)), key=repr)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
