"""Entries, reports, sinks and small rules on literal cases."""

import datetime
import os

from pyspark.sql import functions as F

from lexforge.functions import kana, words
from lexforge.operators import dictionary, evaluate, patterns, select, units
from lexforge.sources import documents, lists, sinks


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_words_that_read_or_conjugate_on_their_own(spark):
    d = spark.createDataFrame([("テレビ", "x"), ("ヱビス", "x"), ("ヵ", "か"), ("駅", "えき"), ("ゴー", "x")], "s string, r string")
    assert [r[0] for r in d.select(kana.read_as_written(F.col("r"), F.col("s"))).collect()] == ["てれび", "えびす", "か", "えき", "ごー"]
    d = spark.createDataFrame([("五段-カ行", "行く"), ("五段-カ行", "書く"), ("カ行変格", "来る"), ("形容詞", "いい"), ("五段-ラ行", "なさる")], "t string, w string")
    assert [r[0] for r in d.select(words.conjugation_type(F.col("t"), F.col("w"))).collect()] == ["五段-カ行-促音便", "五段-カ行", None, None, "五段-ラ行-特殊"]
    d = spark.createDataFrame([(0, "位", "い"), (1, "位", "い"), (1, "本", "ほん")], "i int, s string, r string")
    assert [r[0] for r in d.select(words.reading_after_number(F.col("i"), F.col("s"), F.col("r"))).collect()] == ["い", "くらい", "ほん"]


def test_long_lines_are_cut_at_breaks(spark):
    text = "あ" * 7 + "。" + "い" * 30 + "、" + "う" * 5
    d = spark.createDataFrame([(1, "short"), (2, text), (3, "")], "k int, text string")
    out = {}
    for r in units.pieces(d, most_bytes=40).orderBy("k", "at").collect():
        out.setdefault(r["k"], []).append((r["at"], r["text"]))
    assert out[1] == [(0, "short")] and out[3] == [(0, "")] and "".join(t for _, t in out[2]) == text
    assert all(text[at : at + len(t)] == t and 0 < len(t) <= 10 for at, t in out[2]) and out[2][0] == (0, "あ" * 7 + "。")


def test_numeric_lines(spark):
    u = spark.createDataFrame([("{}ほん", "{kanji}本")] * 3 + [("{}かい", "{half}回")] * 2 + [("{}x", "y")], "reading string, surface string")
    total = u.agg(F.count("*").alias("total"))
    out = dictionary.numeric_entries(u.withColumn("reading", F.replace("reading", F.lit("{}"), F.lit(""))), total, F.col("reading") == "ほん")
    assert rows(out) == [("かい", "{half}回", 110), ("ほん", "{kanji}本", 69), ("ぼん", "{kanji}本", 69), ("ぽん", "{kanji}本", 69)]
    assert {r["surface"] for r in dictionary.counting_small_numbers(u.distinct(), u.filter("surface <> 'y'")).collect()} == {"{kanji}本", "y"}


def test_entries_of_titles_and_chains(spark):
    titles = spark.createDataFrame([("とうきょう", "東京"), ("えー", "A"), ("ながい", "長い題")], "reading string, surface string")
    counts = spark.createDataFrame([("東京", 5)], "surface string, n long")
    texts = spark.createDataFrame([("東京", 9), ("長い題", 2), ("A", 7)], "surface string, n long")
    total = spark.createDataFrame([(100,)], "total long")
    entries = dictionary.title_entries(titles, counts, texts, total)
    assert rows(entries.select("surface", "n")) == [("東京", 5), ("長い題", 2)]
    chains = spark.createDataFrame([("けんさく", "検索", True, 3), ("さがし", "探し", True, 3), ("ほかん", "補完", False, 3), ("こう", "考", True, 1)], "reading string, surface string, taken boolean, suru long")
    assert [r[:3] for r in rows(dictionary.unnamed_entries(entries, chains, total)) if r[2]] == [("けんさく", "検索", "サ行変格")]


def test_needless_readings_and_rendaku(spark):
    added = spark.createDataFrame([("a", "A", "added"), ("b", "B", "rare"), ("c", "C", "given"), ("d", "D", "added")], "reading string, surface string, use string")
    assert rows(dictionary.needless_readings(added, spark.createDataFrame([("D",)], "surface string"))) == [("b", "B", "rare"), ("c", "C", "given"), ("d", "D", "dropped")]
    verbs = spark.createDataFrame([("つく", "付く", "五段"), ("づく", "付く", "五段"), ("だす", "出す", "五段"), ("ばらう", "払う", "五段"), ("はらう", "払う", "五段")], "reading string, surface string, conjugation string")
    assert {r["reading"] for r in dictionary.without_rendaku(verbs).collect()} == {"つく", "だす", "はらう"}


def test_tables_without_lines_and_preferred_rows(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "surface string, n long")
    assert [rows(t) for t in dictionary.dropped({"a": a}, lambda t: F.col("surface") == "x").values()] == [[(None, 2)]]
    b = spark.createDataFrame([("x", 5), ("y", 6), (None, 7)], "surface string, n long")
    assert rows(dictionary.preferred(a, b, ["surface"])) == [("x", 1), ("y", 6), (None, 2)]
    u = spark.createDataFrame([(True, ["a"], 1), (False, None, 2)], "okurigana_variant boolean, parts array<string>, n int")
    assert rows(dictionary.okurigana_variants(u)) == [(False, None, 1)]


def test_agreement_examples_and_percent(spark):
    a = spark.createDataFrame([("s", "r"), ("s", "q"), ("t", "u"), ("s", "r")], "surface string, reading string")
    assert rows(evaluate.agreed_readings(a, a.filter("reading <> 'q'"))) == [("s", "r"), ("t", "u")]
    assert rows(dictionary.readings_by_surface(a)) == [("s", ["q", "r"]), ("t", ["u"])]
    seed = spark.createDataFrame([("s", ["r", "x"])], "surface string, readings array<string>")
    assert rows(dictionary.readings_after(seed, dictionary.readings_by_surface(a))) == [("s", ["r", "x", "q"]), ("t", ["u"])]
    assert rows(evaluate.shares_of_total(spark.createDataFrame([("a", 1), ("a", 1), ("b", 6)], "k string, n long"), ["k"])) == [("a", 2, 25.0), ("b", 6, 75.0)]


def test_patterns_by_both_ways(spark):
    docs = spark.createDataFrame([(1, "abcab😀ab"), (2, None), (3, ""), (4, "b\nab")], "k int, text string")
    p = spark.createDataFrame([("ab",), ("b",), ("",), ("bca",), ("ab",), ("😀",)], "pattern string")
    a, b = (rows(patterns.occurrences(docs, p, automaton_chars=n)) for n in (1000, 0))
    assert a == b and (1, 6, "😀", "b", "a") in a and (4, 3, "ab", "\n", None) in a and len(a) == 11
    assert patterns.occurrences(docs, p.limit(0)).count() == 0


def test_budget_of_fields_and_shuffled_order(spark):
    d = spark.createDataFrame([("a", "f", 1, 4), ("b", "f", 2, 4), ("c", "f", 300, 4), ("a", "g", 1, 4), ("d", "g", 2, 9), ("e", "g", 9, 1)], "k string, field string, at long, n long")
    assert rows(select.field_budget(d, "field", "at", F.col("n"), 8, 4).select("k", "field", "before")) == [("a", "f", 0), ("b", "f", 4), ("d", "g", 0)]
    key = lambda i: (((x := i * 0x9E3779B97F4A7C15 % 2**64) << 17) | (x >> 47)) % 2**64
    ids = [0, 1, 2, 77, 2**32 + 5, 2**62 + 9]
    assert [int(r["x"]) for r in spark.createDataFrame([(i,) for i in ids], "i long").select("i", select.shuffle_key(F.col("i")).alias("x")).orderBy("i").collect()] == [key(i) for i in ids]


def test_sinks_replace_whole_files(spark, tmp_path):
    path = f"{tmp_path}/out.tsv"
    t = spark.createDataFrame([("b", 1, None), ("a", 1, "x"), ("c", 2, "y")], "r string, n int, s string")
    sinks.write_table(t, path, ["r", "n", "s"], [F.desc("n"), "r"], header="# label")
    assert open(path).read() == "# label\nc\t2\ty\na\t1\tx\nb\t1\t\n"
    sinks.write_table(t.filter("n = 2"), path, ["r"], ["r"], keep_before=True)
    assert open(path).read() == "c\n" and open(path + ".before").read().startswith("# label") and not [f for f in os.listdir(tmp_path) if not f.startswith((".", "out.tsv"))]
    sinks.write_value(spark, f"{tmp_path}/cost", 812)
    assert sinks.read_value(spark, f"{tmp_path}/cost") == "812" and sinks.read_value(spark, f"{tmp_path}/none") is None
    sinks.write_blocks(spark.range(10).coalesce(1), f"{tmp_path}/blocks", 4)
    assert len([f for f in os.listdir(f"{tmp_path}/blocks") if f.endswith(".parquet")]) == 3 and spark.read.parquet(f"{tmp_path}/blocks").count() == 10


def test_people_by_article_and_days(spark):
    people = spark.createDataFrame([("Q1", "https://ja.wikipedia.org/wiki/%E5%B1%B1%E7%94%B0_%E5%A4%AA%E9%83%8E", None), ("Q2", "https://ja.wikipedia.org/wiki/x", "かな")], "item string, url string, kana string")
    articles = spark.createDataFrame([("山田 太郎", "やまだ たろう"), ("x", "えっくす")], "title string, reading string")
    assert rows(lists.unread_people(people, articles)) == [("Q1", "山田 太郎", "やまだ たろう")]
    days = spark.createDataFrame([(2024,)], "y int").select(documents.days_of(F.col("y")).alias("d")).first()["d"]
    assert len(days) == 366 and days[0] == datetime.date(2024, 1, 1) and documents.kept_dictionaries(["person", "base", "emoji", "base"]) == ["base", "emoji", "person"]
