"""Scalar functions, sources and operators on small literal cases."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lexforge.functions import kana, markup, numerals, words
from lexforge.operators import chains, dictionary, evaluate, intervals, japanese, patterns, select
from lexforge.sources import documents, lists, robots
from tests.cases import line
from tests.cases import line as line_of


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_split(spark):
    want = {"aozora:000013": "dev", "aozora:000004": "eval", "aozora:000015": "eval", "aozora:000054": "train", "aozora:000155": "train", "pydocs:tutorial/index.html": "train"}
    df = spark.createDataFrame([(k,) for k in want], "k string")
    assert {r["k"]: r["s"] for r in df.select("k", words.split_of(F.col("k")).alias("s")).collect()} == want


def test_typed_readings(spark):
    want = {"1": "１", ",": "、", "-": "ー", "~": "〜", "ふりヴにゃ": "ふりゔにゃ", "ok": None, "ｏｋ": None, "四角数字": None, "": None}
    df = spark.createDataFrame([(k,) for k in want], "k string")
    assert {r["k"]: r["t"] for r in df.select("k", words.typed_reading(F.col("k")).alias("t")).collect()} == want


def test_line_functions(spark):
    cols = [
        words.cost_of(F.lit(8), F.lit(10)),
        words.cost_of(F.lit(1), F.lit(10)),
        words.okuri_line(F.lit("かく"), F.lit("書く")),
        words.okuri_line(F.lit("かわない"), F.lit("買わない")),
        words.okuri_line(F.lit("ほん"), F.lit("本")),
        words.is_word(F.lit("っと"), F.lit("ット")),
        words.is_word(F.lit("とうきょう"), F.lit("東京")),
        words.is_cut_short(F.lit("しらなかっ"), F.lit("知らなかっ")),
        kana.is_voicing_of(F.lit("がわ"), F.lit("かわ")),
        kana.voicings(F.lit("はな")),
        kana.same_but_joins(F.lit("がっこう"), F.lit("かつこう")),
        words.written_surface(F.lit("a\tb\\")),
        words.stratum_of(F.lit("base"), F.lit("だい{}かい"), F.lit(None).cast("string"), F.lit(10)),
    ]
    got = list(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())
    assert got[:2] == [22, 230] and tuple(got[2]) == ("か*く", "書く") and tuple(got[3]) == ("か*わ", "買わ") and got[4] is None
    assert got[5:] == [False, True, True, True, ["ばな", "ぱな"], True, "a\\tb\\\\", "base:numeric"]


def test_numbers():
    r = random.Random(1)
    for notation in ("half", "full", "grouped", "kanji", "digits", "daiji"):
        for _ in range(300):
            value = r.randrange(10 ** r.randrange(1, 18))
            text = numerals.write_number(value, notation)
            assert int(numerals.read_number_of(text)[1]) == value
    assert numerals.read_number_of("二十三") == ("kanji", "23") and numerals.read_number_of("二〇二六") == ("digits", "2026") and numerals.read_number_of("3万") is None
    assert numerals.read_number_of("1,23") is None and numerals.read_number_of("x") is None
    typed = {"007": ("half", "007"), "０５": ("full", "05"), "〇五": ("digits", "05"), "9" * 25: ("half", "9" * 25), "壱拾弐": ("daiji", "12"), "壱千参百": ("daiji", "1300")}
    assert {k: numerals.read_number_of(k) for k in typed} == typed and all(numerals.read_number_of(x) is None for x in ("千弐百", "拾弐", "万", "0,123", "一億億"))
    assert numerals.number_run_of("第二十三回", 23) == (1, 4) and numerals.number_run_of("金壱拾弐円", 12) == (1, 4)


def test_markup(spark):
    wiki = "<!-- x -->'''東京'''（とうきょう）は{{a|{{b}}}}[[日本|にほん]]の[[都市]]。<ref>y</ref>\n== 見出し ==\n* [[ファイル:a.png|[[b]]]]項目 &amp; 例\n{| x\n|}"
    assert markup.strip_wikitext_of(wiki) == "東京（とうきょう）はにほんの都市。\n項目 & 例"
    assert markup.without_nested("a{{b{{c}}d}}e{{f", "{{", "}}") == "ae{{f"
    assert markup.html_lines_of("<head><title>t</title></head><p>a <b>b</b></p><script>x</script><div>c<br>d</div>") == ["a b", "c", "d"]
    assert markup.normalize_text("ｶﾞＡｂ１é") == "ガAb１é"
    got = spark.createDataFrame([("東京 (曖昧)", "'''東京'''（とうきょう）は [[Category:a|b]][[カテゴリ: c]]"), ("テスト", "")], "t string, x string")
    out = got.select(markup.name_of(F.col("t")), markup.title_reading(F.col("t"), F.col("x")), markup.categories_of(F.col("x")), markup.finish_lines(F.lit(" a \n\n b"))).collect()
    assert [tuple(r) for r in out] == [("東京", "とうきょう", ["a", "c"], ["a", "b"]), ("テスト", "てすと", [], ["a", "b"])]


def test_robots(spark):
    text = "User-agent: other\nDisallow: /\n\nUser-agent: *\nDisallow: /a # c\nAllow: /a/b\nDisallow: /*.php$\nDisallow:\n"
    rules = robots.rules_of(text, "mybot")
    df = spark.createDataFrame([(p,) for p in ["/", "/a/x", "/a/b/c", "/x.php", "/x.php5"]], "p string")
    assert [r[0] for r in df.select(robots.allowed(F.col("p"), rules)).collect()] == [True, False, True, False, True]
    assert robots.rules_of(text, "OtherBot/1") == [("/", False)]


def test_budget(spark):
    df = spark.createDataFrame([("a", 3), ("b", 4), ("c", 5), ("d", 1)], "k string, n long")
    assert rows(select.order_budget(df.withColumn("o", F.ascii("k")), "o", F.col("n"), 7).select("k")) == [("a",), ("b",)]
    many = spark.createDataFrame([(f"k{i}", i % 7) for i in range(300)], "k string, n long")
    import hashlib

    order = sorted((f"k{i}" for i in range(300)), key=lambda k: hashlib.sha256(k.encode()).hexdigest())
    want, total = [], 0
    for k in order:
        if total < 100:
            want.append((k, total))
        total += int(k[1:]) % 7
    assert sorted(rows(select.hash_budget(many, "k", F.col("n"), 100).select("k", "before"))) == sorted(want)
    assert select.hash_budget(many.limit(0), "k", F.col("n"), 100).count() == 0


def test_nihon(spark):
    lines = [("にっぽんじかん", "日本時間", 1078), ("にっぽんぎんこう", "日本銀行", 1217), ("にっぽんし", "日本史", 1230), ("にほんし", "日本史", 1500), ("にっぽん", "日本", 626), ("にほん", "日本", 600), ("にっぽんにっぽん", "日本人", 3000), ("にっぽん", "ニッポン", 900)]
    out = dictionary.nihon(spark.createDataFrame(lines, "reading string, surface string, cost int"))
    assert rows(out) == rows(spark.createDataFrame([("にほんじかん", "日本時間", 1078), ("にほんぎんこう", "日本銀行", 1217)], "reading string, surface string, cost int"))


def test_stations(spark):
    raw = [(1, "<http://www.wikidata.org/entity/Q2256123>", '"でまちやなぎえき"', '"出町柳駅"@ja', '"12"'), (2, "<http://www.wikidata.org/entity/Q2256123>", '"デマチヤナギ"', '"出町柳駅"@ja', '"12"'), (3, "<http://www.wikidata.org/entity/Q1>", '"さんじょう"', '"三条駅 (京都府)"@ja', None), (4, "<http://www.wikidata.org/entity/Q2>", '"えーえき"', '"Aえき"@ja', None), (5, "<http://www.wikidata.org/entity/Q3>", '"ひがしえき"', '"東A駅"@ja', None)]
    s = lists.stations(spark.createDataFrame(raw, "line_no int, item string, kana string, label string, links string"))
    assert rows(s) == [("Q1", "三条駅", ["さんじょうえき"], 0), ("Q2256123", "出町柳駅", ["でまちやなぎえき"], 12)]
    assert ("でまちやなぎ", "出町柳", 12) in rows(lists.station_lines(s))


def test_symbols_and_kanji(spark):
    tsv = "POS\tCHAR\tReading\tdescription\n句読点\t、\tとうてん , 、\t読点\n\t\t\t\t\t\t\t# x\n# Hentaigana\n記号\t\U0001b000\tへんたいがな え\t変体仮名\n記号\t→\tやじるし　みぎ\t右矢印"
    df = spark.createDataFrame(list(enumerate(tsv.split("\n"))), "line_no int, value string")
    out = lists.symbol_pairs(df, 1, 2, symbols=True).orderBy("at").select("reading", "surface").collect()
    assert [tuple(r) for r in out] == [("とうてん", "、"), (",", "、"), ("、", "、"), ("やじるし", "→"), ("みぎ", "→")]
    emoji = spark.createDataFrame([(0, "x\t→\tみぎ"), (1, "x\t#1\tいち"), (2, "x\t\U0001b000\tえ")], "line_no int, value string")
    assert [tuple(r) for r in lists.symbol_pairs(emoji, 1, 2).orderBy("at").select("reading", "surface").collect()] == [("みぎ", "→"), ("え", "\U0001b000")]
    assert rows(lists.unihan_readings(spark.createDataFrame([("U+4E00\tkJapanese\tイチ イツ ひと",), ("U+4E00\tkOther\tx",)], "value string"))) == [("いち", "一"), ("いつ", "一")]
    assert one(spark, lists.unescaped(F.lit("a\\u3042b\\u{1F600}"))) == "aあb😀"


def test_small_parsers():
    assert lists.parse_corrections("# c\n紅葉\tもみじ\n方が\t-\n") == [lists.Correction("紅葉", "もみじ"), lists.Correction("方が", None)]
    with pytest.raises(ValueError, match="line 2"):
        lists.parse_corrections("a\tあ\nb")
    case = lists.parse_cases("c\tx\tか*く\t書く|欠く\t1位\n", True)[0]
    assert case.okurigana == "く" and case.accepted == ("書く", "欠く") and case.must_be_first
    assert lists.parse_paths(["日本", "東京"], "日\tに\n本\tほん\nEOS\n日本\t*\nEOS\n東京\tとうきょう\nEOS\n") == [["にほん", None], ["とうきょう"]]


def test_corrections_and_take_in():
    t = line(("四十", "よんじゅう", "名詞-数詞"), ("一", "いち", "名詞-数詞"), ("本", "ほん", "名詞"), ("一本", "いちほん", "名詞"))
    out = japanese.corrected(t, {"一本": "いっぽん", "一": "ひと"})
    assert [(x.surface, x.reading) for x in out] == [("四十", "よんじゅう"), ("一", "いち"), ("本", "ほん"), ("一本", "いっぽん")]
    u = japanese.units_of(line(("投げ", "なげ", "動詞-一般", ("下一段-ガ行", "未然形-一般"), "投げる"), ("られ", "られ", "助動詞"), ("ない", "ない", "助動詞")))
    assert [(x["reading"], x["stem_reading"], x["stem_surface"], x["conjugation"]) for x in u] == [("なげられない", "なげ", "投げ", "下一段-ガ行")]
    u = japanese.units_of(line(("読ん", "よん", "動詞-一般", ("五段-マ行", "連用形-撥音便"), "読む"), ("で", "で", "助詞-接続助詞"), ("い", "い", "動詞-非自立可能", ("上一段-ア行", "連用形-一般"), "いる")))
    assert [x["surface"] for x in u] == ["読んで"]


def test_stems_that_read_otherwise():
    stem = lambda *word: japanese.stem_of(line(word)[0], word[3][0])
    assert stem("高い", "たかい", "形容詞-一般", ("形容詞", "終止形-一般"), "高い") == ("たか", "高")
    assert stem("高う", "たこう", "形容詞-一般", ("形容詞", "連用形-ウ音便"), "高い") is None
    assert stem("問う", "とう", "動詞-一般", ("五段-ワア行", "連用形-ウ音便"), "問う") == ("と", "問")
    assert stem("有", "あり", "動詞-一般", ("五段-ラ行", "連用形-一般"), "有る") is None
    assert stem("見", "み", "動詞-一般", ("上一段-マ行", "連用形-一般"), "見る") == ("み", "見") and stem("改", "あらため", "動詞-一般", ("下一段-マ行", "連用形-一般"), "改る") is None


def test_japanese_units_have_document_positions(spark):
    def tokenize(line):
        return line_of(*[(c, "あ", "名詞") for c in line])

    docs = spark.createDataFrame([("a:1", "山川\n海")], "doc_id string, text string")
    assert [tuple(r)[1:4] for r in japanese.units(docs, tokenize).orderBy("position").collect()] == [(0, "あ", "山"), (1, "あ", "川"), (3, "あ", "海")]


def test_intervals_as_brute_force(spark):
    r = random.Random(2)
    make = lambda n: [(f"k{r.randrange(3)}", s := r.randrange(30), s + r.randrange(1, 5)) for _ in range(n)]
    us, ss = sorted(set(make(60))), sorted(set(make(20)))
    u, s = (spark.createDataFrame(x, "k string, start int, end int") for x in (us, ss))
    within = lambda a: any(a[0] == b[0] and b[1] <= a[1] and a[2] <= b[2] for b in ss)
    out = lambda a: any(a[0] == b[0] and a[1] < b[2] and a[2] > b[1] and (a[1] < b[1] or a[2] > b[2]) for b in ss)
    assert rows(intervals.covered(u, s)) == sorted(((*a, within(a)) for a in us), key=repr)
    assert rows(intervals.not_running_out(u, s)) == sorted((a for a in us if not out(a)), key=repr)
    g = spark.createDataFrame([("k", 0, 2), ("k", 0, 3), ("k", 2, 5), ("k", 3, 4), ("k", 4, 6)], "k string, start int, end int")
    assert rows(intervals.greedy(g)) == [("k", 0, 3), ("k", 3, 4), ("k", 4, 6)]
    parts = spark.createDataFrame([("k", 0, 1, "a"), ("k", 1, 3, "b"), ("k", 4, 5, "c"), ("k", 0, 3, "ab")], "k string, start int, end int, reading string")
    assert rows(intervals.parts_of(spark.createDataFrame([("k", 0, 3), ("k", 3, 5)], "k string, start int, end int"), parts)) == [("k", 0, 3, ["a", "b"])]


def test_patterns_as_brute_force(spark):
    texts = {"a": "abab aba", "b": "xabay\nbab 😀ab", "c": ""}
    pats = ["ab", "aba", "b", "zz"]
    docs, p = spark.createDataFrame(list(texts.items()), "k string, text string"), spark.createDataFrame([(x,) for x in pats], "pattern string")
    want = sorted((k, i + 1, x, t[i - 1] if i else None, t[i + len(x)] if i + len(x) < len(t) else None) for k, t in texts.items() for x in pats for i in range(len(t)) if t.startswith(x, i))
    assert rows(patterns.occurrences(docs, p)) == sorted(want, key=repr)
    assert dict(map(tuple, patterns.word_counts(docs, p).collect())) == {"ab": 1, "aba": 1, "b": 0, "zz": 0}
    e = patterns.entropy(spark.createDataFrame([("x", "a", 1), ("x", "b", 1), ("x", None, 2)], "p string, ch string, n long"), ["p"]).first()
    assert e["total"] == 4 and e["entropy"] == pytest.approx(1.5)


def test_dictionary_sets(spark):
    schema = "reading string, surface string, conjugation string, cost int"
    a = spark.createDataFrame([("a", "A", None, 5), ("b", "B", "c", 7)], schema)
    b = spark.createDataFrame([("a", "A", None, 3), ("b", "B", None, 1)], schema)
    assert rows(dictionary.merged(a, b, keys=dictionary.KEY)) == sorted([("a", "A", None, 3), ("b", "B", "c", 7), ("b", "B", None, 1)], key=repr)
    assert rows(dictionary.without(a, b, dictionary.KEY)) == [("b", "B", "c", 7)]
    text = dictionary.in_text_order(dictionary.rendered(a.union(b))).select("line").collect()
    assert [r[0] for r in text] == ["a\tA\t\t5", "a\tA\t\t3", "b\tB\tc\t7", "b\tB\t\t1"]
    parsed = dictionary.parsed(spark.createDataFrame([("# label",), ("a\tA\t\t5",), ("x",)], "value string"))
    assert rows(parsed) == sorted([("a", "A", None, 5, True), ("x", None, None, None, None)], key=repr) or parsed.filter("coalesce(valid, false)").count() == 1
    with pytest.raises(ValueError):
        dictionary.checked(parsed)
    assert rows(dictionary.shifted(a.select("reading", "cost"), 2)) == [("a", 2), ("b", 4)]
    assert rows(chains.most_frequent(spark.createDataFrame([("r", "y", 2), ("r", "x", 2), ("r", "z", 1)], "reading string, surface string, n long"), ["reading"], "surface")) == [("r", "x", 2)]


def test_evaluation(spark):
    d = spark.createDataFrame([("r", "a", 10), ("r", "b", 20)], "reading string, surface string, cost int")
    u = spark.createDataFrame([("r", "b")] * 3 + [("r", "a")] + [("r", "zz")] * 2 + [("q", "q")], "reading string, surface string")
    t = evaluate.by_key(evaluate.attempts(u, d))
    assert rows(t) == [("q", 1, 1, 0, 0, 0, 0), ("r", 6, 2, 1, 3, 4, 4)]
    assert rows(evaluate.scores(t, [])) == [(7, 3, 2, 0)]
    assert rows(evaluate.diff(t, t.filter("reading = 'r'"), ["reading"], ["missing"])) == [("q", 1, 0, -1)]


def test_registry_and_joins(spark):
    records = spark.createDataFrame([("aozora:1",), ("law",)], "source_id string")
    assert rows(documents.owned(records, [("aozora:", "aozora"), ("law", "laws")])) == [("aozora:1", "aozora"), ("law", "laws")]
    with pytest.raises(ValueError, match="law"):
        documents.owned(records, [("aozora:", "aozora")])
    docs = spark.createDataFrame([("a", "s", "t"), ("b", "s", "t")], "doc_id string, source_id string, text string")
    units = spark.createDataFrame([("a", 1, "y", "Y"), ("a", 0, "x", "X")], "doc_id string, position long, reading string, surface string")
    assert [[u["reading"] for u in r["units"]] for r in documents.joined_with_units(docs, units).collect()] == [["x", "y"]]
    with pytest.raises(ValueError):
        documents.joined_with_units(docs.filter("doc_id = 'b'"), units)
    with pytest.raises(ValueError):
        documents.unique_documents(docs.union(docs))


def test_dump_and_documents(spark, tmp_path):
    dump = "<mediawiki>" + "".join(f"<page><title>{t}</title><ns>{ns}</ns><id>{i}</id>{r}<revision><text>{x}</text></revision></page>" for i, (t, ns, r, x) in enumerate([("東京", 0, "", "本文です"), ("転送", 0, '<redirect title="東京" />', "x"), ("会話", 1, "", "y"), ("同名", 0, "", "{{aimai}}")])) + "</mediawiki>"
    (tmp_path / "d.xml").write_text(dump)
    out = documents.wikipedia(documents.read_pages(spark, str(tmp_path / "d.xml")), "jawiki")
    assert rows(out) == [("jawiki:0", "jawiki", "本文です")]
    documents.write_documents(out, str(tmp_path / "out"))
    assert rows(documents.read_documents(spark, str(tmp_path / "out")).select("doc_id", "source_id", "text")) == rows(out)


def test_streaming_counts(spark, tmp_path):
    from lexforge.streaming import unit_counts

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"doc_id":"a:1","source_id":"a","text":"one two","retrieved_at":"2026-01-01T00:00:00Z"}\n' * 2 + '{"doc_id":"b:1","source_id":"b","text":"three","retrieved_at":"2026-01-01T05:00:00Z"}\n')
    q = unit_counts.counts_by_kind(unit_counts.read_documents(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("counts").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert rows(spark.table("counts").select("kind", "docs", "units")) == [("a", 1, 2), ("b", 1, 1)]


def test_shares_of_a_place(spark):
    df = spark.createDataFrame([(["x", "y", "x"],), (["x"],)] + [([],)] * 8, "names array<string>")
    out = dictionary.shares(df, F.col("names"), df.agg(F.count("*").alias("total")))
    assert rows(out) == [("x", 2, round(-math.log(0.2) * 100)), ("y", 1, 230)]
