"""The unit cutter on literal lines."""

from lexforge.operators import cutting
from lexforge.operators.japanese import numeric_units
from tests.cases import line


def found(units):
    return [(u["position"], u["reading"], u["surface"], u["compound"]) for u in units]


NUMERAL, COUNTER = "名詞-数詞", "接尾辞-名詞的-助数詞"


def test_words_numbers_and_what_follows():
    t = line(("紙", "かみ", "名詞"), ("三", "さん", NUMERAL), ("本", "ぼん", COUNTER), ("を", "を", "助詞"), ("コピー", "?", "名詞"), ("し", "し", "動詞", ("サ行変格", "連用形"), "する"))
    u = cutting.line_units(t)
    assert found(u) == [(0, "かみ", "紙", False), (1, "{}ぼん", "{kanji}本", False), (4, "こぴー", "コピー", False)]
    assert u[1]["value"] == "3" and u[1]["particle"] == "を" and u[2]["suru"] == "し" and "particle" not in u[0]
    t = line(("静か", "しずか", "形状詞"), ("な", "な", "助動詞", ("助動詞-ダ", "連体形")), ("村", "むら", "名詞"), ("だ", "だ", "助動詞", ("助動詞-ダ", "終止形")))
    assert [u.get("copula") for u in cutting.line_units(t)] == ["な", None]


def test_kanji_that_count_without_a_number_are_words():
    t = line(("数", "すう", NUMERAL), ("人", "にん", COUNTER), ("と", "と", "助詞"), ("廿", "にじゅう", NUMERAL), ("十二三", "じゅうにさん", NUMERAL))
    u = cutting.line_units(t)
    assert found(u) == [(0, "すうにん", "数人", False)] and u[0]["particle"] == "と" and u[0]["value"] is None
    assert numeric_units(t) == []
    assert found(cutting.line_units(t[:2], lexicon={"数人": ["すうじん", "すうにん"]})) == [(0, "すうにん", "数人", False)]


def test_affixes_keep_parts_unless_the_lexicon_has_the_word():
    t = line(("新", "しん", "接頭辞"), ("都市", "とし", "名詞"), ("に", "に", "助詞"))
    u = cutting.line_units(t)
    assert found(u) == [(0, "しんとし", "新都市", False)] and [p["surface"] for p in u[0]["parts"]] == ["新", "都市"]
    assert cutting.line_units(t, lexicon={"新都市": ["しんとし"]})[0]["parts"] == []


def test_auxiliaries_and_compounds_stand_beside():
    t = line(("書き", "かき", "動詞-一般", ("五段-カ行", "連用形-一般"), "書く"), ("始める", "はじめる", "動詞-非自立可能", ("下一段-マ行", "終止形-一般"), "始める"))
    assert found(cutting.line_units(t)) == [(0, "かき", "書き", False), (0, "かきはじめる", "書き始める", True), (2, "はじめる", "始める", False)]
    t = line(("海", "うみ", "名詞"), ("辺", "べ", "名詞"), ("二", "に", NUMERAL), ("階", "かい", COUNTER))
    longer = line(("海辺", "うみべ", "名詞"), ("二階", "にかい", "名詞"))
    assert found(cutting.line_units(t, longer)) == [(0, "うみ", "海", False), (0, "うみべ", "海辺", True), (1, "べ", "辺", False), (2, "{}かい", "{kanji}階", False)]
    same = line(("海", "うみ", "名詞"), ("ーー", "ー", "名詞"))
    assert [u for u in cutting.line_units(t, same) if u["compound"]] == []


def test_units_of_documents(spark):
    def tokenize(text):
        return line(*[(c, "あ", "名詞") for c in text]), []

    docs = spark.createDataFrame([("a", "山川\n\n海"), (None, "島"), ("b", None), ("c", "")], "doc_id string, text string")
    out = cutting.text_units(docs, tokenize, corrections={"山川": "やまかわ"}).orderBy("doc_id", "position").collect()
    assert [(r["doc_id"], r["position"], r["reading"], r["surface"]) for r in out] == [(None, 0, "あ", "島"), ("a", 0, "やまかわ", "山川"), ("a", 4, "あ", "海")]
    assert cutting.text_units(docs.limit(0), tokenize).count() == 0
