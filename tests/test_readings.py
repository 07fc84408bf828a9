import itertools

from lexforge.functions import readings as r
from lexforge.operators import japanese as j
from tests.cases import line


def test_counters_change_after_numbers():
    want = {("いち", "ほん"): "いっぽん", ("さん", "ほん"): "さんぼん", ("ろく", "かい"): "ろっかい", ("じゅう", "さつ"): "じゅっさつ", ("ろく", "さつ"): "ろくさつ", ("に", "ほん"): "にほん", ("はち", "てん"): "はってん", ("いち", "まい"): "いちまい"}
    assert {k: r.sound_changes(*k) for k in want} == want
    assert r.counted_after("にじゅういち", "かい") == "にじゅういっかい" and r.counted_after("なん", "ほん") == "なんぼん" and r.counted_after("ひゃく", "かい") == "ひゃっかい"
    assert r.base_reading(["ほん"], "ぼん") == "ほん" and r.base_reading(["ふん", "ぶん"], "ぶん") == "ふん" and r.base_reading(["かい"], "x") == "かい" and r.base_reading(["a", "b"], "c") == "c"


def test_joined_readings():
    assert r.joined_reading([], "おおかわ", 2) == "おおかわ" and r.joined_reading(["おおがわ"], "おおかわ", 2) == "おおがわ"
    assert r.joined_reading(["おおせん"], "おおかわ", 2) == "おおせん" and r.joined_reading(["たいせん"], "おおかわ", 2) == "おおかわ" and r.joined_reading(["あ", "い"], "おおかわ", 2) is None


def test_junctions():
    assert r.joins_of("がっこうせいかつ", ["がくこう", "せいかつ"]) is None
    assert r.joins_of("がっこう", ["がく", "こう"]) == [(True, "plain")] and r.joins_of("やまがわ", ["やま", "かわ"]) == [(False, "voiced")] and r.joins_of("いっぱん", ["いち", "はん"]) == [(True, "half")]
    for a, b in itertools.product(["やま", "がく", "さつ"], ["かわ", "はな", "いけ"]):
        assert r.joins_of(a + b, [a, b]) == [(False, "plain")]


def test_municipalities():
    assert r.split_municipality("いしかりぐんとうべつちょう", "石狩郡当別町") == [("いしかりぐん", "石狩郡"), ("とうべつちょう", "当別町")]
    assert r.split_municipality("さっぽろしちゅうおうく", "札幌市中央区") == [("さっぽろし", "札幌市"), ("ちゅうおうく", "中央区")]
    assert r.split_municipality("よっかいちし", "四日市市") == []


def test_alignments():
    of = {"日": ["にち", "ひ", "か"], "本": ["ほん", "もと"], "学": ["がく"], "校": ["こう"]}
    assert r.alignments("にっぽん", "日本", of) == [[("にち", "日"), ("ほん", "本")]]
    assert r.alignments("がっこう", "学校", of) == [[("がく", "学"), ("こう", "校")]] and r.alignments("ひの", "日の", of) == [[("ひ", "日")]] and r.alignments("x", "日", of) == []
    assert len(r.alignments("あ" * 8, "字" * 8, {"字": ["あ", "あ"]}, most=64)) == 64


def test_affixes_are_joined_unless_the_lexicon_reads_otherwise():
    t = line(("大", "おお", "接頭辞"), ("川", "かわ", "名詞"), ("的", "てき", "接尾辞-名詞的"), ("な", "な", "助動詞"))
    words, parts = j.join_affixes(t, {})
    assert [(x.surface, x.reading) for x in words] == [("大川的", "おおかわてき"), ("な", "な")] and [p.surface for p in parts[0]] == ["大", "川", "的"]
    words, parts = j.join_affixes(t, {"大川": ["おおがわ"]})
    assert words[0].reading == "おおがわてき" and [p.surface for p in parts[0]] == ["大川", "的"]
    assert [x.surface for x in j.join_affixes(t, {"大川": ["だいせん", "たいせん"]})[0]] == ["大", "川的", "な"]


def test_auxiliaries_are_joined_to_stems():
    verb = ("歩き", "あるき", "動詞-一般", ("五段-カ行", "連用形-一般"), "歩く")
    more = lambda form: (form[:-1], "つづけ", "動詞-非自立可能", ("下一段-カ行", "連用形-一般"), form)
    words, made = j.join_auxiliaries(line(verb, more("続ける")))
    assert [(x.surface, x.dictionary_form) for x in words] == [("歩き続け", "歩き続ける")] and made == {0}
    assert len(j.join_auxiliaries(line(("お", "お", "接頭辞"), verb, more("続ける")))[0]) == 3
    assert len(j.join_auxiliaries(line(verb, more("致す")))[0]) == 2
    assert [x.surface for x in j.join_auxiliaries(line(verb, more("続ける"), ("やすい", "やすい", "接尾辞-形容詞的", ("形容詞", "終止形-一般"))))[0]] == ["歩き続けやすい"]
    assert len(j.join_auxiliaries(line(("静か", "しずか", "形状詞-一般"), ("っぽい", "っぽい", "接尾辞-形容詞的", ("形容詞", "終止形-一般"))))[0]) == 1


def test_numbers_with_counters():
    number, counter = "名詞-数詞", "名詞-普通名詞-助数詞可能"
    out = j.numeric_units(line(("第", "だい", "接頭辞"), ("三", "さん", number), ("回", "かい", counter), ("と", "と", "助詞"), ("二十", "にじゅう", number), ("一", "いち", number), ("本", "ほん", counter), ("目", "め", "接尾辞")))
    assert [(u["position"], u["reading"], u["surface"], u["value"], u["kana"]) for u in out] == [(0, "だい{}かい", "第{kanji}回", "3", "だいさんかい"), (4, "{}ほんめ", "{kanji}本目", "21", "にじゅういっぽんめ")]


def test_seams_that_are_spelled_as_they_sound():
    assert r.joined_reading(["はなじ", "かち"], "はなち", 2) == "はなじ" and r.joined_reading(["みかずき", "あ"], "みかつき", 2) == "みかずき"
