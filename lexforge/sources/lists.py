"""Lists: lexicons, titles, symbols, kanji, postal names, people, stations, corrections, checks."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.functions import kana

LEXICON = ["IndexForm", "LeftId", "RightId", "Cost", "Headword", "POS1", "POS2", "POS3", "POS4", "POS5", "POS6", "ReadingForm", "NormalizedForm", "DictionaryForm", "SplitA", "SplitB", "WordStructure", "SynonymGroups", "ReferenceId"]


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Lexicon rows as written, escapes resolved; an empty headword is the index form."""
    rows = spark.read.csv(path, header=True, escape='"', multiLine=False)
    return rows.select([unescaped(F.col(c)).alias(c) if c in ("IndexForm", "Headword") else F.col(c) for c in rows.columns]).withColumn("Headword", F.coalesce(F.nullif("Headword", F.lit("")), "IndexForm"))


def unescaped(x: Column) -> Column:
    r"""`\uXXXX` and `\u{...}` as characters: the pieces between escapes, each escape's code point by its number."""
    parts = F.split(F.regexp_replace(x, r"\\u(?:\{([0-9a-fA-F]+)\}|([0-9a-fA-F]{4}))", "\x01$1$2\x02"), "\x01")

    def one(p: Column) -> Column:
        code = F.conv(F.substring_index(p, "\x02", 1), 16, 10).cast("int")
        utf32 = F.unhex(F.lpad(F.hex(code), 8, "0"))
        return F.when(p.contains("\x02"), F.concat(F.decode(utf32, "UTF-32"), F.substring_index(p, "\x02", -1))).otherwise(p)

    return F.array_join(F.transform(parts, one), "")


def plain_words(lexicon: DataFrame) -> DataFrame:
    """(reading, surface) of words that don't conjugate and take a conversion; symbols and kana are left out."""
    reading = kana.to_hiragana(F.col("ReadingForm"))
    out = lexicon.filter(~F.col("POS1").isin("補助記号", "記号", "空白") & (F.coalesce("POS5", F.lit("*")) == "*"))
    return out.select(reading.alias("reading"), F.col("Headword").alias("surface")).filter(kana.is_reading(F.col("reading")) & kana.needs_conversion(F.col("surface"))).distinct()


def common_words(lexicon: DataFrame) -> DataFrame:
    """Plain words that aren't proper nouns."""
    return plain_words(lexicon.filter("POS2 <> '固有名詞'"))


def conjugating_words(lexicon: DataFrame) -> DataFrame:
    """(reading, surface, conjugation, forms): dictionary rows with the inflected rows that refer to them; names and respelled words are left out."""
    base = lexicon.filter("POS5 <> '*' and POS6 = '終止形-一般' and coalesce(DictionaryForm, '*') in ('', '*')").filter("POS2 <> '固有名詞'").filter("Headword = NormalizedForm or NormalizedForm is null or NormalizedForm = ''")
    key = F.regexp_replace("DictionaryForm", ",ref-.*$", "")
    forms = lexicon.filter("coalesce(DictionaryForm, '*') not in ('', '*')").groupBy(key.alias("k")).agg(F.array_sort(F.collect_set(F.struct(kana.to_hiragana(F.col("ReadingForm")).alias("reading"), F.col("Headword").alias("surface")))).alias("forms"))
    rows = base.withColumn("k", F.concat_ws(",", "Headword", "POS1", "POS2", "POS3", "POS4", "POS5", "POS6", "ReadingForm"))
    return rows.join(forms, "k", "left").select(kana.to_hiragana(F.col("ReadingForm")).alias("reading"), F.col("Headword").alias("surface"), F.col("POS5").alias("conjugation"), "forms")


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, reading, surface), each pair once; ValueError if a line hasn't three fields."""
    p = F.split("value", "\t")
    rows = spark.read.text(path).select(p.alias("p"))
    if rows.filter("size(p) <> 3 or exists(p, x -> x = '')").limit(1).collect():
        raise ValueError("a title needs three fields that aren't empty")
    one = rows.select(F.get("p", 0).alias("doc_id"), F.get("p", 1).alias("reading"), F.get("p", 2).alias("surface"))
    return one.groupBy("reading", "surface").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "reading", "surface")


def chain_words(lines: DataFrame) -> DataFrame:
    """(surface, readings) of a word list (value): two characters or more, kanji and katakana only, at least one kanji."""
    p = F.split("value", "\t")
    s = F.get(p, 4)
    keep = (F.length(s) >= 2) & s.rlike(f"^[{kana.KANJI}{kana.KATAKANA}{kana.LONG}]+$") & kana.has_kanji(s)
    return lines.filter(keep).groupBy(s.alias("surface")).agg(F.array_sort(F.collect_set(F.get(p, 0))).alias("readings"))


def symbol_pairs(lines: DataFrame, surface_at: int, readings_at: int, *, symbols: bool = False) -> DataFrame:
    """(at, reading, surface) in order of a table's lines (line_no, value): comments and surfaces that start with # dropped, readings split at spaces.

    The symbol table (`symbols`) has a header, a first line that starts with POS, and hentaigana, which are left out as well.
    """
    p = F.split("value", "\t")
    kept = ~F.col("value").startswith("#")
    if symbols:
        kept &= ~((F.col("line_no") == 0) & F.col("value").startswith("POS\t"))
    rows = lines.filter(kept).select("line_no", F.get(p, surface_at).alias("surface"), F.get(p, readings_at).alias("r"))
    out = rows.filter((F.col("surface") != "") & ~F.col("surface").startswith("#")).select("line_no", "surface", F.posexplode(F.split("r", "[ \u3000]+")).alias("n", "reading")).filter("reading <> ''")
    if symbols:
        out = out.filter(~F.col("surface").rlike("[\\x{1B000}-\\x{1B16F}]"))
    return out.select(F.struct("line_no", "n").alias("at"), "reading", "surface")


def kanji_readings(lines: DataFrame) -> DataFrame:
    """(reading, kanji) of lines `reading<TAB>run of kanji`."""
    p = F.split("value", "\t")
    return lines.filter(~F.col("value").startswith("#") & F.col("value").contains("\t")).select(F.get(p, 0).alias("reading"), F.explode(F.split(F.get(p, 1), "")).alias("kanji")).filter("kanji <> ''")


def unihan_readings(lines: DataFrame) -> DataFrame:
    """(reading, kanji) of `U+XXXX<TAB>kJapanese<TAB>readings`; only katakana readings, as hiragana."""
    p = F.split("value", "\t")
    char = F.decode(F.unhex(F.lpad(F.substr(F.get(p, 0), F.lit(3)), 8, "0")), "UTF-32")
    rows = lines.filter(F.get(p, 1) == "kJapanese").select(char.alias("kanji"), F.explode(F.split(F.get(p, 2), " ")).alias("r"))
    return rows.filter(kana.is_katakana(F.col("r"))).select(kana.to_hiragana(F.col("r")).alias("reading"), "kanji")


def place_names(rows: DataFrame) -> DataFrame:
    """(names): for each postal row (_c3.._c8), an array of its distinct (reading, surface) of prefecture, municipality and town."""
    pair = lambda r, s: F.struct(kana.to_hiragana(F.col(r)).alias("reading"), F.col(s).alias("surface"))
    town = F.when(~F.col("_c8").rlike("以下に掲載がない場合|の次に番地がくる場合|一円|[（(、]"), pair("_c5", "_c8"))
    return rows.select(F.array_distinct(F.array_compact(F.array(pair("_c3", "_c6"), pair("_c4", "_c7"), town))).alias("names"))


def entity(x: Column) -> Column:
    """`<http://.../Q42>` as `Q42`."""
    return F.regexp_extract(x, "([A-Z]\\d+)>?$", 1)


def literal(x: Column) -> Column:
    """`"text"@ja` as `text`."""
    return F.regexp_extract(x, '^"(.*)"(?:@[A-Za-z-]+|\\^\\^.*)?$', 1)


def people(rows: DataFrame) -> DataFrame:
    """(item, label, readings, links, ja, born): one row for each item of (line_no, item, kana, label, links, ja, birth); the label is the first row's."""
    born = F.try_to_number(F.regexp_extract("birth", "^(-?\\d+)-", 1), F.lit("S99999")).cast("int")
    return rows.groupBy("item").agg(F.min_by("label", "line_no").alias("label"), F.array_sort(F.collect_set("kana")).alias("readings"), F.max("links").alias("links"), F.bool_or("ja").alias("ja"), F.min(born).alias("born"))


def station_reading(reading: Column, label: Column) -> Column:
    """A struct (reading, surface): the label without the qualifier in brackets, the reading in hiragana; null if the label's 駅 isn't read."""
    s = F.regexp_replace(label, "\\s*[（(][^（）()]*[）)]$", "")
    r = kana.to_hiragana(F.regexp_replace(reading, "\\s", ""))
    whole = F.when(s.endswith("駅") & ~r.endswith("えき"), F.concat(r, F.lit("えき"))).otherwise(r)
    return F.when(kana.is_reading(whole), F.struct(whole.alias("reading"), s.alias("surface")))


def stations(rows: DataFrame) -> DataFrame:
    """(item, label, readings, links) of (line_no, item, kana, label, links): one row for each item; the label is the first row's."""
    one = rows.withColumn("s", station_reading(literal(F.col("kana")), literal(F.col("label")))).withColumn("links", F.coalesce(F.try_to_number(literal(F.col("links")), F.lit("999999")).cast("int"), F.lit(0)))
    one = one.filter(kana.has_kanji(F.col("s.surface")) & F.col("s.surface").rlike(f"^[{kana.KANJI}{kana.HIRAGANA}{kana.KATAKANA}{kana.LONG}]+$"))
    return one.groupBy(entity(F.col("item")).alias("item")).agg(F.min_by("s.surface", "line_no").alias("label"), F.array_sort(F.collect_set("s.reading")).alias("readings"), F.max("links").alias("links"))


def station_lines(stations_: DataFrame) -> DataFrame:
    """(reading, surface, weight): each label with its readings, one ending in 駅 also without it; a station counts once for a line, by its links."""
    one = stations_.select("item", "label", F.explode("readings").alias("reading"), F.greatest(F.lit(1), F.col("links")).alias("links"))
    bare_reading, bare = F.regexp_replace("reading", "えき$", ""), F.regexp_replace("label", "駅$", "")
    short = F.col("label").endswith("駅") & F.col("reading").endswith("えき") & (F.length(bare_reading) > 0) & kana.has_kanji(bare)
    pair = lambda r, s: F.struct(r.alias("reading"), s.alias("surface"))
    lines = F.array_compact(F.array(pair(F.col("reading"), F.col("label")), F.when(short, pair(bare_reading, bare))))
    once = one.select("item", "links", F.explode(lines).alias("l")).select("item", "links", "l.*").groupBy("item", "reading", "surface").agg(F.max("links").alias("links"))
    return once.groupBy("reading", "surface").agg(F.sum("links").alias("weight"))


def split_reading(reading: Column) -> Column:
    """The parts of a person's reading, or null if one isn't kana."""
    parts = F.filter(F.split(kana.to_hiragana(reading), "[ \u3000・]+"), lambda x: x != "")
    return F.when(F.forall(parts, kana.is_reading) & (F.size(parts) > 0), parts)


# ---- small files of our own, read on the driver --------------------------------------------------------------------


@dataclass(frozen=True)
class Correction:
    surface: str
    reading: str | None


def _data_lines(text: str):
    for n, line in enumerate(text.split("\n"), 1):
        if line.strip() and not line.startswith("#"):
            yield n, line.rstrip("\r").split("\t")


def parse_corrections(text: str) -> list[Correction]:
    """`surface<TAB>reading`, or `-` to drop the surface; ValueError names the line."""
    out = []
    for n, p in _data_lines(text):
        if len(p) != 2 or not p[0] or not (p[1] == "-" or re.fullmatch("[ぁ-ゖー]+", p[1])):
            raise ValueError(f"line {n}: a surface and a kana reading, or -")
        out.append(Correction(p[0], None if p[1] == "-" else p[1]))
    if len({c.surface for c in out}) < len(out):
        raise ValueError("a surface comes twice")
    return out


def parse_added_readings(text: str) -> list[tuple[str, str]]:
    out = []
    for n, p in _data_lines(text):
        if len(p) != 2 or not p[0] or not re.fullmatch("[ぁ-ゖー]+", p[1]):
            raise ValueError(f"line {n}: a surface and a kana reading")
        out.append((p[0], p[1]))
    return out


@dataclass(frozen=True)
class Case:
    category: str
    context: str
    reading: str
    okurigana: str | None
    accepted: tuple[str, ...]
    must_be_first: bool


def parse_cases(text: str, with_expectation: bool) -> list[Case]:
    """`category<TAB>context<TAB>reading<TAB>a|b`, with `候補` or `1位` where asked; `*` in a reading marks okurigana."""
    out = []
    for n, p in _data_lines(text):
        if len(p) != 4 + with_expectation or not all((p[0], p[2], p[3])) or (with_expectation and p[4] not in ("候補", "1位")):
            raise ValueError(f"line {n}: wrong fields")
        reading, star, okurigana = p[2].partition("*")
        out.append(Case(p[0], p[1], reading, okurigana if star else None, tuple(p[3].split("|")), with_expectation and p[4] == "1位"))
    return out


def parse_paths(inputs: list[str], output: str) -> list[list[str | None]]:
    """For each input, the readings of its n-best paths; a path with an unknown word has none. Paths end with EOS, inputs change where a path spells the next one."""
    paths, path = [], []
    for line in output.splitlines():
        if line == "EOS":
            paths.append(path)
            path = []
        else:
            path.append(line.partition("\t")[::2])
    out: list[list[str | None]] = [[] for _ in inputs]
    at = 0
    for p in paths:
        spelled = "".join(s for s, _ in p)
        while at < len(inputs) and spelled != inputs[at]:
            at += 1
        if at == len(inputs):
            raise ValueError(f"a path spells {spelled!r}, which is no input that is left")
        out[at].append(None if any(not r or r == "*" for _, r in p) else "".join(r for _, r in p))
    return out


def title_of_url(url: Column) -> Column:
    """The article title that a link to it ends with: percent signs decoded, low lines as spaces."""
    return F.replace(F.url_decode(F.regexp_extract(url, "/([^/]+)$", 1)), F.lit("_"), F.lit(" "))


def unread_people(rows: DataFrame, articles: DataFrame) -> DataFrame:
    """(item, title, reading): people (item, url, kana) without a reading, with that of the article (title, reading) that their link names, sorted by item by whoever writes them."""
    own = rows.filter(F.coalesce(F.col("kana"), F.lit("")) == "").select("item", title_of_url(F.col("url")).alias("title"))
    return own.join(articles.filter("reading is not null"), "title").select("item", "title", "reading")
