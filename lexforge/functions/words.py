"""Dictionary lines: costs, what counts as a word, okurigana and particle lines, typed forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexforge.functions import kana


def cost_of(n: Column, total: Column) -> Column:
    """round(-100 ln(n / total)), half away from zero."""
    return F.round(-F.log(n / total) * 100).cast("int")


def split_bucket(key: Column) -> Column:
    """The first 8 bytes of a key's SHA-256, as an unsigned number, modulo 100."""
    return (F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10).cast("decimal(20,0)") % 100).cast("int")


def split_of(key: Column) -> Column:
    """dev for 0, eval for 1 to 9, else train."""
    b = split_bucket(key)
    return F.when(b == 0, "dev").when(b < 10, "eval").otherwise("train")


def kind_of(key: Column) -> Column:
    """What stands before the first colon of a document key."""
    return F.substring_index(key, ":", 1)


# Kana that start no word, and marks that end none.
NO_START, NO_END = "^(?:[ぁぃぅぇぉゃゅょゎゕゖっんー]|$)", "[-－〜～]$"


def is_word(reading: Column, surface: Column) -> Column:
    """Whether a line can be a word: its reading starts with a kana that starts words, and its surface has no white space or stray marks."""
    return ~reading.rlike(NO_START) & ~surface.rlike("[\\s\\p{Z}゛゜、]") & ~surface.rlike(NO_END)


def is_glossed(surface: Column) -> Column:
    """Whether a surface has a bracket, as glosses do."""
    return surface.rlike("[()（）〔〕［］\\[\\]]")


def is_cut_short(reading: Column, surface: Column) -> Column:
    """Whether a form with kanji was cut at a small tsu: its reading ends in one."""
    return reading.endswith("っ") & kana.has_kanji(surface)


def okuri_line(reading: Column, surface: Column) -> Column:
    """A struct (reading, surface) with `*` before the first kana after the kanji, both cut after it; null if the kana don't end the reading."""
    tail = F.regexp_extract(surface, f"^.*[{kana.KANJI}]([{kana.HIRAGANA}]+)$", 1)
    head = F.substring(reading, F.lit(1), F.length(reading) - F.length(tail))
    first = F.substring(tail, 1, 1)
    stem = F.substring(surface, F.lit(1), F.length(surface) - F.length(tail))
    line = F.struct(F.concat(head, F.lit("*"), first).alias("reading"), F.concat(stem, first).alias("surface"))
    return F.when((F.length(tail) > 0) & reading.endswith(tail), line)


def particle_line(reading: Column, surface: Column, particle: Column) -> Column:
    """A struct (reading, surface) of a word followed by a particle's first kana; null without a particle."""
    return F.when(F.length(particle) > 0, F.struct(F.concat(reading, F.lit("*"), F.substring(particle, 1, 1)).alias("reading"), surface.alias("surface")))


def typed_reading(reading: Column) -> Column:
    """What is typed for a symbol's reading: digits and signs in full width, katakana as hiragana; null if letters or kanji remain."""
    # The signs that type as Japanese punctuation; the rest of ASCII but letters types as its full-width twin.
    own = dict(zip("-,.[]/~", "ー、。「」・〜", strict=True))
    ascii_ = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalpha()]
    full = F.translate(kana.to_hiragana(reading), "".join(ascii_), "".join(own.get(c, chr(ord(c) + 0xFEE0)) for c in ascii_))
    return F.when(full.rlike(f"^(?:[{kana.HIRAGANA}ー、。「」・〜]|(?![Ａ-Ｚａ-ｚ])[！-～])+$"), full)


def reading_form(reading: Column, surface: Column, ending: Column) -> Column:
    """A struct (surface, reading) to be read by a second analyzer, with the terminal ending of the line's conjugation.

    Null for surfaces without kanji or with white space or digits, for numeric and okurigana lines, and for conjugations without an ending
    (a null one; plain words have an empty one).
    """
    fits = kana.has_kanji(surface) & ~reading.rlike("[{*]") & ~surface.rlike("[\\s\\p{Z}0-9０-９]") & ending.isNotNull()
    return F.when(fits, F.struct(F.concat(surface, ending).alias("surface"), F.concat(reading, ending).alias("reading")))


def stratum_of(dictionary: Column, reading: Column, conjugation: Column, cost: Column) -> Column:
    """The stratum of a line: that of a base line by its kind and cost, else its dictionary's name."""
    base = F.when(F.length(F.coalesce(conjugation, F.lit(""))) > 0, "conjugating").when(reading.contains("{"), "numeric").when(cost >= 3000, "unidic-only").when(cost < 1500, "common").otherwise("rare")
    return F.when(dictionary == "base", F.concat(F.lit("base:"), base)).otherwise(dictionary)


def written_surface(surface: Column) -> Column:
    """A surface as it is written in a dictionary: backslashes, tabs and line breaks escaped."""
    return F.replace(F.replace(F.replace(surface, F.lit("\\"), F.lit("\\\\")), F.lit("\t"), F.lit("\\t")), F.lit("\n"), F.lit("\\n"))


def nihon_readings(reading: Column, surface: Column) -> Column:
    """The reading with にっぽん read as にほん, if each 日本 of the surface is read so; else null."""
    count = lambda x, part: (F.length(x) - F.length(F.replace(x, F.lit(part), F.lit("")))) / len(part)
    same = (count(surface, "日本") > 0) & (count(surface, "日本") == count(reading, "にっぽん"))
    return F.when(same, F.replace(reading, F.lit("にっぽん"), F.lit("にほん")))


# Words that conjugate unlike others of their type, with the type they get; and types and words whose stems read otherwise by form.
OWN_TYPES = {
    "五段-カ行-促音便": "行く 逝く",
    "五段-ワア行-ウ音便": "問う 乞う 請う",
    "五段-ラ行-特殊": "くださる 下さる いらっしゃる おっしゃる 仰る なさる 為さる ござる 御座る 御坐る",
}
OUTSIDE_TYPES, OUTSIDE_WORDS = ("カ行変格",), ("する", "いい")


def conjugation_type(kind: Column, dictionary_form: Column) -> Column:
    """The type that a word conjugates by; null if it's held as forms that don't conjugate."""
    out = F.when(kind.isin(*OUTSIDE_TYPES) | dictionary_form.isin(*OUTSIDE_WORDS), None)
    for name, members in OWN_TYPES.items():
        out = out.when(dictionary_form.isin(*members.split()), name)
    return out.otherwise(kind)


def reading_after_number(place: Column, surface: Column, reading: Column) -> Column:
    """The reading of the word at a place (from 0) after a number: 位 ranks right after it, and means about so much after a counter."""
    return F.when((place > 0) & (surface == "位") & (reading == "い"), F.lit("くらい")).otherwise(reading)
