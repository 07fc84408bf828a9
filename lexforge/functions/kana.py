"""Kana and kanji: character classes, conversions and voicing, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ranges of the character classes, and the voicing pairs.
HIRAGANA = "\\x{3041}-\\x{3096}"
KATAKANA = "\\x{30A1}-\\x{30FA}"
KANJI = "\\x{3400}-\\x{9FFF}\\x{F900}-\\x{FAFF}々〆ヶ"
LONG = "ー"
PLAIN = "かきくけこさしすせそたちつてとはひふへほ"
VOICED = "がぎぐげござじずぜぞだぢづでどばびぶべぼ"
HALF_VOICED_OF = "はひふへほ"
HALF_VOICED = "ぱぴぷぺぽ"

_KATA = "".join(chr(c) for c in range(0x30A1, 0x30F7))
_HIRA = "".join(chr(c - 0x60) for c in range(0x30A1, 0x30F7))


def to_hiragana(x: Column) -> Column:
    """Katakana with a hiragana twin become hiragana; everything else stays."""
    return F.translate(x, _KATA, _HIRA)


def to_katakana(x: Column) -> Column:
    return F.translate(x, _HIRA, _KATA)


def is_hiragana(x: Column) -> Column:
    return x.rlike(f"^[{HIRAGANA}]+$")


def is_reading(x: Column) -> Column:
    """Only hiragana and the long mark, at least one."""
    return x.rlike(f"^[{HIRAGANA}{LONG}]+$")


def is_katakana(x: Column) -> Column:
    return x.rlike(f"^[{KATAKANA}]+$")


def is_kanji(x: Column) -> Column:
    return x.rlike(f"^[{KANJI}]+$")


def has_kanji(x: Column) -> Column:
    return x.rlike(f"[{KANJI}]")


def unvoiced(x: Column) -> Column:
    """Each voiced or half-voiced kana without its mark."""
    return F.translate(x, VOICED + HALF_VOICED, PLAIN + HALF_VOICED_OF)


def is_voicing_of(voiced: Column, plain: Column) -> Column:
    """Whether the first reading is the second with its first kana voiced."""
    head = F.substring(voiced, 1, 1)
    return (head != F.substring(plain, 1, 1)) & (unvoiced(head) == F.substring(plain, 1, 1)) & (F.substr(voiced, F.lit(2)) == F.substr(plain, F.lit(2)))


def voicings(reading: Column) -> Column:
    """The readings that voicing of the first kana can give: voiced, and half-voiced where there is one."""
    head, rest = F.substring(reading, 1, 1), F.substr(reading, F.lit(2))
    forms = [F.when(F.lit(PLAIN).contains(head), F.concat(F.translate(head, PLAIN, VOICED), rest)), F.when(F.lit(HALF_VOICED_OF).contains(head), F.concat(F.translate(head, HALF_VOICED_OF, HALF_VOICED), rest))]
    return F.array_compact(F.array(*forms))


def needs_conversion(surface: Column) -> Column:
    """Whether typing a surface takes a conversion: it has something other than reading kana."""
    return ~is_reading(surface)


def after_last_kanji(surface: Column) -> Column:
    """What follows the last kanji; the whole surface without one."""
    return F.regexp_replace(surface, f"^.*[{KANJI}]", "")


def same_but_joins(a: Column, b: Column) -> Column:
    """Whether two readings are equal apart from voicing and small or large tsu."""
    fold = lambda x: F.translate(unvoiced(x), "っ", "つ")
    return fold(a) == fold(b)


def geminated(reading: Column) -> Column:
    """The reading with its last kana, one of those that geminate, as a small tsu; unchanged without one."""
    return F.regexp_replace(reading, "[つちくき]$", "っ")


def middle_script(char: Column) -> Column:
    """The script of a character: hiragana, katakana, kanji, latin, digit or other. Equal neighbours continue a word."""
    return (
        F.when(char.rlike(f"^[{HIRAGANA}]"), "hiragana")
        .when(char.rlike(f"^[{KATAKANA}{LONG}]"), "katakana")
        .when(char.rlike(f"^[{KANJI}]"), "kanji")
        .when(char.rlike("^\\p{L}"), "latin")
        .when(char.rlike("^\\p{N}"), "digit")
        .otherwise("other")
    )


def read_as_written(reading: Column, surface: Column) -> Column:
    """The reading of a word; one in katakana alone, but for the rare ones, reads as it is written."""
    plain = surface.rlike(f"^[{KATAKANA}{LONG}]+$") & ~surface.rlike("[ヵヶ\\x{30F7}-\\x{30FA}]")
    return F.when(plain, F.translate(to_hiragana(surface), "ゐゑ", "いえ")).otherwise(reading)
