"""Numbers as they are written in Japanese: reading a notation, and writing a value back in it."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# The digits and the units.
KANJI_DIGITS = "〇一二三四五六七八九"
SMALL_UNITS = {"十": 10, "百": 100, "千": 1000}
LARGE_UNITS = {"万": 10**4, "億": 10**8, "兆": 10**12, "京": 10**16}
FULL_DIGITS = "０１２３４５６７８９"
DAIJI = str.maketrans("一二三十", "壱弐参拾")
#: Kanji with units write values below this; digits may be as long as they like.
LIMIT = 10**20


def write_number(value: int, notation: str) -> str:
    """A value in one of the notations: half, full, grouped, kanji (with units), digits (kanji one by one), daiji (with units, a 壱 before each)."""
    if notation == "half":
        return str(value)
    if notation == "full":
        return str(value).translate(str.maketrans("0123456789", FULL_DIGITS))
    if notation == "grouped":
        return f"{value:,}"
    if notation == "digits":
        return "".join(KANJI_DIGITS[int(c)] for c in str(value))
    if value == 0:
        return KANJI_DIGITS[0]
    out = []
    for unit, size in [*reversed(LARGE_UNITS.items()), ("", 1)]:
        part, value = divmod(value, size)
        if not part:
            continue
        for small, k in [*reversed(SMALL_UNITS.items()), ("", 1)]:
            digit, part = divmod(part, k)
            if digit:
                out.append(("" if small and digit == 1 and notation != "daiji" else KANJI_DIGITS[digit]) + small)
        out.append(unit)
    text = "".join(out)
    return text.translate(DAIJI) if notation == "daiji" else text


def _positional(text: str) -> int | None:
    """The value of kanji digits with units, however they are ordered; what writes it back decides whether they are right."""
    total = part = 0
    digits = ""
    for c in text:
        if c in KANJI_DIGITS:
            digits += str(KANJI_DIGITS.index(c))
        elif c in SMALL_UNITS:
            part, digits = part + int(digits or 1) * SMALL_UNITS[c], ""
        elif c in LARGE_UNITS:
            part, digits = part + int(digits or 0), ""
            total, part = total + part * LARGE_UNITS[c], 0
        else:
            return None
    return total + part + int(digits or 0)


def read_number_of(text: str) -> tuple[str, str] | None:
    """(notation, digits) of a number: digits as they are typed, leading zeros too; kanji with units only as the notation writes them and below the limit; else None."""
    if re.fullmatch("[0-9]+", text):
        return "half", text
    if re.fullmatch(f"[{FULL_DIGITS}]+", text):
        return "full", text.translate(str.maketrans(FULL_DIGITS, "0123456789"))
    if re.fullmatch("[1-9][0-9]{0,2}(,[0-9]{3})+", text):
        return "grouped", text.replace(",", "")
    if len(text) > 1 and all(c in KANJI_DIGITS for c in text):
        return "digits", "".join(str(KANJI_DIGITS.index(c)) for c in text)
    plain = text.translate({v: k for k, v in DAIJI.items()})
    notation, value = "kanji" if plain == text else "daiji", _positional(plain) if text else None
    return (notation, str(value)) if value is not None and value < LIMIT and write_number(value, notation) == text else None


@F.pandas_udf(StructType().add("notation", StringType()).add("digits", StringType()))
def read_number(text: pd.Series) -> pd.DataFrame:
    found = [read_number_of(t) if isinstance(t, str) else None for t in text]
    return pd.DataFrame({"notation": [f and f[0] for f in found], "digits": [f and f[1] for f in found]})


def number_run_of(text: str, value: int) -> tuple[int, int] | None:
    """The first run of number characters with a given value, as (start, end)."""
    for m in re.finditer(f"[0-9{FULL_DIGITS},{KANJI_DIGITS}{''.join(SMALL_UNITS)}{''.join(LARGE_UNITS)}壱弐参拾]+", text):
        if (found := read_number_of(m[0])) and int(found[1]) == value:
            return m.span()
    return None
