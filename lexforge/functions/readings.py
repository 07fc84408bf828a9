"""Readings of compounds, counters, names and places: how kana change where words meet.

Plain functions of short strings; wrap them in a pandas UDF, or use them on small tables, as each word is judged alone.
"""

from __future__ import annotations

import re
from itertools import product

from lexforge.functions.kana import HALF_VOICED, HALF_VOICED_OF, PLAIN, VOICED

VOICE = dict(zip(PLAIN, VOICED, strict=True))
HALF = dict(zip(HALF_VOICED_OF, HALF_VOICED, strict=True))
UNVOICE = {v: k for k, v in [*VOICE.items(), *HALF.items()]}
# Kana that become a small tsu before a voiceless one; numbers that change before a counter, and the rows that change them.
GEMINATING = "つちくき"
ROWS = {"か": "かきくけこ", "さ": "さしすせそ", "た": "たちつてと", "は": "はひふへほ"}
SHORT = {"いち": "いっ", "ろく": "ろっ", "はち": "はっ", "じゅう": "じゅっ"}
SHORT_BEFORE = {"いち": "かさたは", "ろく": "かは", "はち": "かさたは", "じゅう": "かさたは"}
# The endings of read numerals, with the number after which a counter changes in the same way.
LIKE = [("ん", "さん"), ("じゅう", "じゅう"), ("ひゃく", "ろく"), ("びゃく", "ろく"), ("ぴゃく", "ろく"), ("いち", "いち"), ("ろく", "ろく"), ("はち", "はち")]


def small_tsu(kana: str) -> str:
    """The last kana as a small tsu."""
    return kana[:-1] + "っ"


def sound_change(number: str, counter: str) -> tuple[bool, str]:
    """Whether the number is shortened before a counter, and the counter's reading after it."""
    row = next((r for r, kanas in ROWS.items() if counter[:1] and counter[0] in kanas), None)
    if row and row in SHORT_BEFORE.get(number, ""):
        return True, HALF.get(counter[0], counter[0]) + counter[1:]
    if row == "は" and number == "さん":
        return False, VOICE[counter[0]] + counter[1:]
    return False, counter


def sound_changes(number: str, counter: str) -> str:
    shortened, after = sound_change(number, counter)
    return (SHORT[number] if shortened else number) + after


def base_reading(known: list[str], read: str) -> str:
    """A counter's reading without the change that a number made: unvoiced if that is known, else as read if known, else the only known one."""
    plain = UNVOICE.get(read[:1], read[:1]) + read[1:]
    if plain and plain in known:
        return plain
    return known[0] if len(known) == 1 and read not in known else read


def counted_after(numeral: str, counter: str) -> str:
    """A read numeral and a counter's base reading together, changed as after the number that the numeral ends like."""
    for ending, number in LIKE:
        if numeral.endswith(ending):
            shortened, after = sound_change(number, counter)
            return (small_tsu(numeral) if shortened else numeral) + after
    return numeral + counter


#: The voiced kana that are spelled as they sound.
SOUNDS_LIKE = {"ち": "じ", "つ": "ず"}


def joined_reading(known: list[str], joined: str, seam: int) -> str | None:
    """The reading of two words joined at a place, given the readings known for the whole.

    None known, or this one: it stands. One that differs by voicing at the seam: that one. A single other one counts if it reads one of
    the parts so, else the joined one stands; of several others none can be chosen.
    """
    if not known or joined in known:
        return joined
    head, tail = joined[:seam], joined[seam:]
    heads = {tail[:1], VOICE.get(tail[:1]), HALF.get(tail[:1]), SOUNDS_LIKE.get(tail[:1])} - {None, ""}
    for reading in known:
        if any(reading == head + h + tail[1:] for h in heads):
            return reading
    if len(known) > 1:
        return None
    reads_head = head and known[0].startswith(head)
    reads_tail = any(known[0].endswith(h + tail[1:]) for h in heads)
    return known[0] if reads_head or reads_tail else joined


def joins_of(reading: str, parts: list[str]) -> list[tuple[bool, str]] | None:
    """For each junction of the parts' readings, whether a small tsu stands before it and the head (plain, voiced, half) after it; None if the parts can't read so.

    Plain forms are tried first at each junction, from the left.
    """
    heads = lambda p: [("plain", p[:1])] + [(n, t[p[0]]) for n, t in (("voiced", VOICE), ("half", HALF)) if p[:1] in t]
    options = [[("plain", parts[0][:1])], *map(heads, parts[1:])]

    def walk(i: int, at: int, found: list[tuple[bool, str]]) -> list[tuple[bool, str]] | None:
        if i == len(parts):
            return found if at == len(reading) else None
        for name, head in options[i]:
            whole = head + parts[i][1:]
            forms = [(False, whole)] + ([(True, small_tsu(whole))] if whole[-1:] in GEMINATING and i + 1 < len(parts) else [])
            for short, form in forms:
                if reading.startswith(form, at) and (out := walk(i + 1, at + len(form), [*found, (short, name)])) is not None:
                    return out
        return None

    found = walk(0, 0, [])
    return None if found is None else [(found[i][0], found[i + 1][1]) for i in range(len(parts) - 1)]


def split_municipality(reading: str, surface: str) -> list[tuple[str, str]]:
    """The county or city and what follows it, as (reading, surface) pairs; none unless there is exactly one way."""
    cuts = [
        [(reading[: r.end()], surface[: s.end()]), (reading[r.end() :], surface[s.end() :])]
        for mark, kana in (("郡", "ぐん"), ("市", "し"))
        for s in re.finditer(mark, surface)
        for r in re.finditer(f"(?={kana})", reading)
        if 0 < s.start() and s.end() < len(surface) and 0 < r.start() < len(reading) - len(kana)
        for r in [re.compile(kana).match(reading, r.start())]
    ]
    return cuts[0] if len(cuts) == 1 else []


def alignments(reading: str, surface: str, of_kanji: dict[str, list[str]], most: int = 64) -> list[list[tuple[str, str]]]:
    """The ways to read a surface character by character: kana as themselves, kanji by their readings, their heads voiced and their ends small tsu.

    Each way lists (plain reading, kanji). At most `most` ways are returned, those that take early readings first.
    """
    out: list[list[tuple[str, str]]] = []

    def forms(plain: str, first: bool) -> list[str]:
        heads = [plain[:1]] + ([] if first else [t[plain[0]] for t in (VOICE, HALF) if plain[:1] in t])
        ends = [plain[1:]] + ([small_tsu(plain[1:])] if len(plain) > 1 and plain[-1] in GEMINATING else [])
        return [h + e for h, e in product(heads, ends)]

    def walk(i: int, at: int, way: list[tuple[str, str]]) -> None:
        if len(out) == most:
            return
        if i == len(surface):
            if at == len(reading):
                out.append(way)
            return
        c = surface[i]
        if c not in of_kanji:
            if reading.startswith(c, at):
                walk(i + 1, at + 1, way)
            return
        for plain in of_kanji[c]:
            for form in forms(plain, i == 0):
                if reading.startswith(form, at):
                    walk(i + 1, at + len(form), [*way, (plain, c)])

    walk(0, 0, [])
    return out
