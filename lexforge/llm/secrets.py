"""Secrets in whole texts: fixed patterns, and values in a credential context that would be costly to guess.

The guess cost of a value is the least sum, over all ways to cut it into spans, of the bits of each span plus one bit for
each cut: a word costs the logarithm of its rank in a list (plus case and look-alike digits), a date the logarithm of the
days it may name, a repeat its unit and count, a keyboard walk its start, length and turns, and anything else the
brute-force bits of its characters' kinds. Dynamic programming over the cut places finds the minimum. A value after a
credential word with `MIN_BITS` or more is reported as kind `cred`, unless a base pattern covers it.

The words of a list are those of all documents. The most common ones go to every worker. A value that is costly by them is
held against all the others by a join, and its text carries those that stand in it.

A value is costed in its whole length. The search ends early where each way to go on costs `MIN_BITS` already; the bits that
are returned are exact below `EXACT_BITS`, which stands for itself and more.

Defined results: a null text counts as empty and has no spans; positions are code points of the whole text; overlapping
spans of different kinds are all reported; repeated rows are scanned each on their own; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import base64
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.llm.arrow import blocks, map_texts
from lexforge.runtime import materialize

KINDS = ("assign", "access", "hex", "cred")
#: The base patterns and the least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGN = 8

#: A credential word, something that says what it is, perhaps a scheme, and the value: quoted, or up to the next white space.
CONTEXT = re.compile(r"""(?<![A-Za-z0-9])(?:(?:passwords?|passwd|passphrase|passcode|pwd|pass|pin|secrets?|tokens?|api[_ -]?keys?|access[_ -]?keys?|private[_ -]?keys?|credentials?|auth(?:orization)?|bearer)\b["']?\x20*(?:[:=]+>?|\bis\b|\bbearer\b)\x20*["'`]?(?:(?:bearer|basic|digest|negotiate|token|apikey)\x20+)?|bearer\x20+)["'`]?([^\s"'`,;<>(){}\[\]]{8,})""", re.I | re.A)
#: What stands before the password of a URL; the password goes up to the next @ and has neither white space nor quotes.
LOGIN = re.compile(r"""\b[a-z][a-z0-9+.-]{1,15}://[^\s:/@"']+:""", re.I | re.A)
MIN_LOGIN = 6
MIN_BITS = 40.0
#: Guess costs are exact below this and stop at it as a proven lower bound, so long values take linear time.
EXACT_BITS = 4096.0
#: Values up to this length are remembered, which saves time only.
REMEMBERED_CHARS = 256

#: Common passwords and credential words, most common first.
COMMON = """password admin root user guest test login welcome letmein master secret token default changeme public private
key access system server service account manager demo sample example dummy null none true false empty your insert here replace
monkey dragon football baseball sunshine princess shadow superman batman summer winter spring autumn january february march
april may june july august september october november december monday tuesday wednesday thursday friday saturday sunday
love hello world computer internet company office home money data base database production staging local host""".split()
#: Vocabularies whose whole words are ranked lists of their own: English and many languages, about 24,000 and 25,000 words.
VOCABULARIES = ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")
#: The words that a corpus adds: those in at least MIN_TEXTS different texts of all its documents. For each language the MAX_WORDS most
#: common go to every worker; the rest are joined to the values, so MAX_WORDS is a matter of time only.
MAX_WORDS, MIN_TEXTS = 20_000, 3
#: Places, a multiple of 64, where the texts that have copies leave a bit. A text that meets such a bit by chance is only compared as a whole too.
#: Words that aren't sent to every worker leave theirs likewise.
COPY_PLACES = 1 << 24
#: Words that a worker holds before it hands on what it has.
HELD_WORDS = 200_000
#: Characters of the beginnings by which words of one count are ranked.
PREFIX_CHARS = 4
WORDS = re.compile(r"(?<![^\W\d_])[^\W\d_]{3,40}(?![^\W\d_])")
LOOKALIKE = str.maketrans("013457@$!", "oleastasi")
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
KEY_AT = {c: (y, x + y * 0.5) for y, row in enumerate(KEY_ROWS) for x, c in enumerate(row)}
DATE = re.compile(r"(?:(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:0[1-9]|1[0-2])([-/._]?)(?:0[1-9]|[12]\d|3[01])\3(?:19|20)\d\d|(?:19|20)\d\d)")


class Ranks(dict):
    """Words in lower case with their best rank in any list."""

    __hash__ = object.__hash__  # as a key it stands for itself
    longest = 0

    def add(self, words: Iterable[str]) -> None:
        """A further list, most common word first."""
        for i, w in enumerate(words, 1):
            self[w] = min(i, self.get(w, i))
            self.longest = max(self.longest, len(w))


class Beside(Ranks):
    """Rarer words that stand in the values of one text, beside the ranks that all texts share."""

    def __init__(self, shared: Ranks, words: Iterable[tuple[str, int]]) -> None:
        super().__init__(words)
        self.shared = shared
        self.longest = max([shared.longest, *map(len, self)])
        self.remembered: dict[tuple[str, float], float] = {}

    def get(self, word: str, default: int | None = None) -> int | None:
        return min((r for r in (super(Beside, self).get(word), self.shared.get(word)) if r is not None), default=default)

    def __contains__(self, word: object) -> bool:
        return super().__contains__(word) or word in self.shared


@lru_cache(maxsize=1)
def listed() -> Ranks:
    """The ranks of the fixed lists."""
    out = Ranks()
    out.add(dict.fromkeys(COMMON))
    for name in VOCABULARIES:
        with open(public_tokenizers.path(name), "rb") as f:
            tokens = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, f))
        words = (t[1:].decode("utf-8", "replace").lower() for _, t in tokens if t.startswith(b" "))
        out.add(dict.fromkeys(w for w in words if WORDS.fullmatch(w)))
    return out


def _place(key: Column) -> list[Column]:
    """The block of 64 places and the bit in it for a key."""
    at = F.pmod(key, F.lit(COPY_PLACES))
    return [F.shiftright(at, 6), F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))]


def _marks(keys: DataFrame, key: Column) -> DataFrame:
    """(marked, bits): the places of the keys, as many rows as there are blocks at most."""
    block, bit = _place(key)
    return materialize(keys.groupBy(block.alias("marked")).agg(F.bit_or(bit).alias("bits")))


def _parted(rows: DataFrame, text_col: str, marks: DataFrame) -> list[DataFrame]:
    """The rows whose texts' places are marked, and the others, without a shuffle."""
    block, bit = _place(F.xxhash64(text_col))
    marks = F.broadcast(marks.select(F.col("marked").alias("_marked"), F.col("bits").alias("_bits")))
    met = (F.col("_block") == F.col("_marked")) & (F.col("_bit").bitwiseAND(F.col("_bits")) != 0)
    placed = rows.select("*", block.alias("_block"), bit.alias("_bit"))
    return [placed.join(marks, met, how).drop("_block", "_bit") for how in ("left_semi", "left_anti")]


def different_texts(rows: DataFrame) -> DataFrame:
    """(lang, text): each text once, with its least language. Only texts that may have copies are shuffled."""
    copies = rows.groupBy(F.xxhash64("text").alias("key")).agg(F.count("*").alias("n")).filter("n > 1")
    copied, single = _parted(rows, "text", _marks(copies, F.col("key")))
    return single.select("lang", "text").unionByName(copied.groupBy("text").agg(F.min("lang").alias("lang")))


def _counted(docs: DataFrame, text_col: str, lang_col: str) -> tuple[DataFrame, DataFrame]:
    """(lang, word, n): the texts that each word is in, by language, of all documents; and (text): the texts with a value that is costly by the fixed lists.

    Equal texts count once, and what stands in a credential context or a base span isn't counted, so a secret doesn't make itself a word.
    """
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("")) if lang_col in docs.columns else F.lit("")
    rows = different_texts(docs.filter(F.col(text_col).isNotNull()).select(lang.alias("lang"), F.col(text_col).alias("text")))
    fixed = docs.sparkSession.sparkContext.broadcast(listed())

    def found_in(counts: dict[str | None, Counter]) -> Iterator[pa.RecordBatch]:
        for name, c in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(c), pa.string()), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["lang", "word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str | None, Counter] = {}
        for batch, texts in blocks(batches, "text"):
            for name, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                base, values = _base(text), list(_values(text))
                places = [*((s, e) for _, s, e in base), *values]
                counts.setdefault(name, Counter()).update(set(WORDS.findall(_masked(text, places, " ").lower())))
                if _costly(text, base, values, fixed.value):
                    yield from found_in({None: Counter([text])})
            if sum(map(len, counts.values())) > HELD_WORDS:
                yield from found_in(counts)
                counts = {}
        yield from found_in(counts)

    found = rows.mapInArrow(count, "lang string, word string, n bigint")
    found = materialize(found.groupBy("lang", "word").agg(F.sum("n").alias("n")).filter(F.col("lang").isNull() | (F.col("n") >= MIN_TEXTS)))
    return found.filter("lang is not null"), found.filter("lang is null").select(F.col("word").alias("text"))


def _common(found: DataFrame) -> tuple[Ranks, dict[str, int]]:
    """The fixed lists and the most common words of each language; and the least count of those, by language."""
    # The least count of each language that at most MAX_WORDS words have; equal counts stay together.
    least: dict[str, int] = {}
    so_far: Counter = Counter()
    for r in found.groupBy("lang", "n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).collect():
        so_far[r["lang"]] += r["words"]
        if so_far[r["lang"]] <= MAX_WORDS:
            least[r["lang"]] = r["n"]
    out = Ranks()
    out.update(listed())
    out.longest = listed().longest
    if least:
        limits = found.sparkSession.createDataFrame(list(least.items()), "lang string, least bigint")
        kept: dict[str, list] = {}
        for r in found.join(F.broadcast(limits), "lang").filter("n >= least").collect():
            kept.setdefault(r["lang"], []).append((-r["n"], r["word"]))
        for words in kept.values():
            out.add(w for _, w in sorted(words))
    return out, least


def word_ranks(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> Ranks:
    """The fixed lists and, for each language of the documents, the most common words by the number of texts they are in, of all documents."""
    return _common(_counted(docs, text_col, lang_col)[0])[0]


def _rest(found: DataFrame, least: dict[str, int]) -> DataFrame:
    """(word, rank): the words below the least counts, with their best rank in the whole list of a language."""
    limits = found.sparkSession.createDataFrame(list(least.items()), "lang string, least bigint")
    rest = found.join(F.broadcast(limits), "lang", "left").filter("least is null or n < least").select("lang", "word", "n", F.substring("word", 1, PREFIX_CHARS).alias("prefix"))
    # A rank is the number of words of greater counts, of those of its count with lesser beginnings, and its place among the others.
    before = lambda w: F.coalesce(F.sum("words").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    levels = found.groupBy("lang", "n").agg(F.count("*").alias("words")).select("lang", "n", before(Window.partitionBy("lang").orderBy(F.desc("n"))).alias("above"))
    groups = rest.groupBy("lang", "n", "prefix").agg(F.count("*").alias("words")).select("lang", "n", "prefix", before(Window.partitionBy("lang", "n").orderBy("prefix")).alias("lesser"))
    rest = rest.withColumn("place", F.row_number().over(Window.partitionBy("lang", "n", "prefix").orderBy("word")))
    rank = F.col("above") + F.col("lesser") + F.col("place")
    return rest.join(groups, ["lang", "n", "prefix"]).join(levels, ["lang", "n"]).groupBy("word").agg(F.min(rank).alias("rank"))


def _stretches(value: str) -> Iterator[str]:
    """All stretches of a value that may be a listed word, as its letters stand or with look-alikes."""
    low = _lower(value)
    for form in dict.fromkeys((low, low.translate(LOOKALIKE))):
        for m in re.finditer(r"[^\W\d_]{3,}", form):
            for i in range(m.start(), m.end() - 2):
                for j in range(i + 3, min(i + 40, m.end()) + 1):
                    yield form[i:j]


def word_lists(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> tuple[Ranks, DataFrame | None]:
    """The ranks of the common words; and (mark, key, words): for texts with values that are costly by these, all other words in those values with their ranks.

    A text is named by its hashes: mark is the short one, key the long one. None if no text has any.
    """
    found, texts = _counted(docs, text_col, lang_col)
    common, least = _common(found)
    if texts.isEmpty():
        return common, None
    rest = materialize(_rest(found, least))
    places = np.zeros(COPY_PLACES // 64, "<i8")
    marks = _marks(rest, F.crc32(F.col("word").cast("binary"))).toArrow()
    places[marks["marked"].to_numpy()] = marks["bits"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast((common, COPY_PLACES, places.tobytes()))

    def handed(found: list[tuple[int, str, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.string(), pa.string()))], ["mark", "key", "word"])

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, n_places, bits = shared.value
        found: list[tuple[int, str, str]] = []
        for batch, texts in blocks(batches, "text"):
            for mark, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
                for value in {text[s:e] for s, e in _costly(text, _base(text), _values(text), ranks)}:
                    for word in _stretches(value):
                        at = zlib.crc32(word.encode()) % n_places
                        if bits[at >> 3] >> (at & 7) & 1:
                            found.append((mark, key, word))
                            if len(found) >= HELD_WORDS:
                                yield handed(found)
                                found = []
        if found:
            yield handed(found)

    named = texts.select(F.xxhash64("text").alias("mark"), F.sha2("text", 256).alias("key"), "text")
    hits = named.mapInArrow(seek, "mark bigint, key string, word string").join(rest, "word")
    hits = materialize(hits.groupBy("mark", "key").agg(F.map_from_entries(F.collect_set(F.struct("word", "rank"))).alias("words")))
    return common, None if hits.isEmpty() else hits


def beside(rows: DataFrame, text_col: str, rarer: DataFrame | None) -> DataFrame:
    """Add the rarer words of each text as `_rarer`, mostly null. Only rows whose texts may have some are shuffled."""
    if rarer is None:
        return rows.withColumn("_rarer", F.lit(None).cast("map<string,bigint>"))
    marked, others = _parted(rows, text_col, _marks(rarer, F.col("mark")))
    words = rarer.select(F.col("key").alias("_key"), F.col("words").alias("_rarer"))
    marked = marked.join(words, F.sha2(text_col, 256) == F.col("_key"), "left").drop("_key")
    return marked.unionByName(others.withColumn("_rarer", F.lit(None).cast("map<string,bigint>")))


def ranks_of(batch: pa.RecordBatch, common: Ranks) -> list[Ranks]:
    """The ranks for each row of a batch that has `_rarer`."""
    return [Beside(common, words) if words else common for words in batch.column(batch.schema.get_field_index("_rarer")).to_pylist()]


def _char_bits(value: str) -> float:
    """Brute-force bits of one character, from the kinds of characters that occur in the value."""
    size = 26 * any("a" <= c <= "z" for c in value) + 26 * any("A" <= c <= "Z" for c in value) + 10 * any("0" <= c <= "9" for c in value)
    size += 33 * any(c.isascii() and not c.isalnum() for c in value) + 100 * any(not c.isascii() for c in value)
    return math.log2(max(size, 2))


def _walks(value: str, low: str, i: int, limit: float) -> list[tuple[int, float]]:
    """(end, bits) of the keyboard walks and alphabet runs from a place, of three keys or more, whose bits are below a limit."""
    out, turns, last = [], 0, None
    for j in range(i + 1, len(low)):
        a, b = KEY_AT.get(low[j - 1]), KEY_AT.get(low[j])
        step = (b[0] - a[0], round(2 * (b[1] - a[1]))) if a and b and abs(a[0] - b[0]) <= 1 and abs(a[1] - b[1]) <= 1.01 and a != b else None
        if step is None:
            break
        turns += step != last
        last = step
        if 3 * turns >= limit:
            break
        if j - i >= 2:
            out.append((j + 1, math.log2(47) + math.log2(j - i + 1) + 3 * turns))
    for delta in (1, -1):
        j = i + 1
        while j < len(low) and low[j].isalnum() and ord(low[j]) - ord(low[j - 1]) == delta:
            j += 1
            if j - i >= 3:
                out.append((j, math.log2(62) + math.log2(j - i) + 1))
    return out


def guess_bits(value: str, limit: float = EXACT_BITS, ranks: Ranks | None = None) -> float:
    """The bits of the cheapest segmentation of a value, or the limit if they reach it."""
    ranks = listed() if ranks is None else ranks
    if len(value) > REMEMBERED_CHARS:
        return _bits(value, limit, ranks)
    if not isinstance(ranks, Beside):
        return _remembered_bits(value, limit, ranks)
    if (value, limit) not in ranks.remembered:
        ranks.remembered[value, limit] = _bits(value, limit, ranks)
    return ranks.remembered[value, limit]


def _lower(value: str) -> str:
    """Lower case, one character for one, so that places are those of the value."""
    return "".join(c if len(c.lower()) != 1 else c.lower() for c in value)


def _bits(value: str, limit: float, ranks: Ranks) -> float:
    n, each = len(value), _char_bits(value)
    low = _lower(value)
    plain = low.translate(LOOKALIKE)
    best = [0.0] + [math.inf] * n
    brute = [False] * (n + 1)  # whether the cheapest way to a place ends in brute force, which may go on without a cut
    same = [0] * 17  # for each length of a unit, the place up to which characters equal those one unit later
    last = 0  # the last place that was reached for less than the limit
    for i in range(n):
        if best[i] >= limit:  # no way through this place stays below
            if i > last:
                return limit
            continue
        base, cut = best[i], 0.0 if i == 0 else 1.0
        found = [(i + 1, each, True)]
        for j in range(i + 3, min(n, i + ranks.longest) + 1):
            if (rank := ranks.get(low[i:j]) or ranks.get(plain[i:j])) is not None:
                odd = sum(c.isupper() for c in value[i + 1 : j]) + (low[i:j] not in ranks)
                found.append((j, math.log2(rank) + 1 + (value[i].isupper()) + 2 * odd, False))
        if m := DATE.match(value, i):
            found.append((m.end(), math.log2(365.0 * 120) + 2 if m.end() - i > 4 else math.log2(120), False))
        for end, bits in _walks(value, low, i, limit):
            found.append((end, bits, False))
        for unit in range(1, min(16, (n - i) // 2) + 1):
            end = max(same[unit], i)
            while end + unit < n and value[end] == value[end + unit]:
                end += 1
            same[unit] = end
            j = i + unit + (end - i) // unit * unit
            if j - i >= max(3, 2 * unit):
                found.append((j, min(unit * each, guess_bits(value[i : i + unit], ranks=ranks) if unit < n - i and unit > 2 else math.inf) + math.log2((j - i) // unit), False))
        for j, bits, by_force in found:
            total = base + bits + (0.0 if by_force and brute[i] else cut)
            if total < best[j]:
                best[j], brute[j] = total, by_force
                if total < limit:
                    last = max(last, j)
    return min(best[n], limit)


_remembered_bits = lru_cache(maxsize=50_000)(_bits)


def _logins(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the passwords in URLs, in one pass over the text."""
    at = 0
    while "://" in text and (end := text.find("@", at)) >= 0:
        start = max(at, *(text.rfind(c, at, end) + 1 for c in " \t\n\r\f\v\"'"))
        if (m := LOGIN.search(text, start, end)) and end - m.end() >= MIN_LOGIN:
            yield m.end(), end
        at = end + 1


def _values(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the values in a credential context."""
    for s, e in [*(m.span(1) for m in CONTEXT.finditer(text)), *_logins(text)]:
        yield s, s + len(text[s:e].rstrip(".!?"))


def _base(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns."""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    return out + [("hex", *m.span()) for m in HEX.finditer(text)]


def _costly(text: str, base: list[tuple[str, int, int]], values: Iterable[tuple[int, int]], ranks: Ranks | None) -> list[tuple[int, int]]:
    """The values outside the base spans that would be costly to guess."""
    return [(s, e) for s, e in values if e - s >= 6 and not any(a <= s and e <= b for _, a, b in base) and guess_bits(text[s:e], MIN_BITS, ranks) >= MIN_BITS]


def spans_of(text: str, ranks: Ranks | None = None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all spans, by start, then kind as listed."""
    base = _base(text)
    out = base + [("cred", s, e) for s, e in _costly(text, base, _values(text), ranks)]
    return sorted(set(out), key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, spans): array of (kind, start, end, bits); bits is the guess cost of a credential value, else null."""
    common, rarer = word_lists(docs, text_col=text_col, lang_col=lang_col)
    rows = beside(docs.select(id_col, text_col), text_col, rarer)
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def step(batch: pa.RecordBatch, texts: list[str]) -> dict:
        known = zip(texts, ranks_of(batch, shared.value), strict=True)
        spans = [[{"kind": k, "start": s, "end": e, "bits": guess_bits(t[s:e], ranks=r) if k == "cred" else None} for k, s, e in spans_of(t, r)] for t, r in known]
        return {id_col: batch.column(0), "spans": spans}

    kind = dict(rows.dtypes)[id_col]
    return map_texts(rows, text_col, f"`{id_col}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint,bits:double>>", step)


def _masked(text: str, places: list[tuple[int, int]], mark: str) -> str:
    out, at = [], 0
    for s, e in sorted(places):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redacted(text: str, mark: str, ranks: Ranks | None = None) -> str:
    """The text with each maximal stretch of spans replaced by a mark."""
    return _masked(text, [(s, e) for _, s, e in spans_of(text, ranks)], mark)
