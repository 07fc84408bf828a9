"""Language identification by words first, then by ever shorter character n-grams.

Training counts the words and the character n-grams (5 to 1, with word edges) of labelled documents by language, from a
bounded sample: about `SAMPLE_DOCS` rows by a hash of their id, dealt out evenly among the languages so that a small one keeps all it
has, none of them held out. Every word and n-gram of the sample is in the model. A known word adds its log frequency in each language. An
unseen word is covered from left to right: at each place the longest known n-gram, of five characters at most, adds
its log frequency, and a character without any is skipped. Frequencies are smoothed, and a language's total is the same for
words and n-grams of one length, so the sums are log likelihoods. The score is the normalised likelihood of the best
language, per square root of the number of words, which keeps long texts from being all equally certain.

The model is a sorted table of 64-bit hashes with the languages and log frequencies of each, a few bytes for each that the sample
holds; it's counted on the executors, comes to the driver as Arrow columns and is sent to all of them.

Defined results: a null text, or one without a letter, is `und` with score 0; letters without any known n-gram get
the most frequent language with its share as score; ties go to the smallest name; repeated rows are predicted alike; an empty
table gives an empty result; without any labelled row every document is `und`; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from lexforge.llm.arrow import map_texts
from lexforge.llm.bagminhash import mix
from lexforge.runtime import materialize

SAMPLE_DOCS, LONGEST = 20_000, 5
UNKNOWN = "und"
_ODD = np.uint64(0x9E3779B97F4A7C15)
SMOOTHING = 0.1
#: The kind of a count: an n-gram by its length, or a word.
WORD = LONGEST + 1
#: Numbers in the rows of all remembered words; forgetting costs time only. Words that are learned together.
REMEMBERED, TOGETHER = 500_000, 20_000
#: Word characters that are neither letters nor digits: fractions, superscripts, circled and Roman numbers.
_NUMBERS = "".join(c for c in map(chr, range(0x80, 0x20000)) if c.isnumeric() and not c.isdecimal() and not c.isalpha())
_ODD_NUMBERS, _BLANK = frozenset(_NUMBERS), dict.fromkeys(map(ord, _NUMBERS), " ")
_RUNS = re.compile(r"[^\W\d_]+")


def held_out(id_col: str) -> Column:
    """Whether a document is left out of training."""
    return F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 5 == 0


def words_of(text: str) -> list[str]:
    """The runs of letters of a text in lower case."""
    if not text.isascii() and not _ODD_NUMBERS.isdisjoint(text):
        text = text.translate(_BLANK)
    return _RUNS.findall(text.lower())


class Cut:
    """The code points of many words with their edges, and 64-bit hashes of what stands in them."""

    def __init__(self, words: list[str]):
        self.code = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        self.size = np.fromiter(map(len, words), np.int64, len(words)) + 2
        self.end = np.cumsum(self.size)
        self.start = self.end - self.size
        self.owner = np.repeat(np.arange(len(words)), self.size)
        #: By place: how many code points of its word are left.
        self.left = self.end[self.owner] - np.arange(len(self.code)) if len(self.code) else np.zeros(0, np.int64)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The places where an n-gram starts, and its hash."""
        at = np.flatnonzero(self.left >= n)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = mix(h * _ODD + self.code[at + k])
        return at, h

    def words(self) -> np.ndarray:
        """The hash of each word: of its places mixed with their code points, and of its length."""
        if not len(self.size):
            return np.zeros(0, np.uint64)
        place = (np.arange(len(self.code)) - self.start[self.owner]).astype(np.uint64)
        return mix(np.add.reduceat(mix(self.code * _ODD + mix(place + np.uint64(1))), self.start) + self.size.astype(np.uint64) * _ODD)


class Model:
    """Log frequencies by language of hashed words and n-grams, as a base for each language and what a key adds to it."""

    def __init__(self, langs: list[str], docs: list[int], kinds: np.ndarray, keys: np.ndarray, lang: np.ndarray, n: np.ndarray):
        """`docs` counts the documents of each language; the arrays hold one count for each kind, key and language."""
        self.langs = langs
        self.share = np.array(docs, float) / max(1, sum(docs))
        order = np.argsort(keys, kind="stable")
        kinds, keys, lang, n = kinds[order], keys[order], lang[order], n[order]
        self.keys, self.first = np.unique(keys, return_index=True)
        self.first = np.append(self.first, len(keys)).astype(np.int64)
        self.lang = lang.astype(np.uint16)
        self.more = np.log((n + SMOOTHING) / SMOOTHING).astype(np.float32)
        self.base = np.zeros((WORD + 1, len(langs)))
        kind_of_key = kinds[self.first[:-1]]
        for kind in range(1, WORD + 1):
            own = kinds == kind
            total = np.bincount(lang[own], weights=n[own], minlength=len(langs)) if own.any() else np.zeros(len(langs))
            self.base[kind] = np.log(SMOOTHING) - np.log(total + SMOOTHING * max(1, int((kind_of_key == kind).sum())))
        self._forget()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("row_of", "rows", "used")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._forget()

    def _forget(self) -> None:
        self.row_of: dict[str, int] = {}
        #: By remembered word: the log likelihood in each language, and 1 if anything of the word is known.
        self.rows, self.used = np.zeros((1024, len(self.langs) + 1)), 0

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of hashed keys in the table, and whether they are there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def _cover(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, kind, place in the table) of the longest known n-grams that cover each word from left to right."""
        cut = Cut(words)
        longest, place = np.zeros(len(cut.code), np.int64), np.zeros(len(cut.code), np.int64)
        for n in range(LONGEST, 0, -1):
            at, key = cut.grams(n)
            new = longest[at] == 0
            at, key = at[new], key[new]
            found, known = self._find(key)
            longest[at[known]], place[at[known]] = n, found[known]
        now, used = cut.start.copy(), []
        while len(live := np.flatnonzero(now < cut.end)):
            at = now[live]
            used.append(at[longest[at] > 0])
            now[live] = at + np.maximum(longest[at], 1)
        used = np.concatenate(used) if used else np.zeros(0, np.int64)
        return cut.owner[used], longest[used], place[used]

    def _learn(self, words: list[str], forget: bool = True) -> None:
        """Remember the rows of words that aren't yet."""
        width = len(self.langs)
        if forget and (self.used + len(words)) * (width + 1) > REMEMBERED:
            self._forget()
        start, self.used = self.used, self.used + len(words)
        if self.used > len(self.rows):
            self.rows = np.concatenate((self.rows[:start], np.zeros((max(self.used, 2 * start) - start, width + 1))))
        at, known = self._find(Cut(words).words())
        whole, unseen = np.flatnonzero(known), np.flatnonzero(~known)
        part, kinds, places = self._cover([words[i] for i in unseen])
        owner = np.concatenate((whole, unseen[part]))
        kind = np.concatenate((np.full(len(whole), WORD), kinds))
        place = np.concatenate((at[whole], places))
        size = self.first[place + 1] - self.first[place]
        entry = np.repeat(self.first[place] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        cell = np.repeat(owner, size) * width + self.lang[entry]
        more = np.bincount(cell, weights=self.more[entry], minlength=len(words) * width).reshape(len(words), width)
        used = np.bincount(owner * (WORD + 1) + kind, minlength=len(words) * (WORD + 1)).reshape(len(words), WORD + 1)
        self.rows[start : self.used, :-1] = used @ self.base + more
        self.rows[start : self.used, -1] = used.any(axis=1)
        self.row_of.update(zip(words, range(start, self.used), strict=True))

    def predict_all(self, texts: list[str]) -> list[tuple[str, float]]:
        """The language and score of each text; the words of as many texts as hold `TOGETHER` new ones are learned at once."""
        out, waiting, new = [], [], set()
        for text in texts:
            words = words_of(text) if self.langs else []
            waiting.append(words)
            new.update(set(words).difference(self.row_of))
            if len(new) >= TOGETHER:
                out += self._judge(waiting, new)
                waiting, new = [], set()
        return out + self._judge(waiting, new)

    def _judge(self, cut: list[list[str]], new: set[str]) -> list[tuple[str, float]]:
        if new:
            remembered = self.used
            self._learn(list(new))
            if self.used < remembered + len(new):  # the others were forgotten for these
                if missing := set().union(*cut).difference(self.row_of):
                    self._learn(list(missing), forget=False)
        prior, out = np.log(np.maximum(self.share, 1e-9)), []
        for words in cut:
            if not words:
                out.append((UNKNOWN, 0.0))
                continue
            total = self.rows[np.fromiter(map(self.row_of.__getitem__, words), np.int64, len(words))].sum(axis=0)
            n, total = total[-1], total[:-1] + prior
            if n == 0:
                best = int(np.argmax(self.share))
                out.append((self.langs[best], float(self.share[best])))
                continue
            p = np.exp((total - total.max()) / math.sqrt(n))
            best = int(np.argmax(total))
            out.append((self.langs[best], float(p[best] / p.sum())))
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text or ""])[0]


def _quota(counts: list[int], most: int) -> int:
    """The largest number of rows that each group may give, if it has them, so that all give `most` together at most; 1 at least."""
    left, quota = most, 1
    for i, n in enumerate(sorted(counts)):
        quota = max(1, left // (len(counts) - i))
        if n > quota:
            break
        left -= n
    return quota


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Count words and n-grams of a bounded sample of labelled documents on the executors."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter(~held_out("id") & F.col("lang").isNotNull())
    of = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    langs = sorted(of)
    if not langs:
        return Model([], [], *(np.zeros(0, np.int64) for _ in range(4)))
    quota = _quota(list(of.values()), sample_docs)
    shares = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, quota / of[k])))])
    code = F.create_map(*[x for i, k in enumerate(langs) for x in (F.lit(k), F.lit(i))])
    # The hash of the id between 0 and 1, so that the same rows are taken whatever the partitions.
    place = F.shiftrightunsigned(F.xxhash64("id"), 11) / F.lit(2.0**53)
    sample = rows.filter(place < shares[F.col("lang")]).select(code[F.col("lang")].alias("lang"), "text")

    def count(batches):
        counts: dict[int, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts.setdefault(lang, Counter()).update(words_of(text or ""))
        for lang, found in counts.items():
            words, times = list(found), np.fromiter(found.values(), np.int64, len(found))
            for s in range(0, len(words), 100_000):
                cut, k = Cut(words[s : s + 100_000]), times[s : s + 100_000]
                for kind in range(1, WORD + 1):
                    at, keys = cut.grams(kind) if kind < WORD else (None, cut.words())
                    own, inverse = np.unique(keys, return_inverse=True)
                    n = np.bincount(inverse, weights=k if at is None else k[cut.owner[at]], minlength=len(own)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), kind, np.int8)), pa.array(own.view(np.int64)), pa.array(np.full(len(own), lang, np.int32)), pa.array(n)], ["kind", "key", "lang", "n"])

    counts = sample.mapInArrow(count, "kind tinyint, key bigint, lang int, n bigint").groupBy("kind", "key", "lang").agg(F.sum("n").alias("n"))
    found = materialize(counts).toArrow()  # bounded by the sample
    kind, key, lang, n = (found.column(c).to_numpy() for c in ("kind", "key", "lang", "n"))
    return Model(langs, [of[x] for x in langs], kind.astype(np.int64), key.view(np.uint64), lang.astype(np.int64), n)


def predict(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """All columns of the documents as a struct `doc`, with `lang_pred` and `score`; the model's size is bounded by the training sample."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(text_col).alias("_text"))

    def step(batch: pa.RecordBatch, texts: list[str]) -> dict:
        found = shared.value.predict_all(texts)
        return {"doc": batch.column(0), "lang_pred": [x for x, _ in found], "score": [x for _, x in found]}

    schema = StructType([rows.schema["doc"], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return map_texts(rows, "_text", schema, step)
