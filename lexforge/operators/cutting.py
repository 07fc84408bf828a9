"""The unit cutter: from a document's analyzed tokens to all its units, with the words beside them and what follows each.

A line's tokens are dealt into numbers and the stretches between them. A stretch gets its affixes joined and is cut into words
with stems; words that auxiliaries make, and the analyzer's compounds that no unit spells already, stand beside the words. Each rule
reads its neighbours in one line only, so documents are cut where they lie, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from lexforge.functions import kana, words
from lexforge.operators.japanese import HIRAGANA, Token, corrected, end_of, join_affixes, join_auxiliaries, number_at, units_of

UNIT = (
    "doc_id string, position long, reading string, surface string, stem_reading string, stem_surface string, conjugation string, unknown_conjugation string, "
    "value string, kana string, compound boolean, parts array<struct<reading: string, surface: string>>, particle string, suru string, copula string"
)
_TO_HIRAGANA = str.maketrans(kana._KATA + "ヰヱ", kana._HIRA + "いえ")


def read_as_written(token: Token) -> Token:
    """A token in katakana alone, but for the rare ones, reads as it is written."""
    if not re.fullmatch("[ァ-ヴー]+", token.surface):
        return token
    return Token(token.surface, token.surface.translate(_TO_HIRAGANA), token.pos, token.dictionary_form, token.begin)


def stretches(tokens: list[Token], lexicon: dict[str, list[str]]) -> Iterator[tuple[list[Token], dict | None]]:
    """The tokens between numbers, each with the unit of the number after it, if that makes one."""
    start = i = 0
    while i < len(tokens):
        end, unit = number_at(tokens, i, lexicon)
        if end > i:
            yield tokens[start:i], unit and unit | {"end": end_of(tokens[end - 1])}
            start = end
        i = max(end, i + 1)
    yield tokens[start:], None


def is_plain_word(reading: str, surface: str) -> bool:
    return bool(re.fullmatch(f"[{HIRAGANA}ー]+", reading)) and not re.search(words.NO_START, reading) and not re.search(rf"[\s゛゜、]|{words.NO_END}", surface)


def only_numbers(tokens: list[Token]) -> bool:
    """Whether tokens are numbers with or without counters and nothing else."""
    i = 0
    while i < len(tokens):
        end, _ = number_at(tokens, i)
        if end == i:
            return False
        i = end
    return True


def compound_units(compounds: list[Token], tokens: list[Token], units: list[dict]) -> list[dict]:
    """The analyzer's longer nouns that are words of their own: no numbers alone, and none that a unit spells at the same place."""
    spelled = {(u["position"], u["surface"]) for u in units}
    out = []
    for c in compounds:
        inside = [t for t in tokens if c.begin <= t.begin < end_of(c)]
        written = re.fullmatch(f"[{HIRAGANA}ー]+", c.surface) is None
        if c.pos[0] == "名詞" and written and is_plain_word(c.reading, c.surface) and not only_numbers(inside) and (c.begin, c.surface) not in spelled:
            out.append({"position": c.begin, "reading": c.reading, "surface": c.surface})
    return out


def follows(tokens: list[Token]) -> dict[int, dict]:
    """What starts at each place in hiragana, right after the word that ends there: a particle, する, or the copula of an adjectival word."""
    out, adjectival = {}, {end_of(t) for t in tokens if t.pos[0] == "形状詞" or t.pos[2].endswith("形状詞可能")}
    for t in tokens:
        if re.fullmatch(f"[{HIRAGANA}]+", t.surface):
            kinds = {
                "particle": t.pos[0] == "助詞",
                "suru": (t.pos[0], t.pos[4], t.dictionary_form) == ("動詞", "サ行変格", "する"),
                "copula": (t.pos[0], t.pos[4]) == ("助動詞", "助動詞-ダ") and t.begin in adjectival,
            }
            out[t.begin] = {k: t.surface for k, yes in kinds.items() if yes}
    return out


def line_units(tokens: list[Token], compounds: list[Token] = (), lexicon: dict[str, list[str]] | None = None) -> list[dict]:
    """All units of a line by place; `compound` marks those that stand beside the words they are made of, `parts` what an unknown joined word was made of."""
    lexicon = lexicon or {}
    own, beside = [], []
    for between, number in stretches([read_as_written(t) for t in tokens], lexicon):
        joined, parts = join_affixes(between, lexicon)
        own += [u | {"parts": [{"reading": t.reading, "surface": t.surface} for t in parts.get(u["position"], [])]} for u in units_of(joined)]
        made, places = join_auxiliaries(joined)
        beside += units_of([t for t in made if t.begin in places])
        own += [number] if number else []
    beside += compound_units(list(compounds), tokens, own)
    after = follows(tokens)
    out = [{"end": u["position"] + len(u["surface"]), "parts": []} | u | {"compound": c} for units, c in ((own, False), (beside, True)) for u in units]
    return [u | after.get(u["end"], {}) for u in sorted(out, key=lambda u: u["position"])]


def text_units(
    docs: DataFrame, tokenize: Callable[[str], tuple[list[Token], list[Token]]], *, lexicon: dict[str, list[str]] | None = None, corrections: dict[str, str] | None = None
) -> DataFrame:
    """The units of documents (doc_id, text), with positions in code points of the whole text.

    `tokenize` reads a line into its tokens and the longer compounds. The lexicon's readings decide how joined words read. A null text
    has no units; a document without an id keeps its units, under a null id.
    """
    schema = to_arrow_schema(_parse_datatype_string(UNIT))

    def of_text(doc: str | None, text: str) -> list[dict]:
        rows, offset = [], 0
        for line in text.split("\n"):
            tokens, compounds = tokenize(line)
            found = line_units(corrected(tokens, corrections or {}), compounds, lexicon)
            rows += [u | {"doc_id": doc, "position": u["position"] + offset} for u in found]
            offset += len(line) + 1
        return rows

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                units = of_text(batch.column(0)[row].as_py(), batch.column(1)[row].as_py() or "")
                yield pa.RecordBatch.from_pylist([{n: u.get(n) for n in schema.names} for u in units], schema)

    return docs.select(docs["doc_id"].cast("string"), "text").mapInArrow(cut, UNIT)
