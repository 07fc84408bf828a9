"""Text out of mark-up: line finishing, HTML, wiki text, titles and categories."""

from __future__ import annotations

import html
import re
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from lexforge.functions import kana

#: Elements that start a new line, and those whose content isn't text.
BLOCKS = frozenset("address article aside blockquote br caption dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split())
SILENT = frozenset("script style template noscript head rt rp".split())


def finish_lines(text: Column, japanese_only: bool = False) -> Column:
    """The trimmed lines that aren't empty; with `japanese_only`, those with kana or kanji."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.filter(lines, is_japanese) if japanese_only else lines


def is_japanese(x: Column) -> Column:
    return x.rlike(f"[{kana.HIRAGANA}{kana.KATAKANA}{kana.KANJI}]")


def normalize_text(text: str) -> str:
    """NFC; half-width kana become full-width, full-width letters and signs become ASCII, digits stay."""
    out = []
    for run in re.findall(r"[｡-ﾟ]+|[^｡-ﾟ]+", text):
        out.append(unicodedata.normalize("NFKC", run) if "｡" <= run[0] <= "ﾟ" else run)
    full = {c: c - 0xFEE0 for c in [*range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B)]}
    return unicodedata.normalize("NFC", "".join(out)).translate(full)


@F.pandas_udf(StringType())
def normalize(text: pd.Series) -> pd.Series:
    return text.map(normalize_text, na_action="ignore")


class _Lines(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.depth = [""], 0

    def handle_starttag(self, tag, attrs):
        if tag in SILENT:
            self.depth += 1
        elif tag in BLOCKS:
            self.lines.append("")

    def handle_endtag(self, tag):
        if tag in SILENT:
            self.depth = max(0, self.depth - 1)
        elif tag in BLOCKS:
            self.lines.append("")

    def handle_data(self, data):
        if not self.depth:
            self.lines[-1] += data


def html_lines_of(page: str) -> list[str]:
    """The text lines of a page: blocks are apart, white space runs are one space, silent elements are left out."""
    parser = _Lines()
    parser.feed(page)
    parser.close()
    return [x for x in (" ".join(line.split()) for line in parser.lines) if x]


@F.pandas_udf(ArrayType(StringType()))
def html_lines(page: pd.Series) -> pd.Series:
    return page.map(html_lines_of, na_action="ignore")


def without_nested(text: str, opening: str, closing: str) -> str:
    """The text without what stands between matching pairs, nested ones included; an unmatched opening stays."""
    out, stack, at = [], [], 0
    for m in re.finditer(f"{re.escape(opening)}|{re.escape(closing)}", text):
        if m[0] == opening:
            out.append(text[at : m.start()])
            stack.append(len(out))
            out.append(opening)
            at = m.end()
        elif stack:
            del out[stack.pop() :]
            at = m.end()
    return "".join(out) + text[at:]


def strip_wikitext_of(text: str) -> str:
    """Prose lines of wiki text: comments, references, templates, tables, media and mark-up are left out, link labels stay."""
    text = re.sub(r"<!--.*?-->", "", text, flags=re.S)
    text = re.sub(r"<(ref|gallery|math|score|timeline|syntaxhighlight)\b[^>]*?/>", "", text, flags=re.I)
    text = re.sub(r"<(ref|gallery|math|score|timeline|syntaxhighlight)\b[^>]*>.*?</\1\s*>", "", text, flags=re.S | re.I)
    text = without_nested(without_nested(text, "{|", "|}"), "{{", "}}")
    while True:  # innermost links first, so that captions with links go as a whole
        new = re.sub(r"\[\[(?!(?i:file|image|category|ファイル|画像|カテゴリ)\s*:)(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", r"\1", text)
        new = re.sub(r"\[\[(?i:file|image|category|ファイル|画像|カテゴリ)\s*:[^\[\]]*\]\]", "", new)
        if new == text:
            break
        text = new
    text = re.sub(r"\[(?:https?|ftp)://\S+\s+([^\]]*)\]", r"\1", text)
    text = re.sub(r"\[(?:https?|ftp)://\S+\]", "", text)
    text = re.sub(r"'{2,5}", "", text)
    text = re.sub(r"<br\s*/?>", "\n", text, flags=re.I)
    text = html.unescape(re.sub(r"</?[a-zA-Z][^>]*>", "", text))
    lines = []
    for line in text.split("\n"):
        if re.fullmatch(r"\s*(=+).*\1\s*|-{4,}.*", line):
            continue
        line = re.sub(r"^[*#:;]+\s*", "", line).strip()
        line = re.sub(r"[（(]\s*[、,;；\s]*[）)]", "", line)
        if line:
            lines.append(line)
    return "\n".join(lines)


@F.pandas_udf(StringType())
def strip_wikitext(text: pd.Series) -> pd.Series:
    return text.map(strip_wikitext_of, na_action="ignore")


def categories_of(text: Column) -> Column:
    """The names of a wiki text's categories, sort keys left out."""
    return F.transform(F.regexp_extract_all(text, F.lit("\\[\\[(?i:category|カテゴリ)\\s*:\\s*([^\\]|]+)"), 1), lambda x: F.trim(x))


def is_disambiguation(text: Column) -> Column:
    return text.rlike("(?i)\\{\\{\\s*(?:aimai|disambig|曖昧さ回避|人名の曖昧さ回避|地名の曖昧さ回避)")


def name_of(title: Column) -> Column:
    """A title without the qualifier in brackets at its end."""
    return F.regexp_replace(title, "\\s*[（(][^（）()]*[）)]$", "")


def title_reading(title: Column, text: Column) -> Column:
    """The reading of a title: the kana that follow the bold title in brackets; a katakana title reads as itself."""
    bold = F.concat(F.lit("'''"), name_of(title), F.lit("'''"))
    at = F.instr(text, bold)
    after = F.substr(text, at + F.length(bold), F.lit(200))
    found = F.regexp_extract(after, f"^\\s*[（(]\\s*([{kana.HIRAGANA}{kana.KATAKANA}{kana.LONG}]+)", 1)
    return F.when(name_of(title).rlike(f"^[{kana.KATAKANA}{kana.LONG}]+$"), kana.to_hiragana(name_of(title))).when((at > 0) & (found != ""), kana.to_hiragana(found))


def keyword_class(text: Column, wanted: list[str], unwanted: list[str], at_least: int = 3, below: int = 2) -> Column:
    """Whether a text has at least three of the wanted keywords and fewer than two of the unwanted ones."""
    n = lambda words: sum((text.contains(w).cast("int") for w in words), F.lit(0))
    return (n(wanted) >= at_least) & (n(unwanted) < below)
