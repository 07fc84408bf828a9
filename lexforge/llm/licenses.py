"""Licence scans: an Aho-Corasick automaton over words finds notice phrases and identifier tags, and a shunting-yard
parser evaluates the and/or/with expressions that stand after a tag.

Phrases are matched word by word, so white space, punctuation and letter case between them don't matter. All places where a
phrase stands are found, overlapping ones too. An expression's labels are its known identifiers; its freedom is the
greater of both sides for `or`, the lesser for `and`, and a little more than its left side's for `with`. The score of a text
is the freedom of its strictest notice, 0 without any.

Defined results: a null text counts as empty: no words, no places, null first and last word, empty labels, score 0; an
expression that can't be parsed counts as its known identifiers joined by `and`; repeated rows are scanned each on their
own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from lexforge.llm.arrow import map_texts

#: The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Further notice phrases.
NOTICES = {
    "the mit license": "mit",
    "mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "apache license 2 0": "apache-2",
    "apache 2 0 license": "apache-2",
    "licensed under the apache license": "apache-2",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "isc license": "isc",
    "mozilla public license": "mpl-2",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "eclipse public license": "epl-2",
    "boost software license": "bsl-1",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by 4 0": "cc-by",
    "cc by 3 0": "cc-by",
    "cc0 1 0": "cc0",
    "released into the public domain": "public-domain",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"
#: What stands after a tag, up to the end of the line or the next tag.
TAG_PATTERN = re.compile(r"SPDX-License-Identifier[ \t]*:[ \t]*((?:(?!SPDX-License-Identifier[ \t]*:)[^\n\r*])+)", re.I | re.A)
#: How freely a text under a label may be used.
FREEDOM = {
    "public-domain": 1.0, "cc0": 1.0, "mit": 0.95, "isc": 0.95, "bsd": 0.9, "bsd-2-clause": 0.9, "bsd-3-clause": 0.9, "bsl-1": 0.9, "apache-2": 0.9,
    "cc-by": 0.85, "mpl-2": 0.6, "epl-2": 0.6, "lgpl": 0.5, "cc-by-sa": 0.5, "gpl": 0.35, "agpl": 0.3, "cc-by-nd": 0.25, "cc-by-nc": 0.2, "proprietary": 0.05,
}
#: Identifiers by prefix, longest first.
IDENTIFIERS = {
    "mit": "mit", "isc": "isc", "bsd-2-clause": "bsd-2-clause", "bsd-3-clause": "bsd-3-clause", "0bsd": "bsd", "bsd": "bsd", "apache-2": "apache-2", "bsl-1": "bsl-1", "mpl-2": "mpl-2",
    "epl-2": "epl-2", "lgpl": "lgpl", "agpl": "agpl", "gpl": "gpl", "cc0": "cc0", "cc-by-nc": "cc-by-nc", "cc-by-sa": "cc-by-sa", "cc-by-nd": "cc-by-nd", "cc-by": "cc-by", "unlicense": "public-domain",
}
LONGEST_IDENTIFIER = max(map(len, IDENTIFIERS))
WITH_BONUS = 0.05
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_TOKENS = re.compile(r"[()]|[A-Za-z0-9.+-]+|\S")

#: ASCII letters in lower case, digits as they are, other ASCII characters as spaces; bytes of other characters stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """All phrases and the tag, each between spaces; its size is that of the lists above."""
    a = ahocorasick.Automaton()
    for phrase, label in [*NOTICES.items(), *BASE.items(), (TAG, None)]:
        a.add_word(f" {phrase} ", (phrase in BASE, label, len(phrase.split()), len(phrase) + 2))
    a.make_automaton()
    return a


def label_of(identifier: str) -> str | None:
    """The label of an SPDX identifier."""
    name = identifier.lower().rstrip("+.")
    for length in range(min(len(name), LONGEST_IDENTIFIER), 0, -1):
        if (label := IDENTIFIERS.get(name[:length])) and (length == len(name) or not name[length].isalpha()):
            return label
    return None


def to_postfix(tokens: list[str]) -> list[str]:
    """Shunting yard: operands straight to the output, operators by precedence, parentheses on the stack. ValueError if malformed."""
    out, stack, operand = [], [], False
    for token in tokens:
        word = token.lower()
        if word in _PRECEDENCE:
            if not operand:
                raise ValueError("an operator needs an operand before it")
            while stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[word]:
                out.append(stack.pop())
            stack.append(word)
            operand = False
        elif token == "(":
            if operand:
                raise ValueError("an operator is missing")
            stack.append(token)
        elif token == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack or not operand:
                raise ValueError("parentheses don't match")
            stack.pop()
        else:
            if operand:
                raise ValueError("an operator is missing")
            out.append(token)
            operand = True
    if not operand or "(" in stack:
        raise ValueError("the expression isn't complete")
    return out + stack[::-1]


def evaluate(expression: str) -> tuple[set[str], float | None]:
    """The labels of a licence expression and its freedom; None if no identifier is known."""
    tokens = _TOKENS.findall(expression)
    # The expression ends where prose begins: after an operand that no operator follows.
    end, operand = 0, False
    for i, token in enumerate(tokens):
        if token.lower() in _PRECEDENCE:
            operand = False
        elif token not in "()":
            if operand or not re.fullmatch(r"[A-Za-z0-9.+-]+", token):
                break
            operand = True
        end = i + 1
    tokens = [t.rstrip(".") or t for t in tokens[:end]]
    try:
        postfix = to_postfix(tokens)
    except ValueError:
        found = {x for t in tokens if (x := label_of(t))}
        return found, min((FREEDOM[x] for x in found), default=None)
    stack: list[tuple[set[str], float | None]] = []
    for token in postfix:
        if token in _PRECEDENCE:
            (b, q), (a, p) = stack.pop(), stack.pop()
            if token == "with":
                stack.append((a, None if p is None else min(1.0, p + WITH_BONUS)))
            else:
                known = [x for x in (p, q) if x is not None]
                stack.append((a | b, (max if token == "or" else min)(known) if known else None))
        else:
            label = label_of(token)
            stack.append(({label} if label else set(), FREEDOM.get(label)))
    return stack[0]


def scan_text(text: str) -> dict:
    """Words, base places, first and last base word, labels, expressions and score of a text."""
    words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split()
    line = " " + b" ".join(words).decode("latin-1") + " "
    starts, base, labels, freedom, tagged = [], set(), set(), [], False
    seen, word = 0, -1  # places are met in order of their ends; the words up to `seen` are counted once
    for end, (is_base, label, n, length) in automaton().iter(line):
        if label is None:
            tagged = True
            continue
        labels.add(label)
        freedom.append(FREEDOM[label])
        if is_base:
            base.add(label)
            word, seen = word + line.count(" ", seen, end), end
            starts.append(word - n + 1)
    expressions = []
    if tagged:
        for m in TAG_PATTERN.finditer(text):
            found, p = evaluate(m[1])
            labels |= found
            expressions.append(m[1].strip())
            if p is not None:
                freedom.append(p)
    return {"n_words": len(words), "starts": sorted(starts), "base_labels": sorted(base), "labels": sorted(labels), "expressions": expressions, "score": min(freedom, default=0.0)}


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, starts, base_labels, labels, expressions, score); starts are the word indexes of all base places."""
    rows = docs.select(id_col, text_col)

    def step(batch: pa.RecordBatch, texts: list[str]) -> dict:
        found = [scan_text(t) for t in texts]
        return {id_col: batch.column(0)} | {k: [f[k] for f in found] for k in ("n_words", "starts", "base_labels", "labels", "expressions", "score")}

    kind = dict(rows.dtypes)[id_col]
    return map_texts(rows, text_col, f"`{id_col}` {kind}, n_words bigint, starts array<bigint>, base_labels array<string>, labels array<string>, expressions array<string>, score double", step)
