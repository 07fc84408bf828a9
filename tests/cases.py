"""Tokens of literal test lines."""

from lexforge.operators.japanese import Token


def line(*words):
    """Tokens that stand one after another: (surface, reading, part of speech, form it inflects as, dictionary form)."""
    out, at = [], 0
    for word in words:
        surface, reading, pos, *more = word
        kind = tuple(pos.split("-")) + ("*",) * (4 - len(pos.split("-")))
        conjugation, form = more[0] if more else ("*", "*")
        out.append(Token(surface, reading, (*kind, conjugation, form), more[1] if len(more) > 1 else surface, at))
        at += len(surface)
    return out
