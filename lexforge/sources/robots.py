"""robots.txt: reading the rules of an agent, and deciding on paths."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def rules_of(robots: str, agent: str) -> list[tuple[str, bool]]:
    """(pattern, allow) of the groups that name the agent, else of those for all; empty patterns say nothing."""
    groups: list[tuple[list[str], list[tuple[str, bool]]]] = []
    opened = False
    for line in robots.splitlines():
        field, _, value = line.partition("#")[0].partition(":")
        field, value = field.strip().lower(), value.strip()
        if field == "user-agent":
            if not opened:
                groups.append(([], []))
            groups[-1][0].append(value.lower())
            opened = True
        elif field in ("allow", "disallow") and groups:
            opened = False
            if value:
                groups[-1][1].append((value, field == "allow"))
    named = [g for g in groups if any(n != "*" and n in agent.lower() for n in g[0])]
    return [r for g in named or [g for g in groups if "*" in g[0]] for r in g[1]]


def pattern_of(rule: str) -> str:
    """A rule as a regular expression: `*` is any run, a final `$` the end."""
    ends = rule.endswith("$")
    body = ".*".join(re.escape(x) for x in (rule[:-1] if ends else rule).split("*"))
    return f"^{body}{'$' if ends else ''}"


def allowed(path: Column, rules: list[tuple[str, bool]]) -> Column:
    """The verdict of the longest rule that matches, Allow at a tie; without one, allowed. Rules are tried longest first, so Spark stops at the first."""
    out = None
    for rule, allow in sorted(rules, key=lambda r: (-len(r[0]), not r[1])):
        match = path.rlike(pattern_of(rule))
        out = F.when(match, allow) if out is None else out.when(match, allow)
    return F.lit(True) if out is None else out.otherwise(True)
