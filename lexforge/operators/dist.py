"""Packaging: source records, checks before a release, and the catalogue."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Record:
    sha256: str
    pairs: str | None
    sources: tuple[str, ...]


def record_text(content: bytes, sources: list[str], pairs: str | None = None) -> str:
    """`# sha256 H`, `# pairs H` for a model that belongs to a dictionary, then the source ids in order."""
    head = [f"# sha256 {hashlib.sha256(content).hexdigest()}", *([f"# pairs {pairs}"] if pairs else [])]
    return "\n".join([*head, *sorted(set(sources))]) + "\n"


def parse_record(text: str) -> Record:
    fields = dict(line[2:].split(" ", 1) for line in text.splitlines() if line.startswith("# "))
    if "sha256" not in fields:
        raise ValueError("a record starts with its content's sha256")
    return Record(fields["sha256"], fields.get("pairs"), tuple(x for x in text.splitlines() if x and not x.startswith("#")))


def catalogue(artifacts: dict[str, tuple[bytes, str]], base: str, notices: dict[str, str]) -> list[dict]:
    """An entry for each artifact (content, record), the base first. ValueError for a stale hash, a model that pairs with another base, or a source without a notice."""
    out = []
    for name in sorted(artifacts, key=lambda n: (n != base, n)):
        content, record = artifacts[name][0], parse_record(artifacts[name][1])
        own = hashlib.sha256(content).hexdigest()
        if own != record.sha256:
            raise ValueError(f"{name}: its record is of other content")
        if record.pairs and record.pairs != hashlib.sha256(artifacts[base][0]).hexdigest():
            raise ValueError(f"{name}: it was made for another base")
        if missing := [s for s in record.sources if not any(s.startswith(p) for p in notices)]:
            raise ValueError(f"{name}: no notice for {missing[0]}")
        texts = dict.fromkeys(notices[p] for s in record.sources for p in sorted(notices) if s.startswith(p))
        out.append({"name": name, "sha256": own, "bytes": len(content), "notices": list(texts)})
    return out


def shared_line(lines: DataFrame, base: DataFrame) -> str | None:
    """A line of a dictionary that the base has as well, or None; such a release is refused."""
    found = lines.select("reading", "surface").join(base.select("reading", "surface"), ["reading", "surface"], "left_semi").limit(1).collect()
    return "\t".join(found[0]) if found else None
