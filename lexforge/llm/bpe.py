"""Byte-level BPE encoding and decoding with a pair occurrence index.

A block of texts is cut into pre-tokens. Those not met before are laid out as one array of byte symbols; an index maps
each adjacent pair that has a merge to all its positions in the block. The active ranks are taken in ascending order,
each merge is applied at all positions of its pair, and the lists of the pairs that appear to the left and right of a
merged symbol are extended. Ascending order is exact because a merge only creates pairs of a higher rank; `Vocabulary`
checks this when it reads the file.

Defined results: a null text encodes as an empty one; an empty text has no ids; equal texts have equal ids; rows are kept
one for one, repeated rows too; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import gc
import heapq
import json
import re
import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexforge.llm.arrow import map_texts

#: Entries that each of an encoder's two generations of remembered pieces holds; forgetting costs time only.
REMEMBERED = 200_000
#: The white space of the pre-tokeniser.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _ranges(kind: str, more: set[int]) -> str:
    """A character class of the code points whose general category starts with `kind`, and of `more`."""
    out, start = [], None
    for c in range(sys.maxunicode + 2):
        inside = c <= sys.maxunicode and (unicodedata.category(chr(c))[0] == kind or c in more)
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(out)


def _newer() -> tuple[set[int], set[int]]:
    """Letters and numbers that the tokenizers library knows but this Python's Unicode tables don't, told by the library itself."""
    import regex
    from tokenizers import pre_tokenizers

    cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    doubtful = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cn" and regex.match(r"[\p{L}\p{N}]", chr(c))]
    return {c for c in doubtful if len(cut("a" + chr(c))) == 1}, {c for c in doubtful if len(cut("1" + chr(c))) == 1}


@lru_cache(maxsize=1)
def pre_token_patterns() -> tuple[re.Pattern, re.Pattern]:
    """The pattern of pre-tokens for ASCII pieces and for all others."""
    make = lambda letter, number, space: re.compile(
        rf"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    )
    letters, numbers = _newer()
    return make("A-Za-z", "0-9", "\t-\r "), make(_ranges("L", letters), _ranges("N", numbers), SPACES)


#: A space that starts a word always starts a pre-token, so pieces between such spaces can be cut on their own.
PIECES = re.compile(f" (?=[^{SPACES}])")
WHITE_BUT_SPACE = frozenset(c for c in map(chr, range(0x21, 0x3001)) if re.match(f"[{SPACES}]", c)) | frozenset("\t\n\v\f\r")


def _byte_of() -> dict[str, int]:
    """The byte that each character of a vocabulary entry stands for: printable ones themselves, the rest from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Merges by pair, the bytes of each id, and the special tokens of a tokenizer file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, byte_of = spec["model"], _byte_of()
        if spec.get("normalizer") or model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("only byte-level BPE without a normaliser or prefix space is read")
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: bytes(byte_of[c] for c in s) if s not in self.special else s.encode() for s, i in ids.items()}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.byte_id = np.full(256, -1, np.int64)
        for c, b in byte_of.items():
            self.byte_id[b] = ids.get(c, -1)
        self.merges: list[tuple[int, int, int]] = []
        #: By symbol: the ranks of the pairs that it ends, by what stands before it, and of those that it starts.
        self.before: dict[int, dict[int, int]] = {}
        self.after: dict[int, dict[int, int]] = {}
        born: dict[int, int] = {int(i): -1 for i in self.byte_id}
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            x, y, new = ids[a], ids[b], ids[a + b]
            if x not in born or y not in born or new in born:
                raise ValueError(f"merge {rank} isn't of earlier symbols into a new one; ascending ranks would not be exact")
            born[new] = rank
            self.merges.append((x, y, new))
            self.before.setdefault(y, {})[x] = rank
            self.after.setdefault(x, {})[y] = rank
        self.first_rank = np.full((256, 256), -1, np.int32)
        id_byte = {int(i): b for b, i in enumerate(self.byte_id)}
        for rank, (x, y, _) in enumerate(self.merges):
            if x in id_byte and y in id_byte:
                self.first_rank[id_byte[x], id_byte[y]] = rank
        self.splitter = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None


def merge_words(vocabulary: Vocabulary, words: list[bytes]) -> list[bytes]:
    """The ids of each word, as little-endian unsigned 32-bit integers, by one pair occurrence index over all of them."""
    if not words:
        return []
    # One flat array with a wall (-1) before, between and after the words; -2 marks a symbol that was merged away.
    raw = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    walls = np.concatenate(([0], np.cumsum(lengths + 1)))
    symbols = vocabulary.byte_id[raw]
    symbols[walls] = -1
    ranks = vocabulary.first_rank[raw[:-1], raw[1:]]
    ranks[walls[:-1]] = -1
    ranks[walls[1:] - 1] = -1
    at = np.flatnonzero(ranks >= 0)
    at = at[np.argsort(ranks[at], kind="stable")]
    found, starts = np.unique(ranks[at], return_index=True)
    index: dict[int, list[int]] = {int(r): p.tolist() for r, p in zip(found, np.split(at, starts[1:]), strict=True)} if len(at) else {}
    active = list(index)
    heapq.heapify(active)
    sym, nxt, prv = symbols.tolist(), list(range(1, len(raw) + 1)), list(range(-1, len(raw) - 1))
    merges, befores, afters, push, pop = vocabulary.merges, vocabulary.before.get, vocabulary.after.get, heapq.heappush, heapq.heappop
    while active:
        rank = pop(active)
        places = index.pop(rank)
        a, b, new = merges[rank]
        before, after = befores(new), afters(new)
        if a == b:
            places.sort()  # overlapping pairs merge from the left
        for i in places:
            if sym[i] == a and sym[j := nxt[i]] == b:
                sym[i], sym[j], k = new, -2, nxt[j]
                nxt[i], prv[k] = k, i
                if before and (r := before.get(sym[p := prv[i]])) is not None:
                    if r in index:
                        index[r].append(p)
                    else:
                        index[r] = [p]
                        push(active, r)
                if after and (r := after.get(sym[k])) is not None:
                    if r in index:
                        index[r].append(i)
                    else:
                        index[r] = [i]
                        push(active, r)
    flat = np.array(sym, np.int64)
    flat = flat[flat != -2]
    ends = np.flatnonzero(flat == -1)
    packed = flat.astype("<u4").tobytes()
    return [packed[4 * s + 4 : 4 * e] for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def library_words(vocabulary: Vocabulary, words: list[bytes]) -> list[bytes]:
    """The same ids by a library's merge loop, for callers that only need ids; its ranks are the ids, which follow the merges."""
    from array import array

    if (codec := getattr(vocabulary, "codec", None)) is None:
        import tiktoken

        ranks = {b: i for i, b in vocabulary.bytes_of.items() if i not in vocabulary.special.values()}
        codec = vocabulary.codec = tiktoken.Encoding("own", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={})
    cut = codec._encode_single_piece
    return [array("I", cut(w)).tobytes() for w in words]


class Encoder:
    """Encodes whole texts; remembers the ids of recent pieces in two generations of bounded size."""

    def __init__(self, vocabulary: Vocabulary, merge=merge_words):
        self.vocabulary, self.merge = vocabulary, merge
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _cut(self, key: str) -> list[str]:
        """The pre-tokens of a piece."""
        piece = key[1:] if key[0] == " " else " " + key
        if key.isalpha():
            return [piece]
        if key[-1] in ",." and key[:-1].isalpha():
            return [piece[:-1], piece[-1]]
        return pre_token_patterns()[not piece.isascii()].findall(piece)

    def _learn(self, pieces: list[str]) -> None:
        """Find the ids of pieces that aren't remembered."""
        cut = [self._cut(p) for p in pieces]
        if len(self.words) > 2 * REMEMBERED:
            self.words.clear()
        words = list({w for ws in cut for w in ws if w not in self.words})
        self.words.update(zip(words, self.merge(self.vocabulary, [w.encode() for w in words]), strict=True))
        get = self.words.__getitem__
        self.young.update(zip(pieces, [get(ws[0]) if len(ws) == 1 else b"".join(map(get, ws)) for ws in cut], strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, packed as little-endian unsigned 32-bit integers."""
        vocabulary = self.vocabulary
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        # A key is what follows a space; that of a span's first piece, which follows none, starts with one.
        parts: list[list] = []
        for text in texts:
            own: list = []
            for n, span in enumerate(vocabulary.splitter.split(text) if vocabulary.splitter else [text]):
                if n % 2:
                    own.append(vocabulary.special[span].to_bytes(4, "little"))
                elif span:
                    keys = span.split(" ")
                    keys[0] = " " + keys[0]
                    own.append(keys)
            parts.append(own)
        missing = set().union(*[x for own in parts for x in own if isinstance(x, list)]).difference(young)
        # A space before white space starts no pre-token; texts with one are cut again.
        odd = {k for k in missing if not k or k[0] in WHITE_BUT_SPACE}
        if odd:
            missing -= odd
            for own in parts:
                for n, keys in enumerate(own):
                    if isinstance(keys, list) and not odd.isdisjoint(keys):
                        own[n] = PIECES.split(" ".join(keys)[1:])
                        own[n][0] = " " + own[n][0]
                        missing |= set(own[n]).difference(young)
        for k in [k for k in missing if k in old]:
            young[k] = old[k]
            missing.discard(k)
        tracked = gc.isenabled()
        gc.disable()  # nothing below makes cycles, and the remembered pieces are many
        self._learn(list(missing))
        if tracked:
            gc.enable()
        get = young.__getitem__
        return [b"".join([b"".join(map(get, x)) if isinstance(x, list) else x for x in own]) for own in parts]


_encoders: dict = {}


def shared_encoder(spec, merge=merge_words) -> Encoder:
    """The encoder of a broadcast tokenizer file, one for each Python worker."""
    if (key := (spec.id if hasattr(spec, "id") else id(spec), merge)) not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(Vocabulary(spec.value), merge)
    return _encoders[key]


def broadcast_tokenizer(df: DataFrame, path: str):
    """The tokenizer file, read on the driver; its size doesn't depend on the data."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the ids of each whole text as binary, little-endian unsigned 32-bit integers."""
    spec = broadcast_tokenizer(df, tokenizer)

    def step(batch: pa.RecordBatch, texts: list[str]) -> dict:
        return {id_col: batch.column(0), "ids": shared_encoder(spec).encode(texts)}

    rows = df.select(df[id_col], df[text_col])
    return map_texts(rows, text_col, f"`{id_col}` {dict(rows.dtypes)[id_col]}, ids binary", step)


def decode(df: DataFrame, tokenizer: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, text): the text of each list of ids, special tokens included; bytes that aren't UTF-8 become U+FFFD."""
    spec = broadcast_tokenizer(df, tokenizer)
    rows = df.select(df[id_col], df[ids_col])

    def run(batches):
        names = [id_col, ids_col, "text"]
        for batch in batches:
            get = shared_encoder(spec).vocabulary.bytes_of.__getitem__
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                texts = [b"".join(map(get, np.frombuffer(x or b"", "<u4").tolist())).decode("utf-8", "replace") for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names)

    return rows.mapInArrow(run, f"`{id_col}` {dict(rows.dtypes)[id_col]}, `{ids_col}` binary, text string")
