"""Encoding of a whole corpus with a public byte-level BPE tokenizer.

Merges are not replayed. An Aho-Corasick automaton over the vocabulary gives every token that begins at each byte; the encoder takes
the longest, goes on, and steps back to the next shorter one whenever the new token can't follow the one before it. Whether one
can is a property of the pair alone: undoing the merges of both next to their boundary, latest first, no pair across it may ever
have been merged earlier. Dead positions are remembered, so the work is linear in the text. Decoding reads an offset table.

Words repeat, so each worker keeps the ids of the pieces between single spaces that it has met (`KEEP` of them; beyond that
they are encoded anew).
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from ..plans.tables import spread, table, tokenizer_path

#: Fixed value: the public pattern that cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEEP = 300_000
_GAP = regex.compile(r" [\s]")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable bytes for themselves, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bpe:
    """Vocabulary, pair table and automaton of one vocabulary file (json with vocab and merges)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letter = byte_letters()
        as_bytes = {w: "".join(chr(letter[c]) for c in w) for w in model["vocab"] if all(c in letter for c in w)}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = {a + b for a, b in merges}
        self.ids: dict[str, int] = {as_bytes[w]: i for w, i in model["vocab"].items() if w in as_bytes and (len(w) == 1 or w in made)}
        vocab = model["vocab"]
        self.merged: dict[tuple[int, int], int] = {(vocab[a], vocab[b]): vocab[a + b] for a, b in merges}
        self.parts: dict[int, tuple[int, int]] = {}
        for pair, token in self.merged.items():
            self.parts.setdefault(token, pair)
        self.words = ahocorasick.Automaton()
        for w, i in self.ids.items():
            self.words.add_word(w, (i, len(w)))
        self.words.make_automaton()
        self.size = {i: len(w) for w, i in self.ids.items()}
        self.fits: dict[tuple[int, int], bool] = {}
        self.cut = regex.compile(PATTERN)
        self.known: dict[str, list[int]] = {}
        n = max(self.ids.values()) + 1
        self.offsets = np.zeros(n + 1, np.int64)
        for i, k in self.size.items():
            self.offsets[i + 1] = k
        self.offsets = np.cumsum(self.offsets)
        self.bytes = bytearray(int(self.offsets[-1]))
        for w, i in self.ids.items():
            self.bytes[self.offsets[i] : self.offsets[i + 1]] = w.encode("latin-1")

    def can_follow(self, a: int, b: int) -> bool:
        """Whether the merges leave token b right behind token a."""
        hit = self.fits.get((a, b))
        if hit is None:
            hit = self.fits[a, b] = self._can_follow(a, b)
        return hit

    def _can_follow(self, a: int, b: int) -> bool:
        merged, parts = self.merged, self.parts
        bound = len(merged) + 1_000_000
        while True:
            m = merged.get((a, b))
            if m is not None and m < bound:
                return False
            left, right = parts.get(a), parts.get(b)
            if left and (a > b or not right):  # a was made last: only what was merged before that counts
                bound, a = a, left[1]
            elif right:  # at equal rank the pair further left goes first
                bound, b = b + 1, right[0]
            else:
                return True

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one piece of the pattern."""
        s = piece.encode("utf-8").decode("latin-1")
        whole = self.ids.get(s)
        if whole is not None:
            return [whole]
        n = len(s)
        starts: list[list[int]] = [[] for _ in range(n)]
        for end, (token, k) in self.words.iter(s):
            starts[end - k + 1].append(token)  # ends grow, so each list goes from short to long
        out: list[int] = []
        left: list[int] = []  # of each chosen token: how many shorter ones remain to try
        dead = bytearray(n + 1)
        pos, tries = 0, len(starts[0])
        while pos < n:
            here = starts[pos]
            while tries:
                tries -= 1
                token = here[tries]
                if not dead[pos + self.size[token]] and (not out or self.can_follow(out[-1], token)):
                    break
            else:
                dead[pos] = 1
                token = out.pop()
                tries = left.pop()
                pos -= self.size[token]
                continue
            out.append(token)
            left.append(tries)
            pos += self.size[token]
            if pos < n:
                tries = len(starts[pos])
        return out

    def encode_chunk(self, chunk: str) -> list[int]:
        out: list[int] = []
        for piece in self.cut.findall(chunk):
            out += self.encode_piece(piece)
        if len(self.known) < KEEP:
            self.known[chunk] = out
        return out

    def encode_into(self, text: str, out: list[int]) -> None:
        """Appends the ids of a text. The pattern never joins two words over a single space, so chunks are cut there."""
        parts = text.split(" ")
        chunks = [parts[0], *[" " + p for p in parts[1:]]]
        if _GAP.search(text) or text.endswith(" "):  # runs of white space stay in one chunk
            joined = [chunks[0]]
            for c in chunks[1:]:
                if len(c) == 1 or c[1].isspace() and joined[-1][-1:].isspace():
                    joined[-1] += c
                else:
                    joined.append(c)
            chunks = joined
        get = self.known.get
        for c in chunks:
            ids = get(c)
            out.extend(ids if ids is not None else self.encode_chunk(c))

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if text:
            self.encode_into(text, out)
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        o = self.offsets
        return b"".join(self.bytes[o[i] : o[i + 1]] for i in ids).decode("utf-8", "replace")


_LOADED: dict[str, Bpe] = {}


def loaded(path: str) -> Bpe:
    """The tokenizer of a file, read once in each process."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def encoded(df: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """(key, ids) of each row: an empty list for an empty and for a null text. No shuffle; whole texts, whatever their length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for b in batches:
            flat: list[int] = []
            ends = [0]
            for t in b.column(1).to_pylist():
                if t:
                    bpe.encode_into(t, flat)
                ends.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.array(flat, np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=[key, "ids"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text of documents by byte_bpe_50k without special tokens."""
    return encoded(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id", "text", tokenizer_path("byte_bpe_50k.json"))
