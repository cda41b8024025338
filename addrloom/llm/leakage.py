"""Evaluation texts leaking into a corpus: an FM-index per shard of the corpus, searched backwards for the test phrases.

1. Texts are reduced to words: lower case, look-alikes and invisible characters resolved, tags and punctuation gone, words that a
   line break hyphenates joined. Only runs of words that all occur in some test item can hold a phrase of one; everything else
   is passed over, which loses no occurrence.
2. Each shard's runs become one integer text. Its suffix array (prefix doubling) gives the Burrows-Wheeler transform; a wavelet
   matrix answers how often a word occurs before a row. All phrases of `SEED` words of all items are searched at once, last word
   first, and located by stepping back to suffix positions sampled every `SAMPLE` words and at the begin of each run.
3. The phrases found in a document are chained per item and aligned with it, allowing changed, added and dropped words. A stretch
   of `WORDS` item words or more is a leak; overlapping stretches are merged into removal spans.

A shard is searched once its documents have `SHARD` words, all of them counted; only a single longer text goes beyond.
Null and empty texts hold nothing. Items with fewer than `WORDS` words never leak.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.charforms import fold
from ..plans.tables import spread, table

WORDS = 15
SEED = 3
SAMPLE = 8
SHARD = 3_000_000
#: Share of an item's stretch that must be found word for word, and words in a row that may differ.
ALIKE = 0.65
GAP = 4
#: Bytes of items up to which they are sent to the tasks as they are; more are searched in blocks of this size, one after the other.
ITEM_BYTES = 8_000_000

_BREAK = re.compile(r"(?<=\w)[-‐]\s*\n\s*(?=[a-z])")
#: Anything short in angle brackets within a line; across lines or beyond that length only what is built like a tag.
_TAG = re.compile(
    r"</?[a-zA-Z][^<>\n]{0,200}>|&(?:nbsp|amp|lt|gt|quot|#\d+);"
    r"""|</?[a-zA-Z][\w:-]*(?:\s+[\w:@.-]+\s*=\s*(?:"[^"<>]*"|'[^'<>]*'|[^\s"'<>=]+))*\s*/?>"""
)
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    """The words of a text without case, markup, punctuation, invisible characters and layout."""
    if not text.isascii():
        text = fold(text)
    if "<" in text or "&" in text:
        text = _TAG.sub(" ", text)
    if "-\n" in text or "- \n" in text:
        text = _BREAK.sub("", text)
    return _WORD.findall(text.lower())


class WaveletMatrix:
    """Ranks of symbols in a sequence: `rank(c, i)` counts c among the first i, for arrays of c and i at once."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(self.levels - 1, -1, -1):
            bit = (seq >> level) & 1
            ones = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(seq) - int(ones[-1]))
            seq = np.concatenate((seq[bit == 0], seq[bit == 1]))

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        begin, end = np.zeros_like(i), i.copy()
        for level, ones, zeros in zip(range(self.levels - 1, -1, -1), self.ones, self.zeros):
            set_ = ((c >> level) & 1).astype(bool)
            b1, e1 = ones[begin], ones[end]
            begin = np.where(set_, zeros + b1, begin - b1)
            end = np.where(set_, zeros + e1, end - e1)
        return end - begin


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Suffix array of a sequence of non-negative integers in which 0 ends a run; no suffix is compared beyond the end of its run."""
    n = len(seq)
    ends = np.flatnonzero(seq == 0)
    rank = seq.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))  # each end is a symbol of its own
    sa = np.argsort(rank, kind="stable")
    width = 1
    while True:
        first = np.empty(n, bool)
        first[0] = True
        r = rank[sa]
        np.not_equal(r[1:], r[:-1], out=first[1:])
        dense = np.cumsum(first) - 1
        rank[sa] = dense
        if dense[-1] == n - 1:
            return sa
        # only suffixes that share their rank are sorted further
        tied = ~first
        tied[:-1] |= ~first[1:]
        rows = np.flatnonzero(tied)
        at = sa[rows]
        nxt = np.where(at + width < n, rank[np.minimum(at + width, n - 1)], -1) + 1
        order = np.argsort(rank[at] * (n + 1) + nxt, kind="stable")
        sa[rows] = at[order]
        group = rank[at[order]]
        step = np.ones(len(rows), np.int64)
        key = nxt[order]
        step[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        # ranks within a group grow by the rows before it in that group
        start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        place = np.arange(len(rows)) - np.repeat(start, np.diff(np.r_[start, len(rows)]))
        lead = np.maximum.accumulate(np.where(step == 1, np.arange(len(rows)), 0))
        rank[sa] = np.maximum.accumulate(np.where(first, np.arange(n), 0))  # row number of the group's first row
        rank[at[order]] = rows - place + place[lead]
        width *= 2


class FMIndex:
    """Backward search and location over an integer text whose runs end with 0."""

    def __init__(self, seq: np.ndarray, sigma: int):
        sa = suffix_array(seq)
        self.n = len(seq)
        bwt = seq[sa - 1]
        bwt[sa == 0] = 0
        self.bwt = bwt
        self.ranks = WaveletMatrix(bwt, sigma)
        self.before = np.zeros(sigma + 1, np.int64)
        np.cumsum(np.bincount(seq, minlength=sigma), out=self.before[1:])
        self.kept = (sa % SAMPLE == 0) | (bwt == 0)
        self.place = np.cumsum(self.kept) - 1
        self.samples = sa[self.kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of the suffixes that begin with each phrase (rows of `phrases`)."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.n, np.int64)
        for c in phrases.T[::-1]:
            lo = self.before[c] + self.ranks.rank(c, lo)
            hi = self.before[c] + self.ranks.rank(c, hi)
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes in `rows`: steps back word by word to a sampled position. The first position of every run is
        one, so no step crosses the 0 of the run before, whose row isn't in the order of what follows it."""
        out = np.full(len(rows), -1, np.int64)
        open_, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(open_):
            hit = self.kept[at]
            out[open_[hit]] = self.samples[self.place[at[hit]]] + steps
            open_, at = open_[~hit], at[~hit]
            if not len(open_):
                break
            c = self.bwt[at]
            at = self.before[c] + self.ranks.rank(c, at)
            steps += 1
        return out


class Items:
    """The test items as word ids, and the table of their phrases."""

    def __init__(self, items: list[tuple[int, str]]):
        self.vocab: dict[str, int] = {}
        self.words: dict[int, list[int]] = {}
        where: dict[tuple[int, ...], list[tuple[int, int]]] = defaultdict(list)
        for item, text in items:
            w = words_of(text or "")
            if item is None or len(w) < WORDS:
                continue
            ids = [self.vocab.setdefault(x, len(self.vocab) + 1) for x in w]
            self.words[item] = ids
            for p in range(len(ids) - SEED + 1):
                where[tuple(ids[p : p + SEED])].append((item, p))
        self.phrases = np.array(list(where), np.int64).reshape(-1, SEED)
        self.where = list(where.values())


def _stretch(item: list[int], doc: list[int]) -> tuple[int, int, int, int, int]:
    """The longest alike stretch of an item in a window of a document: (item words, words found, item begin, doc begin, doc end)."""
    best = (0, 0, 0, 0, 0)
    blocks = [b for b in SequenceMatcher(None, item, doc, autojunk=False).get_matching_blocks() if b.size]
    i = 0
    while i < len(blocks):
        j = i
        while j + 1 < len(blocks) and blocks[j + 1].a - blocks[j].a - blocks[j].size <= GAP and blocks[j + 1].b - blocks[j].b - blocks[j].size <= GAP + 2:
            j += 1
        run = blocks[i : j + 1]
        # single words at either end that only happen to fit
        while len(run) > 1 and run[0].size == 1 and run[1].a - run[0].a > 2:
            run = run[1:]
        while len(run) > 1 and run[-1].size == 1 and run[-1].a - run[-2].a - run[-2].size > 1:
            run = run[:-1]
        span = run[-1].a + run[-1].size - run[0].a
        found = sum(b.size for b in run)
        if span > best[0] and found >= ALIKE * span:
            best = (span, found, run[0].a, run[0].b, run[-1].b + run[-1].size)
        i = j + 1
    return best


class Shard:
    """Documents gathered until their runs fill a shard, then searched."""

    def __init__(self, items: Items):
        self.items = items
        self.clear()

    def clear(self) -> None:
        self.docs: list[int] = []
        self.ids: list[np.ndarray] = []
        self.size = 0

    def add(self, doc: int, text: str) -> None:
        get = self.items.vocab.get
        w = [get(x, 0) for x in words_of(text)]
        a = np.array(w, np.int32)
        known = a > 0
        if known.sum() < SEED:
            return
        self.docs.append(doc)
        self.ids.append(a)
        self.size += len(a)

    def leaks(self) -> list[tuple[int, int, int, int, int, int]]:
        """(doc, item, item words, words found, first and last word of the document) of each leak; empties the shard."""
        if not self.docs:
            return []
        length = np.array([len(a) for a in self.ids])
        flat = np.concatenate([np.r_[a, 0] for a in self.ids])
        doc_of = np.repeat(np.arange(len(self.docs)), length + 1)
        begin = np.r_[0, np.cumsum(length + 1)[:-1]]
        # runs of known words of a phrase's length or more
        known = flat > 0
        edge = np.flatnonzero(np.diff(np.r_[False, known, False].astype(np.int8)))
        s, e = edge[::2], edge[1::2]
        long = e - s >= SEED
        keep = np.zeros(len(flat) + 1, bool)
        mark = np.zeros(len(flat) + 2, np.int32)
        np.add.at(mark, s[long], 1)
        np.add.at(mark, e[long] + 1, -1)  # each run with the 0 behind it
        keep = np.cumsum(mark)[: len(flat)] > 0
        at = np.flatnonzero(keep)
        out: list[tuple[int, int, int, int, int, int]] = []
        if len(at):
            seq = flat[at].astype(np.int64)
            last = np.r_[at[1:] != at[:-1] + 1, True] & (seq > 0)
            if last.any():  # a run at the very end of the text has no 0 of its own
                seq = np.insert(seq, np.flatnonzero(last) + 1, 0)
                at = np.insert(at, np.flatnonzero(last) + 1, -1)
            index = FMIndex(seq, len(self.items.vocab) + 1)
            lo, hi = index.search(self.items.phrases)
            n = hi - lo
            which = np.repeat(np.arange(len(n)), n)
            rows = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(int(n.sum()))
            pos = at[index.locate(rows)]
            hits: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
            for d, k, q in zip(doc_of[pos].tolist(), (pos - begin[doc_of[pos]]).tolist(), which.tolist()):
                for item, p in self.items.where[q]:
                    hits[d, item].append((k, p))
            for (d, item), found in hits.items():
                for span, same, kb, ke in self._verified(self.items.words[item], self.ids[d], found):
                    out.append((self.docs[d], item, span, same, kb, ke))
        self.clear()
        return out

    @staticmethod
    def _verified(item: list[int], doc: np.ndarray, found: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
        """Leaks among the phrases (doc position, item position) found of one item in one document."""
        found.sort()
        groups: list[list[tuple[int, int]]] = []
        reach = len(item) + len(item) // 2 + 10
        for k, p in found:
            if groups and k - groups[-1][-1][0] <= 2 * WORDS and k - groups[-1][0][0] <= reach:
                groups[-1].append((k, p))
            else:
                groups.append([(k, p)])
        out = []
        for g in groups:
            if len({p for _, p in g}) < 2:  # a stretch of 15 words with few changes has several phrases
                continue
            a, b = max(0, g[0][0] - 12), g[-1][0] + SEED + 12
            span, same, _, kb, ke = _stretch(item, doc[a:b].tolist())
            if span >= WORDS:
                out.append((span, same, a + kb, a + ke))
        return out


LEAKS = "doc_id bigint, item_id bigint, item_words int, found_words int, first_word int, last_word int"


def leaks(documents: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
    """One row per stretch of an item (item_id, text) found in a document (doc_id, text). No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(Items(items))

        def rows() -> pa.RecordBatch:
            cols = list(zip(*shard.leaks())) or [()] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i < 2 else pa.int32()) for i, c in enumerate(cols)], names=[x.split()[0] for x in LEAKS.split(", ")])

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if text and doc is not None:
                    shard.add(doc, text)
                    if shard.size >= SHARD:
                        yield rows()
        yield rows()

    return documents.select("doc_id", "text").mapInArrow(run, LEAKS)


def _stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leaked stretch of an item with its place in the document, overlapping ones apart."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    out, block, size = None, [], 0
    for r in table(spark, sf_dir, "evaluation_items").select("item_id", "text").toLocalIterator():
        block.append((r.item_id, r.text))
        size += len(r.text or "")
        if size >= ITEM_BYTES:
            part = leaks(docs, block)
            out, block, size = (out.unionAll(part) if out else part), [], 0
    part = leaks(docs, block)
    return out.unionAll(part) if out else part


def merged(stretches: DataFrame) -> DataFrame:
    """Overlapping stretches of a document, of whatever items, with the place of the whole removal span: words first_word to before last_word."""
    by_place = Window.partitionBy("doc_id").orderBy("first_word", "last_word")
    reach = F.max("last_word").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("first_word") < reach, 0).otherwise(1)
    spans = stretches.withColumn("begins", begins).withColumn("span", F.sum("begins").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    of = Window.partitionBy("doc_id", "span")
    spans = spans.withColumns({"first_word": F.min("first_word").over(of), "last_word": F.max("last_word").over(of)})
    return spans.groupBy("doc_id", "item_id", "first_word", "last_word").agg(F.max("item_words").alias("item_words"), F.max("found_words").alias("found_words"))


def p9_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The removal spans by item: the items of one span share its place, and each has the words of its longest stretch there."""
    return merged(_stretches(spark, sf_dir)).select("doc_id", "item_id", "item_words", "found_words", "first_word", "last_word")


def p9_removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The removal spans of each document, no two of which overlap, with the items in them."""
    return p9_spans(spark, sf_dir).groupBy("doc_id", "first_word", "last_word").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items that each document contains."""
    return _stretches(spark, sf_dir).select("doc_id", "item_id").distinct()
