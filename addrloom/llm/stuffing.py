"""Keyword-stuffed and link-list pages: bagged trees over content and link features, smoothed by the spam rate of the host.

1. One pass over the whole texts gives `FEATURES` of every document. Among them every word is of one of three kinds: of a record if it
   lies in a line of an address book, an office directory or a log; of a sentence if function words (English, Hindi, Hindi in Latin
   letters) stand near it on both sides; else it is strung. A link or a tag is one word, and strung unless inside a sentence.
2. Weak labels: a document is spam if far more than half of its words are strung and there are more of them than a few; it is none
   if few are; between the two it has no label. `TRAIN_ROWS` labelled documents at most, half of each label, chosen by the
   hash of their ids, train bagged decision trees on the driver. This is the only bounded sample; every document is scored.
3. The trees' scores are averaged by host (`source`), drawn towards the corpus mean for hosts of few pages, and shift the log odds of
   the host's pages by at most `PULL`.

Documents without words (null, empty, blank) are never cases. Documents without a host keep the trees' score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.charforms import fold
from ..plans.tables import shared, small, spread, table
from .trees import BaggedTrees

#: Most labelled documents that train the trees.
TRAIN_ROWS = 20_000
#: Strung share from which a document is labelled spam, and up to which it is labelled none.
SURE, CLEAN = 0.6, 0.3
#: Strung words up to which they are a few links, tags or keywords below a short text.
A_FEW = 14
#: Pages that a host's rate is drawn towards the mean by, weight of the host, and its greatest shift of the log odds.
PAGES, HOST, PULL = 50.0, 0.5, 0.7
#: Words without a function word that a sentence may hold in a row, and that it may begin or end with.
INSIDE, AT_EDGE = 10, 7

_WORD = re.compile(r"[^\W_](?:[^\W_]|[ऀ-ॣ‌‍])*")
_END = re.compile(r"[.!?।](?=\s|$)")
_SEPARATOR = re.compile(r"[|,;•·]")
_LINK = re.compile(r"(?:https?://|www\.)\S+|#\w+")
_RECORD = re.compile(
    r"\d{4}-\d\d-\d\d[ T]\d\d:\d\d(?:\s+\w+=\S+)+"  # log
    r"|\b[1-9]\d{5}\b\s{0,3}[-,;:\t ]\s{0,3}[^\n]{3,60}?\b[SBH]\.O\b\.?,?[ \t]*\w+"  # office directory
    r"|\b\d{1,6}[\w/-]{0,8},\s[^\n!?]{6,90}?\b[1-9]\d{5}\b"  # address book
)
#: Words that sentences need and keywords do not; "in", "for", "near" and "me" belong to keywords too.
FUNCTION_WORDS = frozenset(
    """the a an of was were is are has have had and or not to that which who this these those it its we our they their he his she her
    with before after while because as but if then when although than from by on at into no did does do will would be been so only
    still every each
    के का की को में से पर और है हैं था थी थे गया गयी गई गए हुआ नहीं ने ही भी वाला वाली किया मिला देखा लिखा लौट बदल यह वह
    ka ke ki ko mein se par aur hai hain tha thi gaya gayi nahi nahin ne hi bhi wala wali kiya mila dekha yeh woh lekin isliye kal phir
    koi karo peeche paas""".split()
)


FEATURES = ("strung", "log_strung", "in_records", "in_sentences", "links", "tags", "distinct", "top_word", "repeated_pairs", "ends", "separators", "log_words")


def features(text: str) -> list[float]:
    """Numbers of `FEATURES` for one text; all 0 if it has no words."""
    if not text.isascii():
        text = fold(text)
    of_records = of_sentences = strung = links = tags = 0
    begin = 0
    parts, seen = [], []
    for m in _RECORD.finditer(text):
        of_records += len(_WORD.findall(m.group()))
        parts.append(text[begin : m.start()])
        begin = m.end()
    parts.append(text[begin:])
    for part in parts:
        found = _LINK.findall(part)
        links += sum(x[0] != "#" for x in found)
        tags += sum(x[0] == "#" for x in found)
        words = _WORD.findall(_LINK.sub(" link ", part).lower() if found else part.lower())
        seen += words
        at = [i for i, w in enumerate(words) if w in FUNCTION_WORDS]
        if not at:
            strung += len(words)
            continue
        of_sentences += len(at)
        ends = [-1, *at, len(words)]
        for a, b in zip(ends, ends[1:]):
            gap = b - a - 1
            if gap > (INSIDE if a >= 0 and b < len(words) else AT_EDGE):
                strung += gap
            else:
                of_sentences += gap
    n = of_records + of_sentences + strung
    if not n:
        return [0.0] * len(FEATURES)
    free = max(1, len(seen))
    counts = Counter(seen)
    pairs = Counter(zip(seen, seen[1:]))
    again = sum(c for c in pairs.values() if c > 1)
    return [
        strung / n, math.log1p(strung), of_records / n, of_sentences / n, links / n, tags / n, len(counts) / free,
        max(counts.values(), default=0) / free, again / max(1, len(seen) - 1), len(_END.findall(text)) / n, len(_SEPARATOR.findall(text)) / n, math.log1p(n),
    ]


def featured(documents: DataFrame) -> DataFrame:
    """(doc_id, source, features) of documents (doc_id, source, text) that have a word. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [features(t) if t else None for t in b.column(2).to_pylist()]
            keep = pa.array([r is not None and r[-1] > 0 for r in rows])
            out = pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "source", "features"])
            yield out.filter(keep)

    return documents.select("doc_id", "source", "text").mapInArrow(run, "doc_id bigint, source string, features array<double>")


def trained(pages: DataFrame) -> BaggedTrees:
    """Trees of at most `TRAIN_ROWS` weakly labelled rows of `pages`; each task keeps no more than it sends."""
    strung, count = F.get("features", F.lit(0)), F.get("features", F.lit(1))
    few = count <= math.log1p(A_FEW) + 1e-9
    label = F.when((strung >= SURE) & ~few, 1).when((strung <= CLEAN) | few, 0)
    rows = []
    for y in (0, 1):
        chosen = pages.withColumn("label", label).where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS // 2)
        rows += [(r.features, y) for r in chosen.select("features").collect()]
    x = np.array([r for r, _ in rows], float).reshape(-1, len(FEATURES))
    return BaggedTrees().fit(x, np.array([y for _, y in rows], float))


def scored(pages: DataFrame, trees: BaggedTrees) -> DataFrame:
    """(doc_id, source, score, smoothed) of every row of `pages`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(trees.score(x))], names=["doc_id", "source", "score"])

    rows = pages.select("doc_id", "source", "features").mapInArrow(run, "doc_id bigint, source string, score double")
    rows = shared(rows, "p10-scores")
    by_host = rows.groupBy("source").agg(F.sum("score").alias("s"), F.count("*").alias("n"))
    mean = by_host.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()[0]
    rate = min(max((mean.s or 0.0) / max(1, mean.n or 0), 1e-6), 1 - 1e-6)
    host = (F.col("s") + PAGES * rate) / (F.col("n") + PAGES)
    shift = HOST * (F.log(host / (1 - host)) - math.log(rate / (1 - rate)))
    hosts = by_host.where("source IS NOT NULL").select("source", F.greatest(F.lit(-PULL), F.least(F.lit(PULL), shift)).alias("shift"))
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("score")))
    odds = F.exp(F.log(p / (1 - p)) + F.coalesce("shift", F.lit(0.0)))
    return rows.join(small(hosts), "source", "left").select("doc_id", "source", "score", (odds / (1 + odds)).alias("smoothed"))


def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of the trees and smoothed score of every document that has a word."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    pages = shared(featured(docs), "p10-features")
    return scored(pages, trained(pages))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that are mostly strung-together keywords, links or tags."""
    return p10_scores(spark, sf_dir).where("smoothed > 0.5").select("doc_id")
