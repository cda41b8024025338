"""Similarity of two names, and collapsing of repeated word blocks: the two Arrow functions that no built-in expresses."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

try:
    from rapidfuzz import fuzz
except ImportError:  # the standard library's ratio then
    fuzz = None


def ratio(a: str, b: str) -> float:
    """Similarity from 0 to 1 of a query and a name, in this order (it is not symmetric)."""
    return fuzz.WRatio(a, b) / 100.0 if fuzz else SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """`ratio` of two columns; null if one of them is."""
    return pd.Series([None if x is None or y is None else ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def collapse(words: list[str], longest: int = 12) -> list[int]:
    """Places of the words that stay when immediate repeats of blocks of two to `longest` words go: longest blocks first, from the left,
    until none is left; the first copy of a block stays."""
    out = list(range(len(words)))
    while True:
        now = [words[i] for i in out]
        for size in range(min(longest, len(out) // 2), 1, -1):
            at = next((i for i in range(len(out) - 2 * size + 1) if now[i : i + size] == now[i + size : i + 2 * size]), None)
            if at is not None:
                end = at + 2 * size
                while now[end : end + size] == now[at : at + size]:
                    end += size
                del out[at + size : end]
                break
        else:
            return out


def without_repeats(text: str | None) -> str | None:
    """A clean text whose pieces between commas have no repeated block and no word twice in a row. Punctuation does not tell words apart."""
    if text is None:
        return None
    pieces = []
    for piece in text.split(","):
        shown = piece.split()
        plain = [" ".join("".join(ch if "A" <= ch <= "Z" or "0" <= ch <= "9" else " " for ch in w.upper()).split()) for w in shown]
        stay = collapse(plain)
        kept = [i for k, i in enumerate(stay) if not k or plain[stay[k - 1]] != plain[i]]
        if kept:
            pieces.append(" ".join(shown[i] for i in kept))
    return ",".join(pieces)


@F.pandas_udf(StringType())
def collapse_repeats(text: pd.Series) -> pd.Series:
    """`without_repeats` of a column."""
    return text.map(without_repeats, na_action="ignore")
