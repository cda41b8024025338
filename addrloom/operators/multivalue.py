"""Several values packed in one field: a parsing expression grammar that cuts a field into its values.

    field     <- labelled / numbered / lettered / quoted / bracketed / delimited(d1) / delimited(d2) / ... / bare
    labelled  <- lead (LABEL ':' body)+          LABEL: a capital word with an optional number (ADD1, PERM, OFF)
    numbered  <- (N ')' body)+                   N counts up from 1
    lettered  <- ('(' L ')' body)+               L counts up from a
    quoted    <- q body q (sep q body q)*        q: " or ', a doubled quote stands for itself
    bracketed <- b body b' (sep b body b')*      b b': (), [] or {}, which may nest
    delimited <- body (d body)+                  d: line break, ##, //, ;;, |, OTHER ADD-, OR, AND ALSO, ;, /, comma
    bare      <- .+                              cut where a new value must begin, else one value

Alternatives are ordered. One is taken only if the *acceptance* predicate holds for what it yields (for addresses: at least two
complete ones, pieces that are only parts of a value being joined to their neighbours; for plain values: at least two that aren't
blank); otherwise the parser backtracks to the next. Addresses are parsed again by the same grammar, so delimiters may be mixed. A
quote or bracket that never closes makes `quoted` or `bracketed` fail; the text is then read by the later alternatives and flagged.
Values come as they stand in the source, whatever the folding that the grammar reads; a doubled quote in a quoted value is one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.addressgrammar import prepared, scan_prepared
from ..functions.charforms import fold_with_offsets

Span = tuple[int, int]
#: Delimiters from strong to weak; a weak one may as well separate the parts of one value.
DELIMITERS = tuple(re.compile(x, re.I) for x in (r"\s*\n+\s*", r"\s*##+\s*", r"\s*//+\s*", r"\s*;;+\s*", r"\s*\|+\s*", r"\s*/\s*OTHER ADD(?:RESS)?\s*[-:]\s*", r"\s+(?:OR|AND ALSO)\s+", r"\s*;\s*", r"\s*/\s+|\s+/\s*", r"\s*,\s*"))
_LABEL = re.compile(r"(?:^|(?<=[\s,;|/]))[A-Za-z]{2,10}[ .]?[0-9]?\s?:\s*")
_NUMBER = re.compile(r"(?:^|(?<=[\s,;|/]))\(?([0-9]{1,2})[.)]\s+|(?:^|(?<=[\s,;|/]))([0-9]{1,2})\)\s*")
_LETTER = re.compile(r"(?:^|(?<=[\s,;|/]))\(([A-Za-z])\)\s*")
_TRIM = " \t\r\n,;|/\"'"
#: What joined empty columns leave behind at either end of a field.
_LEFT_OVER = re.compile(r"^(?:\s*(?:nan|null|none|na|0|0\.0)\s*,)+|(?:,\s*(?:nan|null|none|na|0|0\.0)?\s*)+$", re.I)


def _cut(text: str, at: Span, marks: list[Span]) -> list[Span]:
    """The spans between `marks` in `at`."""
    out, b = [], at[0]
    for s, e in marks:
        out.append((b, s))
        b = e
    return [*out, (b, at[1])]


def _labelled(t: str, at: Span) -> list[Span] | None:
    m = [x.span() for x in _LABEL.finditer(t, *at)]
    return _cut(t, at, m) if len(m) > 1 else None


def _counted(pattern: re.Pattern, value: Callable) -> Callable:
    def rule(t: str, at: Span) -> list[Span] | None:
        m, want = [], 1
        for x in pattern.finditer(t, *at):
            if value(x) == want:
                m.append(x.span())
                want += 1
        return _cut(t, at, m) if len(m) > 1 else None

    return rule


def _quoted(t: str, at: Span) -> list[Span] | None:
    """q body q (sep q body q)*; None if a quote stays open or something else stands between the values."""
    i, end = at
    while i < end and t[i].isspace():
        i += 1
    if i >= end or t[i] not in "\"'":
        return None
    q, out = t[i], []
    while True:
        j = i + 1
        while j < end and (t[j] != q or t[j + 1 : j + 2] == q):
            j += 2 if t[j] == q else 1
        if j >= end:
            return None
        out.append((i + 1, j))
        i = j + 1
        while i < end and t[i] in " \t\r\n,;|/":
            i += 1
        if i >= end:
            return out if len(out) > 1 else None
        if t[i] != q:
            return None


BRACKETS = {"(": ")", "[": "]", "{": "}"}


def _bracketed(t: str, at: Span) -> list[Span] | None:
    """[ body ] [ body ] (sep [ body ])* in one kind of bracket, which may nest; None if one stays open or something else stands between."""
    i, end = at
    while i < end and t[i].isspace():
        i += 1
    if i >= end or t[i] not in BRACKETS:
        return None
    left, right, out = t[i], BRACKETS[t[i]], []
    while True:
        depth, j = 1, i + 1
        while j < end and depth:
            depth += (t[j] == left) - (t[j] == right)
            j += 1
        if depth:
            return None
        out.append((i + 1, j - 1))
        i = j
        while i < end and t[i] in " \t\r\n,;|/":
            i += 1
        if i >= end:
            return out if len(out) > 1 else None
        if t[i] != left:
            return None


def _open_bracket(t: str, at: Span) -> bool:
    """Whether the span begins with a bracket and one of its kind is never closed."""
    s = t[at[0] : at[1]].lstrip()
    return s[:1] in BRACKETS and s.count(s[0]) > s.count(BRACKETS[s[0]]) if s else False


def _delimited(d: re.Pattern) -> Callable:
    def rule(t: str, at: Span) -> list[Span] | None:
        m = [x.span() for x in d.finditer(t, *at)]
        return _cut(t, at, m) if m else None

    return rule


RULES: tuple[tuple[str, Callable], ...] = (
    ("labelled", _labelled),
    ("numbered", _counted(_NUMBER, lambda m: int(m[1] or m[2]))),
    ("lettered", _counted(_LETTER, lambda m: ord(m[1].lower()) - 96)),
    ("quoted", _quoted),
    ("bracketed", _bracketed),
    *((f"delimited{k}", _delimited(d)) for k, d in enumerate(DELIMITERS)),
)


class Parts:
    """Where the parts of addresses begin in a field: decides which spans are complete values."""

    NEED = ("house", "street", "locality")
    nested = True

    def __init__(self, text: str):
        self.found = [x for x in scan_prepared(text) if x[0] in ("house", "street", "locality", "flat")]

    def kinds(self, at: Span) -> dict[str, int]:
        out: dict[str, int] = {}
        for k, _, s, _ in self.found:
            if at[0] <= s < at[1]:
                out[k] = out.get(k, 0) + 1
        return out

    def complete(self, at: Span) -> int:
        """How many complete addresses the span can hold at most."""
        k = self.kinds(at)
        return min(k.get(x, 0) for x in self.NEED)


def _join(parts: Parts, spans: list[Span]) -> list[Span]:
    """Pieces joined until each is a complete address; pieces without a part of their own go to the one before them."""
    out: list[Span] = []
    for s, e in spans:
        k = parts.kinds((s, e))
        if not out:
            out.append((s, e))
        elif not k or parts.complete((out[-1][0], out[-1][1])) == 0:
            out[-1] = (out[-1][0], e)
        elif parts.complete((s, e)) or all(k.get(x, 0) <= 1 for x in k):
            out.append((s, e))
        else:
            out[-1] = (out[-1][0], e)
    if len(out) > 1 and parts.complete(out[-1]) == 0:
        out[-2:] = [(out[-2][0], out[-1][1])]
    return out


def _bare(parts: Parts, at: Span) -> list[Span]:
    """No delimiter helps: a new value begins at the first part of a kind that the running value already has."""
    have: set[str] = set()
    cuts: list[int] = []
    for k, _, s, _ in parts.found:
        if not at[0] <= s < at[1]:
            continue
        if k in have and all(x in have for x in Parts.NEED):
            cuts.append(s)
            have = set()
        have.add(k)
    spans = _cut("", at, [(c, c) for c in cuts])
    return _join(parts, spans)


class Plain:
    """Acceptance of plain values: a rule is taken if it yields two or more that aren't blank; values aren't cut again."""

    nested = False

    def __init__(self, text: str):
        self.text = text

    def complete(self, at: Span) -> int:
        return 2 if self.text[at[0] : at[1]].strip(_TRIM) else 0


def _good(parts: Parts | Plain, t: str, spans: list[Span]) -> list[Span]:
    filled = [x for x in spans if t[x[0] : x[1]].strip(_TRIM)]
    return _join(parts, filled) if isinstance(parts, Parts) else filled


def _parse(t: str, at: Span, parts: Parts | Plain, flags: set[str], quotes: dict[int, str]) -> list[Span]:
    if parts.complete(at) < 2:
        return [at]
    for name, rule in RULES:
        spans = rule(t, at)
        if spans is None:
            continue
        good = _good(parts, t, spans)
        if sum(parts.complete(x) >= 1 for x in good) == len(good) > 1:
            if any(not t[x[0] : x[1]].strip(_TRIM) for x in spans[1:-1]):
                flags.add("empty_value")
            if name == "quoted":
                quotes |= {x[0]: t[x[0] - 1] for x in good}
            return [y for x in good for y in _parse(t, x, parts, flags, quotes)] if parts.nested else good
    if not isinstance(parts, Parts):
        return [at]
    flags.add("no_delimiter")
    return _bare(parts, at)


def _open(t: str, flags: set[str]) -> None:
    """Flags a quote or bracket that the text begins with and never closes."""
    s = t.lstrip()
    if s[:1] in ('"', "'") and s.count(s[0]) % 2:
        flags.add("malformed_quote")
    if _open_bracket(t, (0, len(t))):
        flags.add("unclosed_bracket")


def split_field(text: str | None, accept: type[Parts] | type[Plain] = Parts) -> list[tuple[int, str, str]]:
    """(position from 1, value, flags) of each value in a field, of addresses unless `accept` is Plain.

    A null, empty or blank field has no value, nor have the left-overs of joined empty columns (nan, NULL, 0, 0.0); a field with one address
    (or none that is complete) is one value. Flags, comma separated: malformed_quote, unclosed_bracket, empty_value (two delimiters in a
    row), no_delimiter."""
    if text is None or not (text := _LEFT_OVER.sub("", text)).strip(_TRIM):
        return []
    t = prepared(text)
    flags: set[str] = set()
    quotes: dict[int, str] = {}
    _open(t, flags)
    spans = _parse(t, (0, len(t)), accept(t), flags, quotes)
    f = ",".join(sorted(flags))
    if len(spans) == 1:
        return [(1, text.strip(), f)]
    if text.isascii():
        places = range(len(t) + 1)
    else:
        again, places = fold_with_offsets(text)
        if again != t:  # marks in an unusual order
            text, places = t, range(len(t) + 1)
    out = []
    for i, (s, e) in enumerate(spans, 1):
        value = text[places[s] : places[e]].strip(_TRIM)
        out.append((i, value.replace(quotes[s] * 2, quotes[s]) if s in quotes else value, f))
    return out


SCHEMA = T.StructType([T.StructField("pos", T.LongType()), T.StructField("value", T.StringType()), T.StructField("flags", T.StringType())])


def split_values(df: DataFrame, column: str, keys: list[str], several_only: bool = False, accept: type[Parts] | type[Plain] = Parts) -> DataFrame:
    """One row per value of `column`: the key columns, `pos` (bigint, from 1), `value`, `flags`.

    Fields without a value give no row; repeated rows are split each for itself; other columns of `df` may have any name, as only
    the keys and `column` are read. `several_only` keeps fields with two values or more. No shuffle: one pass over the scan."""
    picked = df.select(*keys, F.col(column).alias("__text")).where(F.col("__text").isNotNull())
    if several_only and accept is Parts:
        # two addresses have two house numbers, runs of one to four digits. A pure ASCII field with fewer can't hold two; in others
        # folding may make digits, so they all go to the parser
        short = F.filter(F.split("__text", "[^0-9]+"), lambda x: F.length(x).between(1, 4))
        picked = picked.where(F.col("__text").rlike(r"[^\x00-\x7F]") | (F.size(short) >= 2))
    schema = T.StructType([*(picked.schema[k] for k in keys), *SCHEMA])
    arrow = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal arrow
        for b in batches:
            take: list[int] = []
            rows: list[tuple[int, str, str]] = []
            for i, text in enumerate(b.column("__text").to_pylist()):
                got = split_field(text, accept)
                if len(got) > (1 if several_only else 0):
                    take.extend([i] * len(got))
                    rows.extend(got)
            at = pa.array(take, pa.int64())
            cols = [b.column(k).take(at) for k in keys]
            pos, val, fl = zip(*rows) if rows else ((), (), ())
            cols += [pa.array(pos, pa.int64()), pa.array(val, pa.string()), pa.array(fl, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=[*keys, "pos", "value", "flags"])

    return picked.mapInArrow(run, schema)
