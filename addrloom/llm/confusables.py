"""Visually identical text with different characters: one consistent form for every value.

For each token the script sets of its characters are intersected. A character's set holds its own script (digits, marks and signs
belong to all) and, where the table of look-alikes has a counterpart, the script of that counterpart. Then

* an empty intersection of the *own* scripts is a mixed-script token; it is respelt in the script that the extended sets still
  share, Latin if there are several;
* a token of one script other than Latin whose every letter has a Latin look-alike is a whole-script confusable; it is respelt in
  Latin unless its script is really in use: the same value, or `IN_USE` of the column's values with letters, hold letters of it
  that have no look-alike;
* what remains is brought to one form: compatibility characters to what they stand for, letter and accent to one character,
  invisible characters away, other spaces to the plain one.

Devanagari text (with the joiners between its letters) and digits, line breaks, letters with an accent in one character and runs
of plain spaces stay as they are. Null stays null, an empty text empty; very long texts are handled whole.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.charforms import INVISIBLE, LOOKALIKES
from ..plans.tables import spread, table

_TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_HIDDEN = regex.compile(f"[{INVISIBLE}]")
_JOINED = regex.compile(r"(?<=\p{Devanagari})[‌‍]+(?=\p{Devanagari})")
#: Share of a column's values from which a script other than Latin counts as in use there.
IN_USE = 0.01
#: Most rounds of normalising; each but the last changes something that the one before made visible.
ROUNDS = 8
_SPACE = regex.compile(r"[\p{Zs}--\x20]", regex.V1)
_MARKED = regex.compile(r"[^\p{M}\p{Devanagari}]\p{M}+")
#: Scripts that can stand for each other letter by letter in the table of look-alikes.
SCRIPTS = ("Latin", "Greek", "Cyrillic", "Armenian", "Cherokee", "Lisu", "Coptic", "Devanagari", "Bengali", "Arabic", "Hebrew", "Han", "Hiragana", "Katakana", "Hangul", "Thai")
_SCRIPT = [(s, regex.compile(rf"\p{{scx={s}}}")) for s in SCRIPTS]
_COMMON = regex.compile(r"[\p{Script=Common}\p{Script=Inherited}\p{N}]")
_BACK: dict[str, dict[str, str]] = {}
_ALL = frozenset(SCRIPTS) | {"other"}


@lru_cache(20_000)
def own_scripts(ch: str) -> frozenset[str]:
    """Scripts that a character belongs to; all of them for digits, marks and signs."""
    if _COMMON.match(ch):
        return _ALL
    return frozenset(s for s, p in _SCRIPT if p.match(ch)) or frozenset({"other"})


@lru_cache(20_000)
def spelt_in(ch: str, script: str) -> str | None:
    """The character, or its look-alike in `script`; None if there is none."""
    if script in own_scripts(ch):
        return ch
    if script == "Latin":
        return LOOKALIKES.get(ch)
    if not _BACK:
        for other, latin in LOOKALIKES.items():
            for s in own_scripts(other):
                _BACK.setdefault(s, {}).setdefault(latin, other)
    return _BACK.get(script, {}).get(LOOKALIKES.get(ch, ch))


def resolve(token: str, real: frozenset[str]) -> str:
    """The token in one script; `real` are the scripts other than Latin that its value really uses."""
    shared = _ALL
    for ch in token:
        shared = shared & own_scripts(ch)
    if shared and ("Latin" in shared or shared & real or "other" in shared):
        return token
    for script in ("Latin", *sorted({s for ch in token for s in own_scripts(ch)} - {"Latin", "other"})):
        if shared and script != "Latin":
            break
        new = [spelt_in(ch, script) for ch in token]
        if None not in new:
            return "".join(new)
    if not shared:  # no script spells the whole token: letters between Latin ones become Latin where they can
        latin = [spelt_in(ch, "Latin") for ch in token]
        if sum("Latin" in own_scripts(ch) and own_scripts(ch) != _ALL for ch in token) * 2 >= sum(own_scripts(ch) != _ALL for ch in token):
            return "".join(n or ch for n, ch in zip(latin, token))
    return token


def _compatible(ch: str) -> bool:
    return unicodedata.decomposition(ch)[:1] == "<"


def normalize(text: str, in_use: frozenset[str] = frozenset()) -> tuple[str, tuple[str, ...]]:
    """(consistent form, kinds of change): compatibility, accent, invisible, space, script - in this order, none for ASCII.

    `in_use` are the scripts other than Latin in which the column is really written. A form is its own form: steps that make room for
    others, such as accents that change places, are followed by another round."""
    form, kinds = text, set()
    for _ in range(ROUNDS):
        new, found = _round(form, in_use)
        kinds |= set(found)
        if new == form:
            break
        form = new
    return form, tuple(k for k in ("compatibility", "accent", "invisible", "space", "script") if k in kinds)


def _round(text: str, in_use: frozenset[str]) -> tuple[str, list[str]]:
    if text.isascii():
        return text, []
    kinds = []
    keep = {i for m in _JOINED.finditer(text) for i in range(*m.span())}
    t = text
    if _HIDDEN.search(t):
        s = "".join(ch for i, ch in enumerate(t) if i in keep or not _HIDDEN.match(ch))
        if s != t:
            t = s
            kinds.append("invisible")
    if _SPACE.search(t):
        t = _SPACE.sub(" ", t)
        kinds.append("space")
    if any(_compatible(ch) for ch in t if ch > "\x7f"):
        t = "".join(unicodedata.normalize("NFKC", ch) if _compatible(ch) else ch for ch in t)
        kinds.append("compatibility")

    real = frozenset(s for ch in set(t) if not ch.isascii() and ch not in LOOKALIKES for s in own_scripts(ch) if own_scripts(ch) != _ALL) - {"Latin"} | in_use
    s = _TOKEN.sub(lambda m: m.group() if m.group().isascii() else resolve(m.group(), real), t)
    if s != t:
        t = s
        kinds.append("script")

    def one(m) -> str:
        return unicodedata.normalize("NFC", m.group())

    s = _MARKED.sub(one, t)
    if s != t:
        t = s
        kinds.append("accent")
    return t, kinds


#: Scripts that have look-alikes, by their names in regular expressions of the JVM.
CONFUSABLE = ("Greek", "Cyrillic", "Armenian", "Cherokee", "Lisu", "Coptic")


def scripts_in_use(df: DataFrame, columns: list[str]) -> dict[str, frozenset[str]]:
    """For each column the confusable scripts in which at least `IN_USE` of its values with letters are really written: one aggregation
    over all values, a few numbers to the driver."""
    counts = []
    for c in columns:
        rest = F.translate(F.col(c), "".join(LOOKALIKES), "")
        counts.append(F.count_if(F.col(c).rlike(r"\p{L}")).alias(f"{c}__all"))
        counts += [F.count_if(F.col(c).rlike(r"[^\x00-\x7F]") & rest.rlike(rf"\p{{Is{s}}}")).alias(f"{c}__{s}") for s in CONFUSABLE]
    got = df.agg(*counts).collect()[0].asDict()
    return {c: frozenset(s for s in CONFUSABLE if got[f"{c}__{s}"] and got[f"{c}__{s}"] >= IN_USE * got[f"{c}__all"]) for c in columns}


def normalized(df: DataFrame, keys: list[str], columns: list[str], changed_only: bool = False) -> DataFrame:
    """One row per cell of `columns`: keys, field_name, value, form, kinds (comma separated). One small aggregation before, no shuffle of the values.

    `changed_only` keeps the cells whose form differs; pure ASCII cells are then dropped before they reach Python."""
    in_use = scripts_in_use(df, columns)
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("f"), F.col(c).alias("v")) for c in columns))).alias("cell")
    long = df.select(*keys, pairs).select(*keys, F.col("cell.f").alias("field_name"), F.col("cell.v").alias("value"))
    if changed_only:
        long = long.where(F.col("value").rlike(r"[^\x00-\x7F]"))
    schema = T.StructType([*long.schema, T.StructField("form", T.StringType()), T.StructField("kinds", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(None, None)] * b.num_rows
            for i, (c, v) in enumerate(zip(b.column("field_name").to_pylist(), b.column("value").to_pylist())):
                if v is not None:
                    form, kinds = normalize(v, in_use[c])
                    got[i] = (form, ",".join(kinds))
            out = pa.RecordBatch.from_arrays([*b.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string())], names=[*b.schema.names, "form", "kinds"])
            yield out.filter(pa.array([bool(g[1]) for g in got])) if changed_only else out

    return long.mapInArrow(run, schema)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of full_address and city that hold characters in place of the plain ones."""
    rows = table(spark, sf_dir, "cleaned_address_data").select("row_id", "full_address", "city")
    return normalized(rows, ["row_id"], ["full_address", "city"], changed_only=True).select("row_id", "field_name")


def p1_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of full_address and city in its consistent form, with the kinds of change."""
    rows = spread(table(spark, sf_dir, "cleaned_address_data").select("row_id", "full_address", "city"))
    return normalized(rows, ["row_id"], ["full_address", "city"]).select("row_id", "field_name", "form", "kinds")
