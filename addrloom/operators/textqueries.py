"""Queries over the text forms, PIN forms, predicates, labels, segments and detectors of the whole address table, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import extract as x
from ..functions import text as t
from ..plans.tables import spread, table

Query = Callable[[SparkSession, str], DataFrame]


def addresses(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spread(table(spark, sf_dir, "cleaned_address_data").select("row_id", *columns))


def op_text_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text form of the address."""
    c = F.col("full_address")
    forms = {"safe": t.text(c), "collapsed": t.collapsed(c), "clean": t.clean_text(c), "matching": t.for_matching(c), "checking": t.for_checking(c), "resolving": t.for_resolving(c)}
    return addresses(spark, sf_dir, "full_address").select("row_id", *[v.alias(k) for k, v in forms.items()])


def op_entity_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City and district as entities without labels and by their present name, with their words."""
    return addresses(spark, sf_dir, "city", "district").select("row_id", t.entity(F.col("city")).alias("city"), t.entity(F.col("district")).alias("district"), F.array_join(t.entity_words(F.col("city")), "|").alias("words"))


def op_state_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical state by each of the three rules, of the state column and of the state's initials."""
    s, short = F.col("state"), F.array_join(F.transform(F.split(F.upper("state"), " "), lambda w: F.substring(w, 1, 1)), "")
    out = {}
    for name, rule in (("cleaner", t.cleaner_state), ("validator", t.validator_state), ("resolver", t.resolver_state)):
        out |= {name: rule(s), f"{name}_short": rule(short)}
    return addresses(spark, sf_dir, "state").select("row_id", *[v.alias(k) for k, v in out.items()])


def op_pin_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The PIN of the pincode column by each of the four rules, and the last PIN in the address."""
    p = F.col("pincode")
    return addresses(spark, sf_dir, "pincode", "full_address").select(
        "row_id", t.last_pin(p).alias("cleaner"), t.six_digits(p).alias("validator"), t.plain_pin(p).alias("resolver"), t.loose_pin(p).alias("master"), t.last_pin(t.clean_text(F.col("full_address"))).alias("in_address")
    )


def op_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether city and address are meaningful, by both rules, and the pattern of the city as a phrase."""
    c, a = F.col("city"), F.col("full_address")
    return addresses(spark, sf_dir, "city", "full_address").select(
        "row_id", t.is_meaningful(c).alias("city_ok"), t.is_meaningful_text(c).alias("city_text_ok"), t.is_meaningful(a).alias("address_ok"), t.is_meaningful_text(a).alias("address_text_ok"), t.phrase_pattern(c).alias("city_pattern")
    )


def op_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names behind village, post office, district, subdistrict and locality labels."""
    c = F.col("full_address")
    return addresses(spark, sf_dir, "full_address").select("row_id", *[x.labelled(c, k).alias(k) for k in x.LABELLED])


def op_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments of every address with their place, and whether each may name a place or a city."""
    rows = addresses(spark, sf_dir, "full_address", "city", "state", "pincode").select("*", F.posexplode(x.segments(F.col("full_address"))).alias("pos", "segment"))
    seg, state, pin = F.col("segment"), t.cleaner_state(F.col("state")), t.last_pin(F.col("pincode"))
    return rows.select("row_id", "pos", "segment", x.may_be_place(seg, F.col("city"), F.col("state")).alias("place"), x.may_be_city(seg, state, pin).alias("city"))


def op_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which parts the address shows, and its type."""
    c = F.col("full_address")
    return addresses(spark, sf_dir, "full_address").select("row_id", x.has_premise(c).alias("premise"), *[x.has(c, k).alias(k) for k in x.WORDS], x.address_type(c).alias("address_type"))


# ---- SQL ----


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def s_text(c: str) -> str:
    return rf"coalesce(regexp_replace(CAST({c} AS VARCHAR), '\A{t.WS}+|{t.WS}+\z', '', 'g'), '')"


def s_collapsed(c: str) -> str:
    return f"regexp_replace({s_text(c)}, '{t.WS}+', ' ', 'g')"


def s_bare(c: str) -> str:
    return f"trim(regexp_replace({c}, '[^A-Z0-9]+', ' ', 'g'))"


def s_clean(c: str) -> str:
    return rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace(upper({s_text(c)}), '{t.WS}+', ' ', 'g'), ' ?[,;|] ?', ',', 'g'), ',+', ',', 'g'), '\A[ ,;]+|[ ,;]+\z', '', 'g')"


def s_matching(c: str) -> str:
    return s_bare(s_clean(c))


def s_checking(c: str) -> str:
    return s_bare(f"upper({s_text(c)})")


def s_resolving(c: str) -> str:
    return s_bare(f"replace(upper({s_text(c)}), '&', ' AND ')")


def s_mapped(c: str, pairs: dict[str, str]) -> str:
    return f"(SELECT CASE k {' '.join(f'WHEN {q(a)} THEN {q(b)}' for a, b in pairs.items())} ELSE k END FROM (SELECT {c} k))"


def s_entity(c: str) -> str:
    return s_mapped(rf"regexp_replace({s_resolving(c)}, '\A(?:(?:{'|'.join(t.LABELS)})(?: |\z))+', '')", t.FORMER_NAMES)


def s_runs(c: str) -> str:
    return rf"list_filter(regexp_split_to_array(coalesce(CAST({c} AS VARCHAR), ''), '[^\p{{Nd}}]+'), lambda z: length(z) = 6)"


def s_last_pin(c: str) -> str:
    return f"coalesce({s_runs(c)}[-1], '')"


def s_digits(c: str) -> str:
    return rf"regexp_replace({c}, '[^\p{{Nd}}]', '', 'g')"


def s_no_decimal(c: str) -> str:
    return rf"regexp_replace({s_text(c)}, '\A(\p{{Nd}}+)\.0+\z', '\1')"


def s_six(c: str) -> str:
    return f"CASE WHEN length({s_digits(c)}) = 6 THEN {s_digits(c)} ELSE '' END"


def s_in(c: str, values: tuple[str, ...]) -> str:
    return f"{c} IN ({', '.join(map(q, values))})"


def s_labelled(c: str, kind: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({s_text(f'regexp_extract({s_text(c)}, {q('(?i)' + x.EDGE + p + x.NAME)}, 1)')}, '')" for p in x.LABELLED[kind]) + ", '')"


def s_has(c: str, pattern: str) -> str:
    return f"regexp_matches({c}, {q(pattern)})"


def s_city(c: str, state: str, pin: str) -> str:
    m = s_matching(c)
    return f"({m} <> '' AND NOT {s_in(m, t.PLACEHOLDERS)} AND NOT ({pin} <> '' AND {m} = {s_matching(pin)}) AND NOT ({state} <> '' AND {m} = {s_matching(state)}) AND NOT {s_has(m, chr(92) + 'b(?:' + x.NO_CITY + ')' + chr(92) + 'b')} AND NOT regexp_full_match({m}, '[0-9]+'))"


def _sql() -> dict[str, str]:
    c = "cleaned_address_data"
    a, ci, st, p = "full_address", "city", "state", "pincode"
    short = "list_aggregate(list_transform(string_split(upper(state), ' '), lambda w: left(w, 1)), 'string_agg', '')"
    states = {"cleaner": (s_matching, t.CLEANER_STATES), "validator": (s_checking, t.VALIDATOR_STATES), "resolver": (s_resolving, t.FORMER_NAMES | t.VALIDATOR_STATES)}
    state_cols = ", ".join(f"{s_mapped(f(st), m)} AS {k}, {s_mapped(f('short'), m)} AS {k}_short" for k, (f, m) in states.items())
    place = f"(m <> '' AND length(m) <= 80 AND NOT regexp_full_match(m, '[0-9]{{6}}') AND m <> {s_mapped(s_resolving(st), t.FORMER_NAMES | t.VALIDATOR_STATES)} AND NOT ({s_text(ci)} <> '' AND m = {s_entity(ci)}))"
    premise = " OR ".join(s_has("u", y) for y in x.PREMISE)
    words = ", ".join(f"{s_has('u', x.word_pattern(k))} AS {k}" for k in x.WORDS)
    kind = rf"CASE WHEN {s_has('s', f'(?i){x.EDGE}(?:{x.RURAL}){x.END}')} THEN 'RURAL' WHEN {s_has('s', f'(?i){x.EDGE}(?:{x.URBAN}){x.END}')} THEN 'URBAN' ELSE 'UNKNOWN' END"
    pattern = rf"CASE WHEN {s_matching(ci)} <> '' THEN concat('\b', replace({s_matching(ci)}, ' ', '\s+'), '\b') ELSE '' END"
    return {
        "op_text_forms": f"SELECT row_id, {s_text(a)} AS safe, {s_collapsed(a)} AS collapsed, {s_clean(a)} AS clean, {s_matching(a)} AS matching, {s_checking(a)} AS checking, {s_resolving(a)} AS resolving FROM {c}",
        "op_entity_forms": f"SELECT row_id, {s_entity(ci)} AS city, {s_entity('district')} AS district, coalesce(list_aggregate(list_sort(list_distinct(list_filter(string_split({s_entity(ci)}, ' '), lambda w: length(w) >= 2))), 'string_agg', '|'), '') AS words FROM {c}",
        "op_state_forms": f"SELECT row_id, {state_cols} FROM (SELECT row_id, state, {short} AS short FROM {c})",
        "op_pin_forms": f"SELECT row_id, {s_last_pin(p)} AS cleaner, {s_six(s_text(p))} AS validator, {s_six(s_no_decimal(p))} AS resolver, {s_digits(s_no_decimal(p))} AS master, {s_last_pin(s_clean(a))} AS in_address FROM {c}",
        "op_predicates": f"SELECT row_id, {s_matching(ci)} <> '' AND NOT {s_in(s_matching(ci), t.PLACEHOLDERS)} AS city_ok, {s_checking(ci)} <> '' AND NOT {s_in(s_checking(ci), t.GARBAGE)} AS city_text_ok, {s_matching(a)} <> '' AND NOT {s_in(s_matching(a), t.PLACEHOLDERS)} AS address_ok, {s_checking(a)} <> '' AND NOT {s_in(s_checking(a), t.GARBAGE)} AS address_text_ok, {pattern} AS city_pattern FROM {c}",
        "op_labels": f"SELECT row_id, {', '.join(f'{s_labelled(a, k)} AS {k}' for k in x.LABELLED)} FROM {c}",
        "op_segments": f"WITH g AS (SELECT row_id, city, state, pincode, list_filter(list_transform(string_split(replace({s_collapsed(a)}, ';', ','), ','), lambda z: trim(z)), lambda z: z <> '') AS l FROM {c}), e AS (SELECT row_id, city, state, pincode, unnest(range(len(l))) AS pos, unnest(l) AS segment FROM g), f AS (SELECT *, {s_entity('segment')} AS m, {s_mapped(s_matching(st), t.CLEANER_STATES)} AS cs, {s_last_pin(p)} AS cp FROM e) SELECT row_id, CAST(pos AS INTEGER) AS pos, segment, {place} AS place, {s_city('segment', 'cs', 'cp')} AS city FROM f",
        "op_components": f"SELECT row_id, {premise} AS premise, {words}, {kind} AS address_type FROM (SELECT row_id, upper({s_text(a)}) AS u, {s_text(a)} AS s FROM {c})",
    }


QUERIES: dict[str, Query] = {f.__name__: f for f in (op_text_forms, op_entity_forms, op_state_forms, op_pin_forms, op_predicates, op_labels, op_segments, op_components)}
SQL = _sql()
