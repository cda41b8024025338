"""Resolution of typed place names against the reference tables: exact, then by context, then fuzzy within a pool of candidates.

Only distinct keys (query, state, district, subdistrict, PIN) are resolved and joined back, so a hot city or PIN is resolved once.
* Exact: the master rows of the query's name, narrowed to those that fit the context best (supplied district 10, supplied subdistrict 8,
  a district of the PIN 6, supplied state 4, a state of the PIN 2; a single row is never scored). One row passes, several are ambiguous.
* Fuzzy: the pool depends on the kind; where it is a whole table, candidates share two letters in a row with the query, which no pair
  of a similarity of `REVIEW` or more lacks, and differ in length by no more than that similarity allows. `PASS_AT` passes, with the
  margin rule for villages and offices.

Empty queries are NOT_CHECKED. A null in any context column counts as the empty text. Repeated rows all get the answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.similar import similarity
from ..plans.tables import shared, small, spread, table
from .indexes import masters, pin_context
from .textqueries import s_entity, s_mapped, s_resolving, s_six, s_text

#: Similarity from which a match is plausible, strong, and strong whatever the second one is; and the margin to the second.
REVIEW, PASS_AT, VERY_STRONG, MARGIN = 0.85, 0.90, 0.95, 0.03
TOP = 3
KEYS = ("query", "state", "district", "subdistrict", "pin")


class Reference:
    """The masters and the PIN context in the columns that resolution compares."""

    def __init__(self, spark: SparkSession, sf_dir: str, tables: dict[str, DataFrame] | None = None):
        """From the tables of a folder, or from standardised masters (sources.files.load_masters), which may lack a state."""
        m = {k: v if "state_name" in v.columns else v.withColumn("state_name", F.lit("")) for k, v in (tables or masters(spark, sf_dir)).items()}
        self.pins = shared(pin_context(m["india_post"]), "pins")
        self.context = self.pins.select("pin", F.col("district_entities").alias("pin_districts"), F.col("canonical_states").alias("pin_states"))
        state = t.resolver_state(F.col("state_name"))
        none = F.lit("")
        self.names = {
            "district": m["district"].select(F.col("district_name_clean").alias("name"), F.col("district_name_clean").alias("m_district"), none.alias("m_subdistrict"), state.alias("m_state"), F.col("district_code").alias("code")),
            "ulb": m["ulb"].select(F.col("ulb_name_clean").alias("name"), none.alias("m_district"), none.alias("m_subdistrict"), state.alias("m_state"), F.col("ulb_code").alias("code")),
            "subdistrict": m["subdistrict"].select(F.col("subdistrict_name_clean").alias("name"), F.col("district_name_clean").alias("m_district"), F.col("subdistrict_name_clean").alias("m_subdistrict"), state.alias("m_state"), F.col("subdistrict_code").alias("code")),
            "village": m["village"].select(F.col("village_name_clean").alias("name"), F.col("district_name_clean").alias("m_district"), F.col("subdistrict_name_clean").alias("m_subdistrict"), state.alias("m_state"), F.col("village_code").alias("code")),
        }


def keyed(rows: DataFrame, query: Column, state: Column | None = None, district: Column | None = None, subdistrict: Column | None = None, pin: Column | None = None) -> DataFrame:
    """`rows` with the five key columns in the form in which they are compared, and their hash `kid`."""
    none = F.lit("")
    cols = {
        "query": t.entity(query), "state": t.resolver_state(state) if state is not None else none, "district": t.entity(district) if district is not None else none,
        "subdistrict": t.entity(subdistrict) if subdistrict is not None else none, "pin": t.six_digits(pin) if pin is not None else none,
    }
    kept = [c for c in rows.columns if c not in KEYS]  # a column of the same name gives way to the key
    return rows.select(*kept, *[c.alias(k) for k, c in cols.items()]).withColumn("kid", F.concat_ws("\x01", *KEYS))


def fitting(found: DataFrame, by: list[str], context: DataFrame) -> DataFrame:
    """Of the master rows found for each key (`by` names it) those that fit its context best, all of them if none fits at all."""
    x = found.join(small(context), "pin", "left")
    score = sum((F.when(c, n).otherwise(0) for c, n in (
        ((F.col("district") != "") & (F.col("m_district") == F.col("district")), 10), ((F.col("subdistrict") != "") & (F.col("m_subdistrict") == F.col("subdistrict")), 8),
        (F.coalesce(F.array_contains("pin_districts", F.col("m_district")), F.lit(False)), 6), ((F.col("state") != "") & (F.col("m_state") == F.col("state")), 4),
        (F.coalesce(F.array_contains("pin_states", F.col("m_state")) & (F.col("m_state") != ""), F.lit(False)), 2),
    )), F.lit(0))
    return x.withColumn("fit", score).withColumn("best_fit", F.max("fit").over(Window.partitionBy(*by))).where("fit = best_fit").drop("fit", "best_fit", "pin_districts", "pin_states")


def _counted(fit: DataFrame, by: list[str]) -> DataFrame:
    """(by, n, code): how many master rows remain, and the code of the only one."""
    return fit.groupBy(*by).agg(F.count("*").alias("n"), F.min("code").alias("code"))


def exact(keys: DataFrame, kind: str, ref: Reference) -> DataFrame:
    """(kid, n, code) of the keys whose query is a name of the master."""
    found = keys.join(small(ref.names[kind]), F.col("query") == F.col("name"))
    if kind == "district":  # a district is its own context
        found = found.withColumn("district", F.col("query"))
    if kind == "ulb":
        return _counted(found, ["kid"])
    fit = fitting(found, ["kid"], ref.context)
    if kind == "village":
        same = (F.col("subdistrict") != "") & (F.col("m_subdistrict") == F.col("subdistrict"))
        fit = fit.withColumn("same", same).withColumn("any", F.max("same").over(Window.partitionBy("kid"))).where("same OR NOT any")
    return _counted(fit, ["kid"])


def _pairs_by(keys: DataFrame, names: DataFrame, on: Column) -> DataFrame:
    return keys.join(small(names), on).select("kid", "query", "name").distinct()


def near_names(keys: DataFrame, names: DataFrame) -> DataFrame:
    """(kid, query, name): every name that could be as similar as `REVIEW`, by shared letter pairs and length.

    With M letters in common and lengths a + b = S, at most 0.15 S letters have no partner, so the M >= 0.425 S common ones form at most
    0.15 S + 1 runs: one of them has two letters or more. Queries are joined once each, whatever their number of keys."""
    two = "transform(sequence(1, greatest(1, length({0}) - 1)), i -> substring({0}, i, 2))"
    a = keys.select("query").distinct().select("query", F.explode(F.array_distinct(F.expr(two.format("query")))).alias("g"))
    b = names.select("name").distinct().where("name <> ''").select("name", F.explode(F.array_distinct(F.expr(two.format("name")))).alias("g"))
    la, lb = F.length("query"), F.length("name")
    met = a.join(small(b), "g").where(2 * F.least(la, lb) >= REVIEW * (la + lb)).select("query", "name").distinct()
    return keys.select("kid", "query").join(met, "query").select("kid", "query", "name")


def by_token(keys: DataFrame, names: DataFrame) -> DataFrame:
    """(kid, query, name): the names that share a word of two letters or more with the query."""
    word = lambda c: F.explode(F.filter(F.array_distinct(F.split(c, " ")), lambda w: F.length(w) >= 2))
    a = keys.select("kid", "query", word("query").alias("w"))
    return a.join(small(names.select("name").distinct().select("name", word("name").alias("w"))), "w").select("kid", "query", "name").distinct()


def _without(keys: DataFrame, pairs: DataFrame) -> DataFrame:
    return keys.join(pairs.select("kid").distinct(), "kid", "left_anti")


def pool(keys: DataFrame, kind: str, ref: Reference) -> DataFrame:
    """(kid, query, name): the candidates of each key that has no exact name."""
    names = ref.names.get(kind)
    if kind == "ulb":
        return near_names(keys, names)
    if kind == "district":
        own = keys.join(small(ref.context), "pin").select("kid", "query", F.explode("pin_districts").alias("name")).join(small(names.select("name").distinct()), "name").select("kid", "query", "name")
        return own.unionAll(near_names(_without(keys, own), names))
    if kind == "subdistrict":
        own = _pairs_by(keys.where("district <> ''"), names, (F.col("district") == F.col("m_district")))
        rest = _without(keys, own)
        words = by_token(rest, names)
        return own.unionAll(words).unionAll(near_names(_without(rest, words), names))
    if kind == "village":
        both = keys.where("district <> '' AND subdistrict <> ''")  # an unknown pair falls back to words, not to the district
        own = _pairs_by(both, names, (F.col("district") == F.col("m_district")) & (F.col("subdistrict") == F.col("m_subdistrict")))
        own = own.unionAll(_pairs_by(keys.where("district = '' AND subdistrict <> ''"), names, F.col("subdistrict") == F.col("m_subdistrict")))
        own = own.unionAll(_pairs_by(keys.where("district <> '' AND subdistrict = ''"), names, F.col("district") == F.col("m_district")))
        return own.unionAll(by_token(_without(keys, own), names))
    raise ValueError(kind)


def ranked(pairs: DataFrame) -> DataFrame:
    """(kid, best, score, second): the most similar candidate of each key, at least `REVIEW`, and the similarity of the next (0 without one).

    Ties go to the later name."""
    distinct = shared(pairs.select("query", "name").distinct().withColumn("score", similarity("query", "name")).where(F.col("score") >= REVIEW), "similar")
    of = Window.partitionBy("kid").orderBy(F.desc("score"), F.desc("name"))
    x = pairs.join(distinct, ["query", "name"]).withColumn("place", F.row_number().over(of)).withColumn("second", F.lead("score", 1, 0.0).over(of))
    return x.where("place = 1").select("kid", F.col("name").alias("best"), "score", "second")


def resolved(keys: DataFrame, kind: str, ref: Reference) -> DataFrame:
    """(kid, status, match_value, match_score, source, code) of every distinct key of `keys` (kid and the five key columns)."""
    keys = keys.select("kid", *KEYS).distinct()
    if kind == "village":  # without a district the only one of the PIN counts
        k = keys.join(small(ref.context), "pin", "left")
        only = F.when(F.size("pin_districts") == 1, F.get("pin_districts", F.lit(0))).otherwise("")
        keys = k.withColumn("district", F.when(F.col("district") != "", F.col("district")).otherwise(F.coalesce(only, F.lit("")))).select("kid", *KEYS)
    keys = shared(keys, f"{kind}-keys")
    asked = keys.where("query <> ''")
    none, zero = F.lit(""), F.lit(0.0)
    empty = keys.where("query = ''").select("kid", F.lit("NOT_CHECKED").alias("status"), none.alias("match_value"), zero.alias("match_score"), none.alias("source"), none.alias("code"))
    label = "INDIA_POST" if kind == "post_office" else "LGD"
    if kind == "post_office":
        offices = ref.pins.select("pin", F.explode("office_entities").alias("name")).where("name <> ''")
        hit = asked.join(small(offices), "pin")
        same = hit.where("query = name").select("kid").distinct().withColumn("n", F.lit(1)).withColumn("code", none)
        rest = asked.join(same, "kid", "left_anti")
        pairs = hit.select("kid", "query", "name").join(same.select("kid"), "kid", "left_anti")
    else:
        same = shared(exact(asked, kind, ref), f"{kind}-exact")
        rest = shared(asked.join(same, "kid", "left_anti"), f"{kind}-rest")
        pairs = shared(pool(rest, kind, ref), f"{kind}-pool")
    first = asked.join(same, "kid").select("kid", F.when(F.col("n") == 1, "PASS").otherwise("AMBIGUOUS").alias("status"), F.col("query").alias("match_value"), F.lit(1.0).alias("match_score"), F.lit(f"{label}_EXACT").alias("source"), F.when(F.col("n") == 1, F.col("code")).otherwise("").alias("code"))
    best = ranked(pairs)
    if kind == "post_office":
        one = best.withColumn("n", F.lit(1)).withColumn("code", none)
        unknown = rest.join(pairs.select("kid").distinct().withColumn("some", F.lit(True)), "kid", "left").withColumn("lost", F.when(F.col("some"), "FAIL").otherwise("NOT_CHECKED")).select("kid", "lost")
    else:
        found = rest.join(best, "kid").join(small(ref.names[kind]), F.col("best") == F.col("name"))
        if kind == "district":
            found = found.withColumn("district", F.col("best"))
        fit = found if kind == "ulb" else fitting(found, ["kid"], ref.context)
        one = best.join(_counted(fit, ["kid"]), "kid")
        unknown = rest.select("kid", F.lit("NOT_CHECKED" if kind == "ulb" else "FAIL").alias("lost"))
    strong = (F.col("n") == 1) & (F.col("score") >= PASS_AT)
    if kind in ("village", "post_office"):
        strong = strong & ((F.col("score") - F.col("second") >= MARGIN) | (F.col("score") >= VERY_STRONG))
    fuzzy = one.select("kid", F.when(strong, "PASS").otherwise("AMBIGUOUS").alias("status"), F.col("best").alias("match_value"), F.bround("score", 4).alias("match_score"), F.lit(f"{label}_FUZZY").alias("source"), F.when(strong, F.col("code")).otherwise("").alias("code"))
    lost = unknown.join(best.select("kid"), "kid", "left_anti").select("kid", F.col("lost").alias("status"), none.alias("match_value"), zero.alias("match_score"), F.when(F.col("lost") == "FAIL", label).otherwise("LGD" if kind == "ulb" else "").alias("source"), none.alias("code"))
    return empty.unionAll(first).unionAll(fuzzy).unionAll(lost)


ANSWER = ("status", "match_value", "match_score", "source", "code")


def answered(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """`rows` (with kid) joined with the answers of their keys; hot keys are split by the adaptive join."""
    return rows.join(answers, "kid", "left")


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "cleaned_address_data").select("row_id", "full_address", "city", "state", "district", "pincode", "post_office"))


def _office(c: Column) -> Column:
    """The place an office is named after."""
    return F.regexp_replace(c, r"(?i) [BSH]\.O\.?$", "")


def keys_of(rows: DataFrame, kind: str) -> DataFrame:
    """The keyed rows of each kind of entity in this project's address table."""
    c = {k: F.col(k) for k in ("city", "state", "district", "pincode", "post_office")}
    if kind == "district":
        return keyed(rows, c["district"], c["state"], None, None, c["pincode"])
    if kind == "ulb":
        return keyed(rows, c["city"])
    if kind == "subdistrict":
        return keyed(rows, c["city"], c["state"], c["district"], None, c["pincode"])
    if kind == "village":
        return keyed(rows, _office(c["post_office"]), c["state"], c["district"], c["city"], c["pincode"])
    return keyed(rows, c["post_office"], None, None, None, c["pincode"])


def _resolution(kind: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = keys_of(_rows(spark, sf_dir), kind)
        return answered(rows.select("row_id", "query", "kid"), resolved(rows, kind, Reference(spark, sf_dir))).select("row_id", "query", *ANSWER)

    run.__name__ = f"op_resolve_{kind}"
    run.__doc__ = f"Every row's {kind.replace('_', ' ')} resolved."
    return run


def op_exact_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact stage alone: how many master rows the query of each kind leaves in its context (rows without an exact name are absent)."""
    ref, rows = Reference(spark, sf_dir), _rows(spark, sf_dir)
    out = None
    for kind in ("district", "ulb", "subdistrict", "village"):
        k = keys_of(rows, kind).where("query <> ''")
        if kind == "village":
            keys = k.select("kid", *KEYS).distinct().join(small(ref.context), "pin", "left")
            only = F.when(F.size("pin_districts") == 1, F.get("pin_districts", F.lit(0))).otherwise("")
            keys = keys.withColumn("district", F.when(F.col("district") != "", F.col("district")).otherwise(F.coalesce(only, F.lit("")))).select("kid", *KEYS)
        else:
            keys = k.select("kid", *KEYS).distinct()
        part = k.select("row_id", "kid").join(exact(keys, kind, ref), "kid").select("row_id", F.lit(kind).alias("kind"), "n")
        out = part if out is None else out.unionAll(part)
    return out


def op_resolve_locality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled locality of each address: town exact, town fuzzy by shared words, village exact, village fuzzy; the first that answers."""
    from ..functions.extract import labelled

    ref = Reference(spark, sf_dir)
    # the data label few localities, so the last segment stands in for a missing label
    rows = _rows(spark, sf_dir)
    last = F.coalesce(F.try_element_at(F.split(t.clean_text(F.col("full_address")), ","), F.lit(-1)), F.lit(""))
    name = labelled(F.col("full_address"), "locality")
    rows = keyed(rows, F.when(name != "", name).otherwise(last), F.col("state"), F.col("district"), None, F.col("pincode"))
    keys = shared(rows.select("kid", *KEYS).distinct(), "locality-keys")
    left, parts, none = keys.where("query <> ''"), [], F.lit("")
    for kind in ("ulb", "village"):
        found = fitting(left.join(small(ref.names[kind]), F.col("query") == F.col("name")), ["kid"], ref.context)
        same = shared(_counted(found, ["kid"]).join(left.select("kid", "query"), "kid"), f"loc-{kind}")
        label = kind.upper()
        parts.append(same.select("kid", F.when(F.col("n") == 1, label).otherwise("LOCALITY").alias("entity_type"), F.when(F.col("n") == 1, "PASS").otherwise("AMBIGUOUS").alias("status"), F.col("query").alias("match_value"), F.lit(1.0).alias("match_score"), F.lit(f"LGD_{label}_EXACT").alias("source")))
        left = left.join(same.select("kid"), "kid", "left_anti")
        best = ranked(by_token(left, ref.names[kind]))
        fit = fitting(left.join(best, "kid").join(small(ref.names[kind]), F.col("best") == F.col("name")), ["kid"], ref.context)
        one = shared(best.join(_counted(fit, ["kid"]), "kid"), f"loc-{kind}-near")
        strong = (F.col("n") == 1) & (F.col("score") >= PASS_AT)
        parts.append(one.select("kid", F.when(strong, label).otherwise("LOCALITY").alias("entity_type"), F.when(strong, "PASS").otherwise("AMBIGUOUS").alias("status"), F.col("best").alias("match_value"), F.bround("score", 4).alias("match_score"), F.lit(f"LGD_{label}_FUZZY").alias("source")))
        left = shared(left.join(one.select("kid"), "kid", "left_anti"), f"loc-{kind}-left")
    parts.append(left.select("kid", F.lit("LOCALITY").alias("entity_type"), F.lit("FAIL").alias("status"), none.alias("match_value"), F.lit(0.0).alias("match_score"), F.lit("LGD").alias("source")))
    parts.append(keys.where("query = ''").select("kid", F.lit("LOCALITY").alias("entity_type"), F.lit("NOT_CHECKED").alias("status"), none.alias("match_value"), F.lit(0.0).alias("match_score"), none.alias("source")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return rows.select("row_id", "query", "kid").join(out, "kid", "left").drop("kid")


def _sql() -> dict[str, str]:
    def state(c: str) -> str:
        return s_mapped(s_resolving(c), t.FORMER_NAMES | t.VALIDATOR_STATES)

    st = state("state")
    pin = s_six(s_text("pincode"))
    office = r"regexp_replace(@, '(?i) [BSH]\.O\.?$', '')"
    return {"op_exact_resolution": f"""
      WITH ctx AS (SELECT trim(pincode) AS pin, list(DISTINCT {s_entity('district')}) AS pd, list(DISTINCT {state('statename')}) AS ps FROM pin_directory GROUP BY 1),
      r AS (SELECT row_id, {s_entity('city')} AS city, {s_entity('district')} AS district, {s_entity(office.replace('@', 'post_office'))} AS office, {st} AS state, {pin} AS pin FROM cleaned_address_data),
      k AS (SELECT row_id, 'district' AS kind, district AS query, state, district, '' AS sub, pin FROM r UNION ALL SELECT row_id, 'ulb', city, '', '', '', '' FROM r
        UNION ALL SELECT row_id, 'subdistrict', city, state, district, '', pin FROM r UNION ALL SELECT row_id, 'village', office, state, CASE WHEN district <> '' THEN district WHEN len(pd) = 1 THEN pd[1] ELSE '' END, city, r.pin FROM r LEFT JOIN ctx USING (pin)),
      m AS (SELECT 'district' AS kind, {s_resolving('geo_name')} AS name, {s_resolving('geo_name')} AS md, '' AS ms, {state('statename')} AS mt FROM geo_directory WHERE entity_type = 'DISTRICT'
        UNION ALL SELECT 'ulb', {s_resolving('geo_name')}, '', '', '' FROM geo_directory WHERE entity_type = 'ULB'
        UNION ALL SELECT 'subdistrict', c, d, c, s FROM (SELECT DISTINCT district, city, statename, {s_resolving('city')} AS c, {s_resolving('district')} AS d, {state('statename')} AS s FROM pin_directory)
        UNION ALL SELECT 'village', v, d, c, s FROM (SELECT DISTINCT district, city, statename, {s_resolving(office.replace('@', 'officename'))} AS v, {s_resolving('city')} AS c, {s_resolving('district')} AS d, {state('statename')} AS s FROM pin_directory)),
      f AS (SELECT k.row_id, k.kind, k.sub, ms, CASE WHEN k.kind = 'ulb' THEN 0 ELSE CASE WHEN k.district <> '' AND md = k.district THEN 10 ELSE 0 END + CASE WHEN sub <> '' AND ms = sub THEN 8 ELSE 0 END
          + CASE WHEN list_contains(pd, md) THEN 6 ELSE 0 END + CASE WHEN k.state <> '' AND mt = k.state THEN 4 ELSE 0 END + CASE WHEN mt <> '' AND list_contains(ps, mt) THEN 2 ELSE 0 END END AS s
        FROM k JOIN m ON k.kind = m.kind AND k.query = m.name AND k.query <> '' LEFT JOIN ctx ON ctx.pin = k.pin),
      g AS (SELECT *, s = max(s) OVER (PARTITION BY row_id, kind) AS top FROM f),
      h AS (SELECT *, kind = 'village' AND sub <> '' AND ms = sub AS same FROM g WHERE top),
      i AS (SELECT *, bool_or(same) OVER (PARTITION BY row_id, kind) AS anysame FROM h)
      SELECT row_id, kind, count(*) AS n FROM i WHERE same OR NOT anysame GROUP BY row_id, kind"""}


QUERIES = {f"op_resolve_{k}": _resolution(k) for k in ("district", "ulb", "subdistrict", "village", "post_office")} | {"op_exact_resolution": op_exact_resolution, "op_resolve_locality": op_resolve_locality}
SQL = _sql()
