"""Inference of places from the address text, repair of state, PIN and city, and the cleaner.

Containment of a name in an address is an equality join: a name stands in the address, word by word, exactly if it equals one of the
address's runs of words no longer than the longest name. No address meets a name that it doesn't hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import extract as x
from ..functions import text as t
from ..functions.similar import collapse_repeats
from ..plans.tables import shared, small, spread, table
from .resolve import Reference, keyed, resolved
from .textqueries import q, s_city, s_clean, s_entity, s_last_pin, s_mapped, s_matching, s_no_decimal, s_resolving, s_six, s_text


def contained(rows: DataFrame, form: Column, names: DataFrame, shortest: int = 3, word: int = 2) -> DataFrame:
    """(row_id, name): the names of `names` (name) that stand as whole words in the form of each row.

    Names shorter than `shortest`, or without a word of `word` letters, never count. Only the length of the longest name, in words, is
    collected."""
    names = names.select("name").distinct().where((F.length("name") >= shortest) & F.exists(F.split("name", " "), lambda w: F.length(w) >= word))
    most = names.agg(F.max(F.size(F.split("name", " "))).alias("m")).collect()[0].m or 1
    words = rows.select("row_id", F.split(form, " ").alias("w")).where("size(w) > 0 AND w[0] <> ''")
    grams = words.select("row_id", F.explode(F.expr(f"array_distinct(flatten(transform(sequence(1, least({most}, size(w))), n -> transform(sequence(1, size(w) - n + 1), i -> array_join(slice(w, i, n), ' ')))))")).alias("name"))
    return grams.join(small(names), "name").select("row_id", "name")


def _passing(cand: DataFrame, kind: str, ref: Reference, district: str | None = None) -> DataFrame:
    """`cand` (row_id, query_text, state, pincode, ...) with the match of every candidate that resolves with PASS."""
    k = keyed(cand.withColumnRenamed("state", "row_state"), F.col("query_text"), F.col("row_state"), F.col(district) if district else None, None, F.col("pincode"))
    return k.join(resolved(k, kind, ref), "kid").where("status = 'PASS'")


def inferred_district(rows: DataFrame, ref: Reference) -> DataFrame:
    """(row_id, district): the district that the city is; else the first segment that is one; else the only one in the address."""
    names = ref.names["district"].select("name")
    base = rows.select("row_id", "state", "pincode", "city", "full_address")
    by_city = base.where(t.text(F.col("city")) != "").select("row_id", "state", "pincode", F.lit(0).alias("tier"), F.lit(0).alias("pos"), F.col("city").alias("query_text"))
    seg = base.select("row_id", "state", "pincode", F.lit(1).alias("tier"), F.posexplode(x.segments(F.col("full_address"))).alias("pos", "query_text"))
    by_segment = seg.withColumn("name", t.entity(F.col("query_text"))).join(small(names.distinct()), "name").drop("name")
    inside = contained(base, t.entity(F.col("full_address")), names).join(base.select("row_id", "state", "pincode"), "row_id")
    by_text = inside.select("row_id", "state", "pincode", F.lit(2).alias("tier"), F.lit(0).alias("pos"), F.col("name").alias("query_text"))
    hits = _passing(by_city.unionByName(by_segment).unionByName(by_text), "district", ref)
    g = hits.groupBy("row_id").agg(
        F.min_by("match_value", F.struct("tier", "pos")).alias("first"), F.min("tier").alias("least"), F.collect_set(F.when(F.col("tier") == 2, F.col("match_value"))).alias("inside"),
    )
    return g.select("row_id", F.when(F.col("least") < 2, F.col("first")).when(F.size("inside") == 1, F.get("inside", F.lit(0))).alias("district")).where("district IS NOT NULL")


def inferred_lower(rows: DataFrame, kind: str, ref: Reference) -> DataFrame:
    """(row_id, kind): the subdistrict or village of rows that aren't URBAN: the first segment that resolves, else the longest name in the
    address that does (ties: the first in order). `rows` has the district in force as `at_district`."""
    names = ref.names[kind].select("name")
    base = rows.where(x.address_type(F.col("full_address")) != "URBAN").select("row_id", "state", "pincode", "city", "full_address", "at_district")
    seg = base.select("row_id", "state", "pincode", "at_district", "city", F.lit(1).alias("tier"), F.posexplode(x.segments(F.col("full_address"))).alias("pos", "query_text"))
    if kind == "village":
        seg = seg.where(x.may_be_place(F.col("query_text"), F.col("city"), F.col("state")))
    by_segment = seg.drop("city").withColumn("name", t.entity(F.col("query_text"))).join(small(names.distinct()), "name").drop("name")
    inside = contained(base, t.entity(F.col("full_address")), names).join(base.select("row_id", "state", "pincode", "at_district"), "row_id")
    if kind == "subdistrict":
        known = ref.names[kind].select(F.col("m_district").alias("kd"), "name").distinct()
        district = known.select("kd").distinct().withColumn("has", F.lit(True))
        inside = inside.withColumn("kd", t.entity(F.col("at_district"))).join(small(district), "kd", "left").join(small(known.withColumn("own", F.lit(True))), ["kd", "name"], "left").where("has IS NULL OR own").drop("kd", "has", "own")
    by_text = inside.select("row_id", "state", "pincode", "at_district", F.lit(2).alias("tier"), (-F.length("name")).alias("pos"), F.col("name").alias("query_text"))
    hits = _passing(by_segment.unionByName(by_text), kind, ref, "at_district")
    return hits.groupBy("row_id").agg(F.min_by("match_value", F.struct("tier", "pos", "match_value")).alias(kind))


def inferred_office(rows: DataFrame, ref: Reference) -> DataFrame:
    """(row_id, post_office): the labelled office if the PIN has it, else the longest of the PIN's offices in the address."""
    pins = ref.pins.select("pin", "office_entities")
    a, label = t.entity(F.col("full_address")), t.entity(x.labelled(F.col("full_address"), "post_office"))
    r = rows.select("row_id", a.alias("a"), label.alias("l"), t.six_digits(F.col("pincode")).alias("pin")).join(small(pins), "pin")
    inside = F.filter("office_entities", lambda o: (o != "") & F.contains(F.concat(F.lit(" "), F.col("a"), F.lit(" ")), F.concat(F.lit(" "), o, F.lit(" "))))
    longest = F.array_max(F.transform(inside, lambda o: F.struct(F.length(o).alias("n"), o.alias("o"))))["o"]
    return r.select("row_id", F.when(F.array_contains("office_entities", F.col("l")) & (F.col("l") != ""), F.col("l")).otherwise(longest).alias("post_office")).where("post_office IS NOT NULL")


def _address_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "cleaned_address_data").select("row_id", "full_address", "city", "state", "pincode", "district", "post_office"))


def op_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """District, subdistrict, village and office of every row, supplied or inferred, and whether each was supplied (explicit)."""
    ref, rows = Reference(spark, sf_dir), _address_rows(spark, sf_dir)
    text = F.col("full_address")
    given = {k: x.labelled(text, k) for k in ("subdistrict", "village")}
    given["district"] = F.when(t.text(F.col("district")) != "", t.text(F.col("district"))).otherwise(x.labelled(text, "district"))
    given["post_office"] = F.when(t.text(F.col("post_office")) != "", t.text(F.col("post_office"))).otherwise(x.labelled(text, "post_office"))
    base = rows.select("row_id", "full_address", "city", "state", "pincode", *[c.alias(f"given_{k}") for k, c in given.items()])
    d = shared(base.join(inferred_district(base.where("given_district = ''"), ref), "row_id", "left").withColumn("at_district", F.when(F.col("given_district") != "", F.col("given_district")).otherwise(F.coalesce("district", F.lit("")))).drop("district"), "inferred")
    out = d
    for kind in ("subdistrict", "village"):
        out = out.join(inferred_lower(d.where(f"given_{kind} = ''"), kind, ref), "row_id", "left")
    out = out.join(inferred_office(d.where("given_post_office = ''"), ref), "row_id", "left")
    final = {k: F.when(F.col(f"given_{k}") != "", F.col(f"given_{k}")).otherwise(F.coalesce(k, F.lit(""))) for k in ("subdistrict", "village", "post_office")}
    return out.select("row_id", F.col("at_district").alias("district"), *[c.alias(k) for k, c in final.items()], *[(F.col(f"given_{k}") != "").alias(f"{k}_explicit") for k in given])


def op_contained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Districts and towns that stand in each address, by the resolvers' rule and by the cleaner's."""
    ref, rows = Reference(spark, sf_dir), _address_rows(spark, sf_dir)
    a = contained(rows, t.entity(F.col("full_address")), ref.names["district"]).select("row_id", F.lit("district").alias("kind"), "name")
    b = contained(rows, t.for_resolving(F.col("full_address")), ref.names["ulb"], 3, 3).select("row_id", F.lit("ulb").alias("kind"), "name")
    return a.unionAll(b)


def op_inferred_office(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The office that each address names among those of its PIN."""
    return inferred_office(_address_rows(spark, sf_dir), Reference(spark, sf_dir))


NO_RESOLUTION = "didn't needed any resolving"  # fixed value: the remark of a row that was left as it is


def auto_resolved(rows: DataFrame, ref: Reference, respect_clean_city: bool = False) -> DataFrame:
    """(row_id, city, state, pincode, remark): state, PIN and city of each row repaired from its PIN and its address.

    A supplied city gives way to the only town in the address, as it always has; `respect_clean_city` keeps it."""
    pins = ref.pins.select(F.col("pin").alias("known_pin"), F.col("state").alias("pin_state"))
    a = F.col("full_address")
    base = rows.select("row_id", t.text(a).alias("address"), t.text(F.col("city")).alias("old_city"), t.text(F.col("state")).alias("old_state"), t.text(F.col("pincode")).alias("old_pin"), t.resolver_state(F.col("state")).alias("state0"), t.plain_pin(F.col("pincode")).alias("pin0"))
    base = base.join(small(pins), F.col("pin0") == F.col("known_pin"), "left")
    # the states of the postal table: a few dozen names
    names = [r.s for r in ref.pins.select(F.explode("states").alias("s")).distinct().collect()]
    canonical = {n: n2 for n, n2 in ((r.s, r.c) for r in ref.pins.select(F.explode("states").alias("s")).distinct().withColumn("c", t.resolver_state(F.col("s"))).collect())}
    forms = {n: canonical[n] for n in names} | {c.replace(" ", ""): c.replace(" ", "") for c in canonical.values()}
    table_ = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(c).alias("c"), F.lit(n.replace(" ", "")).alias("k")) for n, c in sorted(forms.items()) if len(n) >= 3])
    base = base.withColumn("plain", t.for_resolving(F.col("address"))).withColumn("squeezed", F.replace("plain", F.lit(" "), F.lit("")))
    plain, squeezed = F.col("plain"), F.col("squeezed")
    hit = F.filter(table_, lambda s: F.contains(F.concat(F.lit(" "), plain, F.lit(" ")), F.concat(F.lit(" "), s["n"], F.lit(" "))) | ((F.length(s["k"]) >= 5) & F.contains(squeezed, s["k"])))
    base = base.withColumn("said", F.array_distinct(F.transform(hit, lambda s: s["c"])))
    only = F.when(F.size("said") == 1, F.get("said", F.lit(0)))
    ps, s0 = F.nullif(F.coalesce("pin_state", F.lit("")), F.lit("")), F.col("state0")
    blank = F.when(ps.isNotNull() & ((F.size("said") == 0) | F.array_contains("said", ps)), ps).otherwise(F.coalesce(only, F.lit("")))
    wrong = F.when(ps.isNotNull(), ps).otherwise(F.coalesce(only, s0))
    base = base.withColumn("state1", F.when(s0 == "", blank).otherwise(wrong))
    base = shared(base, "auto-base")
    # PIN candidates: known PINs in the address, and those of offices that a label or a whole segment names
    office = F.regexp_extract_all(F.col("address"), F.lit(r"(?i)" + x.EDGE + r"(?:PO|P\.O\.|POST OFFICE|POST)\s*[-.:]?\s*([^,;]+)"), F.lit(1))
    named = F.transform(F.concat(office, F.split("address", "[,;]")), t.for_resolving)
    runs = base.select("row_id", "state1", F.explode(F.array_distinct(t.pin_runs(F.col("address")))).alias("pin")).join(small(ref.pins.select("pin", F.col("state").alias("ps"))), "pin")
    to_pins = ref.pins.select("pin", F.col("state").alias("ps"), F.explode("offices").alias("office"))
    by_name = base.select("row_id", "state1", F.explode(F.array_distinct(F.filter(named, lambda n: n != ""))).alias("office")).join(small(to_pins), "office").select("pin", "row_id", "state1", "ps")
    cand = runs.select("pin", "row_id", "state1", "ps").unionAll(by_name).where("state1 = '' OR ps = state1").groupBy("row_id").agg(F.count_distinct("pin").alias("pins"), F.min("pin").alias("pin1"))
    towns = contained(base, plain, ref.names["ulb"], 3, 3)
    one = ref.names["ulb"].groupBy("name").agg(F.count("*").alias("n"))
    towns = towns.withColumn("name", t.entity(F.col("name"))).join(small(one.where("n = 1")), "name").groupBy("row_id").agg(F.count_distinct("name").alias("towns"), F.min("name").alias("town"))
    r = base.join(cand, "row_id", "left").join(towns, "row_id", "left")
    fix = F.col("known_pin").isNull() & (F.col("pins") == 1) & (F.col("pin1") != F.col("pin0"))
    r = r.withColumn("pin2", F.when(fix, F.col("pin1")).otherwise(F.col("pin0")))
    kept = F.col("old_city") if respect_clean_city else F.lit("")
    r = r.withColumn("city2", F.when(kept != "", kept).otherwise(F.when(F.col("towns") == 1, F.col("town")).otherwise("")))
    nothing = F.upper("address").isin("", "-", "--", "0", "0.0", "NA", "N/A", "NULL", "NONE")
    lacking = F.array_compact(F.array(F.when(nothing, F.lit("Complete Address")), F.when(F.col("city2") == "", F.lit("City")), F.when(F.col("state1") == "", F.lit("State")), F.when(F.col("pin2") == "", F.lit("Pincode"))))
    remarks = F.array_compact(F.array(
        F.when((s0 == "") & (F.col("state1") != ""), F.concat(F.lit("state auto resolved from null->"), "state1")), F.when((s0 != "") & (F.col("state1") != s0), F.concat(F.lit("state auto corrected "), "old_state", F.lit("->"), "state1")),
        F.when(fix, F.concat(F.lit("pin auto corrected "), F.coalesce(F.nullif("old_pin", F.lit("")), F.lit("null")), F.lit("->"), "pin2")), F.when((kept == "") & (F.col("city2") != ""), F.concat(F.lit("city missing and resolved null->"), "city2")),
        F.when(F.size(lacking) > 0, F.concat(F.lit("Missing: "), F.array_join(lacking, ", "))),
    ))
    return r.select("row_id", F.col("city2").alias("city"), F.col("state1").alias("state"), F.col("pin2").alias("pincode"), F.when(F.size(remarks) > 0, F.array_join(remarks, "; ")).otherwise(NO_RESOLUTION).alias("remark"))


def op_auto_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State, PIN and city of every row repaired, with the remark."""
    return auto_resolved(_address_rows(spark, sf_dir), Reference(spark, sf_dir))


def cleaned(rows: DataFrame, ref: Reference, offices: DataFrame) -> DataFrame:
    """(row_id, clean parts): PIN, state, city in four tiers, and the body, of each raw address; null and empty ones give empty texts."""
    raw = t.clean_text(F.col("full_address"))
    r = rows.select("row_id", raw.alias("raw"), t.last_pin(raw).alias("pin"), x.state_in_text(raw).alias("state"))
    r = r.withColumn("by_segment", x.city_by_segment(F.col("raw"), F.col("state"), F.col("pin"))).withColumn("by_suffix", x.city_by_suffix(F.col("raw"), F.col("state"), F.col("pin")))
    r = r.withColumn("no_segment", x.without_pin_segments(F.col("raw"), F.col("pin"))).withColumn("body", x.without_metadata(x.without_pin_segments(F.col("no_segment"), F.col("pin")), F.col("state"), F.col("pin")))
    r = shared(r, "clean-parts")
    need = r.where("by_segment = '' AND raw <> ''")
    form = t.for_matching(F.col("raw"))
    town = contained(need, form, ref.names["ulb"], 3, 3).join(need.select("row_id", "state"), "row_id").where("state = '' OR name <> state").groupBy("row_id").agg(F.max_by("name", F.struct(F.length("name"), "name")).alias("by_town"))
    o = need.where("pin <> ''").select("row_id", "pin", form.alias("a")).join(small(offices), "pin").where(F.length(t.for_matching(F.col("office"))) >= 3)
    o = o.where(F.contains(F.concat(F.lit(" "), F.col("a"), F.lit(" ")), F.concat(F.lit(" "), t.for_matching(F.col("office")), F.lit(" ")))).groupBy("row_id").agg(F.max_by("office", F.struct(F.length(t.for_matching(F.col("office"))), "office")).alias("by_office"))
    r = r.join(town, "row_id", "left").join(o, "row_id", "left").na.fill("", ["by_town", "by_office"])
    city = F.coalesce(*[F.nullif(c, F.lit("")) for c in ("by_segment", "by_town", "by_office", "by_suffix")], F.lit(""))
    return r.withColumn("city", city)


def _offices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pin_directory").select(t.last_pin(F.col("pincode")).alias("pin"), t.clean_text(F.col("officename")).alias("office")).where("pin <> '' AND office <> ''").distinct()


def op_clean_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the cleaner finds in each address: PIN, state, the four tiers of the city, and the body without them."""
    r = cleaned(_address_rows(spark, sf_dir), Reference(spark, sf_dir), _offices(spark, sf_dir))
    return r.select("row_id", "pin", "state", "by_segment", "by_town", "by_office", "by_suffix", "city", "no_segment", "body")


def op_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean address with its city, PIN and state: the body without repeated blocks and later copies of city and state."""
    r = cleaned(_address_rows(spark, sf_dir), Reference(spark, sf_dir), _offices(spark, sf_dir))
    r = r.withColumn("body", t.clean_text(collapse_repeats(t.clean_text(F.col("body")))))
    r = r.withColumn("body", x.first_of_repeats(F.col("body"), F.col("city"), 3))
    return r.select("row_id", x.first_of_repeats(F.col("body"), F.col("state"), 4).alias("clean_full_address"), F.col("city").alias("clean_city"), F.col("pin").alias("clean_pincode"), F.col("state").alias("clean_state"))


def _sql() -> dict[str, str]:
    addr = "cleaned_address_data"
    pad = "contains(' ' || {0} || ' ', ' ' || {1} || ' ')"
    dn = f"SELECT DISTINCT {s_resolving('geo_name')} AS name FROM geo_directory WHERE entity_type = 'DISTRICT'"
    un = f"SELECT {s_resolving('geo_name')} AS name FROM geo_directory WHERE entity_type = 'ULB'"
    rs = t.FORMER_NAMES | t.VALIDATOR_STATES

    def state(c: str) -> str:
        return s_mapped(s_resolving(c), rs)

    label = "coalesce(" + ", ".join(f"nullif({s_text('regexp_extract(s, ' + q('(?i)' + x.EDGE + p + x.NAME) + ', 1)')}, '')" for p in x.LABELLED["post_office"]) + ", '')"
    office = f"""WITH o AS (SELECT DISTINCT trim(pincode) AS pin, {s_entity('officename')} AS o FROM pin_directory), r AS (SELECT row_id, {s_entity('full_address')} AS a, {s_entity('(' + label + ')')} AS l, {s_six(s_text('pincode'))} AS pin FROM (SELECT row_id, full_address, pincode, {s_text('full_address')} AS s FROM {addr})),
      j AS (SELECT row_id, o, o = l AND l <> '' AS hit FROM r JOIN o USING (pin) WHERE o <> '' AND (o = l OR {pad.format('a', 'o')}))
      SELECT row_id, arg_max(o, (hit, length(o), o)) AS post_office FROM j GROUP BY row_id"""
    pins = f"SELECT trim(pincode) AS pin, CASE WHEN count(DISTINCT {state('statename')}) = 1 THEN min({state('statename')}) ELSE '' END AS ps FROM pin_directory GROUP BY 1"
    auto = rf"""WITH p AS ({pins}), sn AS (SELECT DISTINCT {s_resolving('statename')} AS n FROM pin_directory), sc AS (SELECT n, {s_mapped('n', rs)} AS c FROM sn), f AS (SELECT n, c FROM sc UNION SELECT replace(c, ' ', ''), replace(c, ' ', '') FROM sc WHERE replace(c, ' ', '') NOT IN (SELECT n FROM sc)),
      b AS (SELECT row_id, {s_text('full_address')} AS a, {s_resolving('full_address')} AS m, {s_text('state')} AS os, {s_text('pincode')} AS op, {state('state')} AS s0, {s_six(s_no_decimal('pincode'))} AS p0 FROM {addr}),
      said AS (SELECT row_id, count(DISTINCT c) AS k, min(c) AS c1, list(DISTINCT c) AS l FROM b JOIN f ON length(n) >= 3 AND ({pad.format('m', 'n')} OR (length(replace(n, ' ', '')) >= 5 AND contains(replace(m, ' ', ''), replace(n, ' ', '')))) GROUP BY row_id),
      c AS (SELECT b.*, p.pin IS NOT NULL AS known, nullif(p.ps, '') AS ps, coalesce(k, 0) AS k, CASE WHEN k = 1 THEN c1 END AS only1, l FROM b LEFT JOIN p ON p.pin = b.p0 LEFT JOIN said USING (row_id)),
      d AS (SELECT *, CASE WHEN s0 = '' THEN CASE WHEN ps IS NOT NULL AND (k = 0 OR list_contains(l, ps)) THEN ps ELSE coalesce(only1, '') END WHEN ps IS NOT NULL THEN ps ELSE coalesce(only1, s0) END AS s1 FROM c),
      w AS (SELECT row_id, s1, unnest({s_last_pin('a').replace('coalesce(', '', 1).rsplit('[-1]', 1)[0]}) AS pin FROM d),
      g AS (SELECT row_id, s1, unnest(list_concat(regexp_extract_all(a, {q('(?i)' + x.EDGE + '(?:PO|P' + chr(92) + '.O' + chr(92) + '.|POST OFFICE|POST)' + x.NAME)}, 1), regexp_split_to_array(a, '[,;]'))) AS o FROM d),
      h AS (SELECT row_id, s1, trim(pincode) AS pin FROM (SELECT row_id, s1, {s_resolving('o')} AS o FROM g) z JOIN (SELECT pincode, {s_resolving('officename')} AS o FROM pin_directory) y USING (o) WHERE o <> ''),
      e AS (SELECT row_id, count(DISTINCT pin) AS n, min(pin) AS p1 FROM (SELECT * FROM w UNION ALL SELECT * FROM h) JOIN p USING (pin) WHERE s1 = '' OR p.ps = s1 GROUP BY row_id),
      u AS ({un}), u1 AS (SELECT name FROM u GROUP BY name HAVING count(*) = 1), t AS (SELECT row_id, count(DISTINCT {s_entity('name')}) AS n, min({s_entity('name')}) AS town FROM d JOIN (SELECT DISTINCT name FROM u) ON length(name) >= 3 AND len(list_filter(string_split(name, ' '), lambda z: length(z) >= 3)) > 0 AND {pad.format('m', 'name')} WHERE {s_entity('name')} IN (SELECT name FROM u1) GROUP BY row_id),
      v AS (SELECT d.*, NOT known AND e.n = 1 AND p1 <> p0 AS fix, CASE WHEN NOT known AND e.n = 1 THEN p1 ELSE p0 END AS p2, CASE WHEN t.n = 1 THEN town ELSE '' END AS city FROM d LEFT JOIN e USING (row_id) LEFT JOIN t USING (row_id)),
      x AS (SELECT *, concat_ws(', ', CASE WHEN upper(a) IN ('', '-', '--', '0', '0.0', 'NA', 'N/A', 'NULL', 'NONE') THEN 'Complete Address' END, CASE WHEN city = '' THEN 'City' END, CASE WHEN s1 = '' THEN 'State' END, CASE WHEN p2 = '' THEN 'Pincode' END) AS lacking FROM v)
      SELECT row_id, city, s1 AS state, p2 AS pincode, coalesce(nullif(concat_ws('; ', CASE WHEN s0 = '' AND s1 <> '' THEN 'state auto resolved from null->' || s1 END, CASE WHEN s0 <> '' AND s1 <> s0 THEN 'state auto corrected ' || os || '->' || s1 END,
        CASE WHEN fix THEN 'pin auto corrected ' || coalesce(nullif(op, ''), 'null') || '->' || p2 END, CASE WHEN city <> '' THEN 'city missing and resolved null->' || city END, CASE WHEN lacking <> '' THEN 'Missing: ' || lacking END), ''), {q(NO_RESOLUTION)}) AS remark FROM x"""
    # the cleaner: a PIN is cut out twice, as neighbours share the character between them and the dialect can't look around
    longest = sorted(t.STATES_IN_TEXT, key=lambda z: (-len(z), z))
    said = s_mapped(rf"coalesce(regexp_extract_all({s_matching('raw')}, '\b(?:{'|'.join(longest)})\b')[-1], '')", t.STATES_IN_TEXT)
    forms: dict[str, list[str]] = {}
    for form, name in t.STATES_IN_TEXT.items():
        forms.setdefault(name, []).append(form)

    def no_state(c: str) -> str:
        cases = " ".join(f"WHEN {q(n)} THEN regexp_replace({s_matching(c)}, {q(chr(92) + 'b(?:' + '|'.join(sorted({*f, n}, key=lambda z: (-len(z), z))) + ')' + chr(92) + 'b')}, ' ', 'g')" for n, f in sorted(forms.items()))
        return f"CASE WHEN state = '' THEN {s_matching(c)} ELSE trim(regexp_replace(CASE state {cases} END, ' +', ' ', 'g')) END"

    def no_pin(c: str) -> str:
        once = r"regexp_replace({0}, '(^|[^\p{Nd}])' || pin || '([^\p{Nd}]|$)', '\1 \2', 'g')"
        return f"CASE WHEN pin = '' THEN {c} ELSE {once.replace('{0}', once.replace('{0}', c))} END"

    def no_meta(c: str) -> str:
        cut = f"({no_pin(s_clean(c))})"
        return rf"regexp_replace(regexp_replace(CASE WHEN state = '' THEN {cut} ELSE ({no_state(cut)}) END, '{t.WS}+', ' ', 'g'), '\A[ ,]+|[ ,]+\z', '', 'g')"

    segs = f"CASE WHEN pin = '' THEN {s_clean('raw')} ELSE array_to_string(list_filter(list_transform(string_split({s_clean('raw')}, ','), lambda z: trim(z)), lambda z: z <> '' AND {s_matching('z')} <> pin), ',') END"
    parts = rf"""WITH a AS (SELECT row_id, raw, {s_last_pin('raw')} AS pin, {said} AS state FROM (SELECT row_id, {s_clean('full_address')} AS raw FROM {addr})),
      b AS (SELECT *, {segs} AS no_segment FROM a), c AS (SELECT *, {no_meta('no_segment')} AS body, {no_meta('raw')} AS tail FROM b),
      g AS (SELECT row_id, state, pin, pos, regexp_replace(regexp_replace(CASE WHEN state = '' THEN k ELSE ({no_state('k')}) END, '{t.WS}+', ' ', 'g'), '\A[ ,/-]+|[ ,/-]+\z', '', 'g') AS z FROM (SELECT *, {no_pin(s_clean('seg'))} AS k FROM (SELECT row_id, state, pin, unnest(range(len(l))) AS pos, unnest(l) AS seg FROM (SELECT *, string_split(raw, ',') AS l FROM c)) WHERE seg <> '')),
      s AS (SELECT row_id, arg_max(z, pos) AS by_segment FROM g WHERE {s_city('z', 'state', 'pin')} GROUP BY row_id),
      w AS (SELECT row_id, state, pin, n, array_to_string(list_slice(ws, len(ws) - n + 1, len(ws)), ' ') AS z FROM (SELECT row_id, state, pin, ws, unnest(range(1, least(4, len(ws)) + 1)) AS n FROM (SELECT *, string_split(tail, ' ') AS ws FROM c))),
      x AS (SELECT row_id, arg_min(z, n) AS by_suffix FROM w WHERE {s_city('z', 'state', 'pin')} GROUP BY row_id),
      u AS (SELECT DISTINCT name FROM ({un}) WHERE length(name) >= 3 AND len(list_filter(string_split(name, ' '), lambda z: length(z) >= 3)) > 0),
      n AS (SELECT c.row_id, c.raw, c.pin, c.state, {s_matching('c.raw')} AS m FROM c LEFT JOIN s USING (row_id) WHERE coalesce(by_segment, '') = '' AND c.raw <> ''),
      o AS (SELECT row_id, arg_max(name, (length(name), name)) AS by_town FROM n JOIN u ON {pad.format('m', 'name')} WHERE state = '' OR name <> state GROUP BY row_id),
      f AS (SELECT row_id, arg_max(office, (length(om), office)) AS by_office FROM n JOIN (SELECT DISTINCT {s_last_pin('pincode')} AS pin, {s_clean('officename')} AS office, {s_matching('officename')} AS om FROM pin_directory) USING (pin) WHERE pin <> '' AND length(om) >= 3 AND {pad.format('m', 'om')} GROUP BY row_id)
      SELECT row_id, pin, state, coalesce(by_segment, '') AS by_segment, coalesce(by_town, '') AS by_town, coalesce(by_office, '') AS by_office, coalesce(by_suffix, '') AS by_suffix,
        coalesce(nullif(by_segment, ''), by_town, by_office, by_suffix, '') AS city, no_segment, body FROM c LEFT JOIN s USING (row_id) LEFT JOIN x USING (row_id) LEFT JOIN o USING (row_id) LEFT JOIN f USING (row_id)"""
    return {
        "op_clean_parts": parts,
        "op_contained": f"SELECT row_id, 'district' AS kind, name FROM (SELECT row_id, {s_entity('full_address')} AS a FROM {addr}) JOIN ({dn}) ON length(name) >= 3 AND {pad.format('a', 'name')} UNION ALL SELECT DISTINCT row_id, 'ulb', name FROM (SELECT row_id, {s_resolving('full_address')} AS a FROM {addr}) JOIN ({un}) ON length(name) >= 3 AND len(list_filter(string_split(name, ' '), lambda z: length(z) >= 3)) > 0 AND {pad.format('a', 'name')}",
        "op_inferred_office": office,
        "op_auto_resolve": auto,
    }


QUERIES = {f.__name__: f for f in (op_inferred, op_contained, op_inferred_office, op_auto_resolve, op_clean_parts, op_cleaned)}
SQL = _sql()
