"""Quality score of an address from its checks, the parts it shows and what resolves: fractions, weights, class. All plain columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import extract as x
from ..functions import text as t
from ..plans.tables import shared, small, spread, table
from .checks import SQL as CHECK_SQL
from .checks import checked
from .resolve import SQL as EXACT_SQL
from .resolve import Reference, keys_of, op_exact_resolution, resolved
from .textqueries import SQL as TEXT_SQL
from .textqueries import s_entity, s_six, s_text

# Weights of the parts of a score, and the classes with the score from which they hold.
WEIGHTS = {"pin": 15, "geo": 25, "premise": 20, "street_locality": 20, "standardization": 10, "geo_confidence": 10}
CLASSES = (("EXCELLENT", 90), ("GOOD", 75), ("USABLE", 60), ("REQUIRES_CALL", 40))
#: Fixed value: most that an address of a bad PIN may score.
CAP = 39.99


def quality_class(score: Column) -> Column:
    """The class of a score; INVALID below all bounds, and for null and NaN."""
    good = F.when(~F.isnan(score), score)
    out = F.when(good >= CLASSES[0][1], CLASSES[0][0])
    for name, least in CLASSES[1:]:
        out = out.when(good >= least, name)
    return out.otherwise("INVALID")


def points(fraction: Column, weight: int) -> Column:
    return F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), fraction)) * weight, 2)


def third(status: Column, missing: float = 0.0) -> Column:
    """1 for PASS, 0.5 for AMBIGUOUS, `missing` for the rest."""
    return F.when(status == "PASS", 1.0).when(status == "AMBIGUOUS", 0.5).otherwise(missing)


def village_status(status: Column, supplied: Column) -> Column:
    return F.when(~supplied, "NOT_CHECKED").when(status.isin("PASS", "AMBIGUOUS"), status).otherwise("FAIL")


def village_fraction(status: Column, supplied: Column) -> Column:
    return F.when(~supplied, 1.0).otherwise(third(status))


def office_city_status(office: Column, ulb: Column, city: Column, supplied: Column) -> Column:
    """By the office if one is supplied, else by the town; a town that isn't found is no failure."""
    by_city = F.when((city != "") & ulb.isin("PASS", "AMBIGUOUS"), ulb).otherwise("NOT_CHECKED")
    return F.when(supplied, F.when(office.isin("PASS", "AMBIGUOUS"), office).otherwise("FAIL")).otherwise(by_city)


def office_city_fraction(office: Column, ulb: Column, city: Column, supplied: Column) -> Column:
    return F.when(supplied, third(office)).when(city != "", third(ulb, 0.5)).otherwise(0.5)


def geo_fraction(pin_state: Column, evidence: Column, district: Column, village: Column, office_city: Column, anchor: Column) -> Column:
    return (pin_state * 7 + evidence * 3 + F.when(district == "PASS", 1.0).otherwise(0.5) * 2 + village * 5 + office_city * 3 + anchor.cast("double") * 5) / 25


def premise_fraction(premise: Column, building: Column, village: Column) -> Column:
    """`village` tells whether a village is supplied or resolved, which stands in for half of a house number."""
    number = F.when(premise, 1.0).when(village, 0.5).otherwise(0.0)
    return (number * 10 + building.cast("double") * 5 + (premise | building | village).cast("double") * 5) / 20


def street_fraction(street: Column, locality: Column, anchor: Column) -> Column:
    return (street.cast("double") * 8 + locality.cast("double") * 7 + anchor.cast("double") * 5) / 20


def standard_fraction(garbage: Column, auto_correctable: Column) -> Column:
    return F.when(garbage == "FAIL", 0.0).when(garbage == "AMBIGUOUS", 0.5).otherwise(F.when(auto_correctable, 0.9).otherwise(1.0))


def confidence_fraction(pin_state: Column, evidence: Column, local: Column) -> Column:
    """`local` tells whether a village, subdistrict, office or town resolved."""
    seen = evidence == "PASS"
    return F.when(pin_state == "PASS", F.when(local, 1.0).when(seen, 0.85).otherwise(0.75)).when(pin_state == "AMBIGUOUS", 0.5).when(pin_state == "NOT_CHECKED", F.when(seen, 0.85).otherwise(0.5)).otherwise(0.0)


def with_scores(r: DataFrame) -> DataFrame:
    """`r` with the part scores, raw and final score, class: from the check structs, the shown parts and the five *_status columns."""
    village, office, ulb, city = F.col("village_status"), F.col("post_office_status"), F.col("ulb_status"), t.text(F.col("city"))
    has_village, has_office = F.lit(False), t.text(F.col("post_office")) != ""
    ps, ev = F.col("pin_state"), F.col("district_evidence")
    local = (village == "PASS") | (F.col("subdistrict_status") == "PASS") | (office == "PASS") | (ulb == "PASS")
    fractions = {
        "pin": F.col("pin_exists.fraction"),
        "geo": geo_fraction(ps["fraction"], ev["fraction"], F.col("district_status"), village_fraction(village, has_village), office_city_fraction(office, ulb, city, has_office), F.col("anchor")),
        "premise": premise_fraction(F.col("premise"), F.col("building"), village == "PASS"), "street_locality": street_fraction(F.col("street"), F.col("locality"), F.col("anchor")),
        "standardization": standard_fraction(F.col("garbage.status"), F.col("pin_format.auto_correctable")), "geo_confidence": confidence_fraction(ps["status"], ev["status"], local),
    }
    r = r.select("*", *[points(f, WEIGHTS[k]).alias(f"{k}_score") for k, f in fractions.items()])
    r = r.withColumn("raw_score", F.bround(sum((F.col(f"{k}_score") for k in WEIGHTS), F.lit(0.0)), 2))
    dead = (F.col("present.status") == "FAIL") | (F.col("garbage.status") == "FAIL")
    r = r.withColumn("score", F.when(dead, 0.0).when(F.col("pin_exists.status") == "FAIL", F.least(F.col("raw_score"), F.lit(CAP))).otherwise(F.col("raw_score")))
    return r.withColumn("hard_invalid", dead | (F.col("pin_exists.status") == "FAIL")).withColumn("class", quality_class(F.col("score")))


def scored(rows: DataFrame, ref: Reference) -> DataFrame:
    """`rows` (row_id, full_address, city, state, district, pincode, post_office) with statuses, parts, scores, class and a JSON of it all."""
    r = checked(rows, ref.pins)
    for kind in ("district", "ulb", "subdistrict", "village", "post_office"):
        k = shared(keys_of(rows.select("row_id", "city", "state", "district", "pincode", "post_office"), kind).select("row_id", "kid", "query", "state", "district", "subdistrict", "pin"), f"score-{kind}")
        answers = k.select("row_id", "kid").join(resolved(k, kind, ref).select("kid", F.col("status").alias(f"{kind}_status"), F.col("match_value").alias(f"resolved_{kind}")), "kid").drop("kid")
        r = r.join(answers, "row_id", "left")
    a = F.col("full_address")
    r = r.select("*", x.has_premise(a).alias("premise"), *[x.has(a, k).alias(k) for k in x.WORDS], x.address_type(a).alias("address_type"))
    r, city = with_scores(r), t.text(F.col("city"))
    meta = F.to_json(F.struct(
        F.struct(t.text(a).alias("address"), city.alias("city"), t.text(F.col("state")).alias("state"), t.text(F.col("pincode")).alias("pin")).alias("input"), F.col("address_type"),
        F.struct(*[F.coalesce(f"resolved_{k}", F.lit("")).alias(k) for k in ("district", "ulb", "subdistrict", "village", "post_office")]).alias("resolved"),
        F.struct(*[F.col(f"{k}_status").alias(k) for k in ("district", "ulb", "subdistrict", "village", "post_office")]).alias("statuses"), F.struct(*[F.col(k).cast("int").alias(k) for k in ("premise", *x.WORDS)]).alias("components"),
    ))
    return r.withColumn("metadata", meta)


def op_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part scores, score, class and metadata of every address."""
    rows = spread(table(spark, sf_dir, "cleaned_address_data").select("row_id", "full_address", "city", "state", "district", "pincode", "post_office"))
    return scored(rows, Reference(spark, sf_dir)).select("row_id", *[f"{k}_score" for k in WEIGHTS], "raw_score", "score", "hard_invalid", "class", "metadata")


def op_exact_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores when only exact names resolve: one place passes, several are ambiguous, none fails (a town: isn't checked)."""
    rows = spread(table(spark, sf_dir, "cleaned_address_data").select("row_id", "full_address", "city", "state", "district", "pincode", "post_office"))
    ref = Reference(spark, sf_dir)
    n = op_exact_resolution(spark, sf_dir).groupBy("row_id").agg(*[F.max(F.when(F.col("kind") == k, F.col("n"))).alias(f"n_{k}") for k in ("district", "ulb", "subdistrict", "village")])
    r = checked(rows, ref.pins).join(n, "row_id", "left")
    office = t.entity(F.col("post_office"))
    pins = ref.pins.select(F.col("pin").alias("office_pin"), "office_entities")
    r = r.join(small(pins), t.six_digits(F.col("pincode")) == F.col("office_pin"), "left")
    hit = F.when(office == "", "NOT_CHECKED").when(F.array_contains("office_entities", office), "PASS").when(F.col("office_entities").isNull(), "NOT_CHECKED").otherwise("FAIL")
    status = {k: F.when(F.col(f"n_{k}") == 1, "PASS").when(F.col(f"n_{k}") > 1, "AMBIGUOUS").otherwise("NOT_CHECKED" if k == "ulb" else "FAIL").alias(f"{k}_status") for k in ("district", "ulb", "subdistrict", "village")}
    a = F.col("full_address")
    r = r.select("*", *status.values(), hit.alias("post_office_status"), x.has_premise(a).alias("premise"), *[x.has(a, k).alias(k) for k in x.WORDS])
    return with_scores(r).select("row_id", *[f"{k}_score" for k in WEIGHTS], "raw_score", "score", "hard_invalid", "class")


def _exact_sql() -> str:
    def third(c: str, missing: str) -> str:
        return f"CASE {c} WHEN 'PASS' THEN 1.0 WHEN 'AMBIGUOUS' THEN 0.5 ELSE {missing} END"

    kinds = ", ".join(f"CASE WHEN n_{k} = 1 THEN 'PASS' WHEN n_{k} > 1 THEN 'AMBIGUOUS' ELSE {chr(39) + ('NOT_CHECKED' if k == 'ulb' else 'FAIL') + chr(39)} END AS {k}" for k in ("district", "ulb", "subdistrict", "village"))
    ns = ", ".join(f"max(n) FILTER (kind = '{k}') AS n_{k}" for k in ("district", "ulb", "subdistrict", "village"))
    geo = f"(pin_state_fraction * 7 + district_evidence_fraction * 3 + CASE WHEN district = 'PASS' THEN 1.0 ELSE 0.5 END * 2 + 5 + CASE WHEN po <> '' THEN {third('office', '0.0')} WHEN ci <> '' THEN {third('ulb', '0.5')} ELSE 0.5 END * 3 + anchor::INT * 5) / 25.0"
    prem = "(CASE WHEN premise THEN 1.0 WHEN village = 'PASS' THEN 0.5 ELSE 0.0 END * 10 + building::INT * 5 + (premise OR building OR village = 'PASS')::INT * 5) / 20.0"
    conf = "CASE pin_state WHEN 'PASS' THEN CASE WHEN 'PASS' IN (village, subdistrict, office, ulb) THEN 1.0 WHEN district_evidence = 'PASS' THEN 0.85 ELSE 0.75 END WHEN 'AMBIGUOUS' THEN 0.5 WHEN 'NOT_CHECKED' THEN CASE WHEN district_evidence = 'PASS' THEN 0.85 ELSE 0.5 END ELSE 0.0 END"
    std = "CASE garbage WHEN 'FAIL' THEN 0.0 WHEN 'AMBIGUOUS' THEN 0.5 ELSE CASE WHEN auto_correctable THEN 0.9 ELSE 1.0 END END"
    fr = {"pin": "pin_exists_fraction", "geo": geo, "premise": prem, "street_locality": "(street::INT * 8 + locality::INT * 7 + anchor::INT * 5) / 20.0", "standardization": std, "geo_confidence": conf}
    pts = ", ".join(f"round_even(CAST({f} AS DOUBLE) * {WEIGHTS[k]}, 2) AS {k}_score" for k, f in fr.items())
    return f"""WITH ck AS ({CHECK_SQL['op_checks']}), cm AS ({TEXT_SQL['op_components']}), ex AS (SELECT row_id, {ns} FROM ({EXACT_SQL['op_exact_resolution']}) GROUP BY row_id),
      po AS (SELECT trim(pincode) AS pin, list(DISTINCT {s_entity('officename')}) AS offices FROM pin_directory GROUP BY 1),
      r AS (SELECT row_id, {s_text('city')} AS ci, {s_text('post_office')} AS po, {s_entity('post_office')} AS pe, {s_six(s_text('pincode'))} AS pin FROM cleaned_address_data),
      j AS (SELECT * EXCLUDE (street, locality, building, anchor, premise), premise, building, street, locality, anchor, {kinds}, CASE WHEN pe = '' THEN 'NOT_CHECKED' WHEN list_contains(offices, pe) THEN 'PASS' WHEN offices IS NULL THEN 'NOT_CHECKED' ELSE 'FAIL' END AS office
        FROM r JOIN ck USING (row_id) JOIN cm USING (row_id) LEFT JOIN ex USING (row_id) LEFT JOIN po USING (pin)),
      p AS (SELECT row_id, present, garbage, pin_exists, {pts} FROM j), s AS (SELECT *, round_even({' + '.join(f'{k}_score' for k in WEIGHTS)}, 2) AS raw_score FROM p),
      f AS (SELECT *, CASE WHEN 'FAIL' IN (present, garbage) THEN 0.0 WHEN pin_exists = 'FAIL' THEN least(raw_score, {CAP}) ELSE raw_score END AS score FROM s)
      SELECT row_id, {', '.join(f'{k}_score' for k in WEIGHTS)}, raw_score, CAST(score AS DOUBLE) AS score, 'FAIL' IN (present, garbage, pin_exists) AS hard_invalid, CASE {' '.join(f"WHEN score >= {n} THEN '{c}'" for c, n in CLASSES)} ELSE 'INVALID' END AS class FROM f"""


def op_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by the class as written and the class that their score has."""
    s = table(spark, sf_dir, "quality_outputs").select(t.text(F.col("quality_class")).alias("quality_class"), quality_class(F.col("raw_quality_score")).alias("by_score"))
    return s.groupBy("quality_class", "by_score").agg(F.count("*").alias("n"))


SQL = {
    "op_exact_scores": _exact_sql(),
    "op_class_counts": f"SELECT {s_text('quality_class')} AS quality_class, CASE WHEN isnan(raw_quality_score) THEN 'INVALID' {' '.join(f'WHEN raw_quality_score >= {n} THEN {chr(39)}{c}{chr(39)}' for c, n in CLASSES)} ELSE 'INVALID' END AS by_score, count(*) AS n FROM quality_outputs GROUP BY 1, 2"
}
QUERIES = {"op_scores": op_scores, "op_exact_scores": op_exact_scores, "op_class_counts": op_class_counts}
