"""Reference tables of this project's data in the shape of the five masters, and the look-up tables over them as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.text import clean_text, entity, for_resolving, last_pin, loose_pin, resolver_state
from ..plans.tables import shared_dir, table
from ..sources.files import load_table, standardised, write_csv
from .textqueries import q, s_clean, s_mapped, s_resolving


def masters(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """india_post from pin_directory; district and ulb from geo_directory; the towns of a district as its subdistricts and their offices
    as villages, since the data have no tables of these."""
    pins = table(spark, sf_dir, "pin_directory")
    geo = table(spark, sf_dir, "geo_directory")
    of = {k: geo.where(F.col("entity_type") == k).select(F.col("geo_code").cast("string").alias("code"), F.col("geo_name").alias("name"), F.col("statename").alias("state_name")) for k in ("DISTRICT", "ULB")}
    towns = pins.select(F.col("district").alias("district_name"), F.col("city").alias("subdistrict_name"), F.col("statename").alias("state_name")).distinct().withColumn("district_code", F.lit("")).withColumn("subdistrict_code", F.lit(""))
    office = F.regexp_replace("officename", r" [BSH]\.O$", "")
    villages = pins.select(F.col("district").alias("district_name"), F.col("city").alias("subdistrict_name"), F.col("statename").alias("state_name"), office.alias("village_name")).distinct()
    for c in ("district_code", "subdistrict_code", "village_code"):
        villages = villages.withColumn(c, F.lit(""))
    return {
        "india_post": standardised(pins, "india_post"),
        "district": standardised(of["DISTRICT"].toDF("district_code", "district_name", "state_name"), "district"),
        "ulb": standardised(of["ULB"].toDF("local_body_code", "local_body_name", "state_name"), "ulb"),
        "subdistrict": standardised(towns, "subdistrict"),
        "village": standardised(villages, "village"),
    }


def _set(c: Column) -> Column:
    """The different values that are not empty, sorted; an aggregate."""
    return F.array_sort(F.collect_set(F.when(c != "", c)))


def pin_context(india_post: DataFrame) -> DataFrame:
    """(pin, n, states, districts, offices, canonical and entity forms, state): one row for each PIN of the postal table.

    A PIN has few offices, so the sets are small. state is the only canonical state, '' if there are several."""
    g = india_post.where("pincode_clean <> ''").groupBy(F.col("pincode_clean").alias("pin")).agg(
        F.count("*").alias("n"), _set(F.col("statename_clean")).alias("states"), _set(F.col("district_clean")).alias("districts"), _set(F.col("officename_clean")).alias("offices"),
        _set(resolver_state(F.col("statename"))).alias("canonical_states"), _set(entity(F.col("district"))).alias("district_entities"), _set(entity(F.col("officename"))).alias("office_entities"),
    )
    return g.withColumn("state", F.when(F.size("canonical_states") == 1, F.get("canonical_states", F.lit(0))).otherwise(""))


def name_counts(master: DataFrame, name: str) -> DataFrame:
    """(name, n): how many rows of a master have each clean name; duplicates count."""
    return master.where(F.col(name) != "").groupBy(F.col(name).alias("name")).agg(F.count("*").alias("n"))


def token_index(master: DataFrame, name: str, least: int = 2, shortest: int = 1) -> DataFrame:
    """(token, name): every word of at least `least` letters of the names of at least `shortest`."""
    names = master.select(F.col(name).alias("name")).where(F.length("name") >= shortest).distinct()
    return names.select(F.explode(F.array_distinct(F.split("name", " "))).alias("token"), "name").where(F.length("token") >= least)


def _list(c: str) -> Column:
    return F.array_join(F.col(c), "|")


def op_pin_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIN to rows, states, districts, offices and its only state."""
    x = pin_context(masters(spark, sf_dir)["india_post"])
    return x.select("pin", "n", *[_list(c).alias(c) for c in ("states", "districts", "offices")], "state")


def op_name_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by clean name in the four name tables."""
    m = masters(spark, sf_dir)
    parts = [name_counts(m[k], f"{k}_name_clean").select(F.lit(k).alias("kind"), "name", "n") for k in ("district", "subdistrict", "village", "ulb")]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


def op_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names by word: words of two letters of all four tables, and the cleaner's own of three letters for towns."""
    m = masters(spark, sf_dir)
    parts = [token_index(m[k], f"{k}_name_clean").select(F.lit(k).alias("kind"), "token", "name") for k in ("district", "subdistrict", "village", "ulb")]
    parts.append(token_index(m["ulb"], "ulb_name_clean", 3, 3).select(F.lit("cleaner").alias("kind"), "token", "name"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out.groupBy("kind", "token").agg(F.count("*").alias("names"), F.min("name").alias("first_name"), F.max("name").alias("last_name"))


def op_hierarchy_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subdistricts by district, and villages by district, subdistrict and both."""
    m = masters(spark, sf_dir)
    s, v = m["subdistrict"], m["village"]
    n = [F.count("*").alias("n"), F.count_distinct("name").alias("names")]
    sub = s.select(F.col("district_name_clean").alias("key"), F.col("subdistrict_name_clean").alias("name")).groupBy("key").agg(*n).select(F.lit("subdistrict by district").alias("kind"), "key", "n", "names")
    keys = {"village by district": F.col("district_name_clean"), "village by subdistrict": F.col("subdistrict_name_clean"), "village by both": F.concat_ws("|", "district_name_clean", "subdistrict_name_clean")}
    for kind, key in keys.items():
        sub = sub.unionAll(v.select(key.alias("key"), F.col("village_name_clean").alias("name")).groupBy("key").agg(*n).select(F.lit(kind).alias("kind"), "key", "n", "names"))
    return sub


def op_offices_by_pin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaner's offices of each PIN, without repeats, and how many PINs each office has."""
    pins = table(spark, sf_dir, "pin_directory").select(last_pin(F.col("pincode")).alias("pin"), clean_text(F.col("officename")).alias("office")).where("pin <> '' AND office <> ''")
    a = pins.groupBy("pin").agg(F.array_join(F.array_sort(F.collect_set("office")), "|").alias("offices")).select(F.lit("pin").alias("kind"), F.col("pin").alias("key"), F.col("offices").alias("found"))
    b = table(spark, sf_dir, "pin_directory").select(for_resolving(F.col("officename")).alias("office"), loose_pin(F.col("pincode")).alias("pin")).where("pin <> '' AND office <> ''")
    return a.unionAll(b.groupBy("office").agg(F.array_join(F.array_sort(F.collect_set("pin")), "|").alias("pins")).select(F.lit("office"), "office", "pins"))


def op_csv_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The postal table written as CSV, read again by suffix and standardised: sink, scan, alias finder and clean forms in one."""
    path = f"{shared_dir(spark)}/addrloom-india_post.csv"
    pins = table(spark, sf_dir, "pin_directory").select(F.col("pincode").alias("PIN Code"), F.col("statename").alias("State Name"), F.col("district").alias("District"), F.col("officename").alias("Office Name"))
    write_csv(pins, path)
    return standardised(load_table(spark, path), "india_post").select("pincode", "statename", "district", "officename", "pincode_clean", "statename_clean", "district_clean", "officename_clean")


def _sql() -> dict[str, str]:
    pins = f"SELECT pincode, statename, district, city, officename, regexp_replace(officename, ' [BSH]\\.O$', '') AS village FROM pin_directory"
    join = "array_to_string(list_sort(list_distinct(list({0}) FILTER ({0} <> ''))), '|')"
    post = f"SELECT trim(pincode) AS pin, {s_resolving('statename')} AS st, {s_resolving('district')} AS di, {s_resolving('officename')} AS po, {s_mapped(s_resolving('statename'), t.FORMER_NAMES | t.VALIDATOR_STATES)} AS cs FROM pin_directory"
    named = f"SELECT 'district' AS kind, {s_resolving('geo_name')} AS name FROM geo_directory WHERE entity_type = 'DISTRICT' UNION ALL SELECT 'ulb', {s_resolving('geo_name')} FROM geo_directory WHERE entity_type = 'ULB' UNION ALL SELECT 'subdistrict', {s_resolving('city')} FROM (SELECT DISTINCT district, city, statename FROM pin_directory) UNION ALL SELECT 'village', {s_resolving('village')} FROM (SELECT DISTINCT district, city, statename, village FROM ({pins}))"
    tok = f"WITH n AS ({named}), d AS (SELECT DISTINCT kind, name FROM n), a AS (SELECT * FROM d UNION ALL SELECT 'cleaner', name FROM d WHERE kind = 'ulb' AND length(name) >= 3), e AS (SELECT DISTINCT kind, name, unnest(string_split(name, ' ')) AS token FROM a)"
    s = f"SELECT DISTINCT {s_resolving('district')} AS d, {s_resolving('city')} AS c, statename FROM (SELECT DISTINCT district, city, statename FROM pin_directory)"
    v = f"SELECT {s_resolving('district')} AS d, {s_resolving('city')} AS c, {s_resolving('village')} AS v FROM (SELECT DISTINCT district, city, statename, village FROM ({pins}))"
    by = "SELECT '{0}' AS kind, {1} AS key, count(*) AS n, count(DISTINCT v) AS names FROM v GROUP BY 2"
    return {
        "op_pin_context": f"SELECT pin, count(*) AS n, {join.format('st')} AS states, {join.format('di')} AS districts, {join.format('po')} AS offices, CASE WHEN count(DISTINCT cs) = 1 THEN min(cs) ELSE '' END AS state FROM ({post}) GROUP BY pin",
        "op_name_index": f"SELECT kind, name, count(*) AS n FROM ({named}) WHERE name <> '' GROUP BY kind, name",
        "op_token_index": f"{tok} SELECT kind, token, count(*) AS names, min(name) AS first_name, max(name) AS last_name FROM e WHERE length(token) >= CASE kind WHEN 'cleaner' THEN 3 ELSE 2 END GROUP BY kind, token",
        "op_hierarchy_index": f"WITH s AS ({s}), v AS ({v}) SELECT 'subdistrict by district' AS kind, d AS key, count(*) AS n, count(DISTINCT c) AS names FROM s GROUP BY d UNION ALL {by.format('village by district', 'd')} UNION ALL {by.format('village by subdistrict', 'c')} UNION ALL {by.format('village by both', chr(100) + ' || ' + q('|') + ' || c')}",
        "op_offices_by_pin": f"SELECT 'pin' AS kind, trim(pincode) AS key, {join.format('o')} AS found FROM (SELECT pincode, {s_clean('officename')} AS o FROM pin_directory) GROUP BY 2 UNION ALL SELECT 'office', o, {join.format('p')} FROM (SELECT {s_resolving('officename')} AS o, trim(pincode) AS p FROM pin_directory) GROUP BY 2",
        "op_csv_master": f"SELECT pincode, statename, district, officename, pincode AS pincode_clean, {s_resolving('statename')} AS statename_clean, {s_resolving('district')} AS district_clean, {s_resolving('officename')} AS officename_clean FROM pin_directory",
    }


QUERIES = {f.__name__: f for f in (op_pin_context, op_name_index, op_token_index, op_hierarchy_index, op_offices_by_pin, op_csv_master)}
SQL = _sql()
