"""Schemas that drift between files: a column lifespan catalogue, the changes it logs, and one consistent table.

1. Each payload is parsed once in the JVM (variant); every field of every record becomes a narrow cell: its JSON type and a hash of its
   words (in any order and case, without the keys of objects), so that a text, a list and an object with the same words agree.
2. The catalogue has one row per feed, file and field with the counts of values by type: the footer metadata of the file.
3. Over the files of a feed in order of `file_date`, `lag` finds where a field, or a field of one type, wasn't there in the file before;
   running sums make islands of files, the lifespans. A start after the first file and an end before the last are logged.
4. An end and a start in one file are a renaming if the loans of both files carry the same hashes under both names. The loan field is
   that of lender_configs, or after a renaming the one that holds the feed's loans.
5. The renamings chain into an alias table (feed, file, field to the field's first name) with a cast for each; read through it, all
   records of all files come out under the same names and types.

Values meet by (feed, file, loan), so a feed of any size spreads over the cluster; only renaming candidates of one file, at most its
fields squared, meet in one row. Payloads that are null, malformed or no object hold no field, but their file counts. Repeated lines and
null values change nothing; a field with only null values has no type. Empty tables give no rows; extra columns aren't read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.tables import shared, small, spread, table

#: Share of the common loans that carry the same value under both names of a renamed field, and that share for fields of few
#: different values, which agree by chance.
SAME, SAME_FEW, FEW = 0.7, 0.95, 4
KINDS = ("text", "number", "boolean", "list", "object")


def _kind(value: str) -> Column:
    """The JSON type of a variant, null for null."""
    s = f"schema_of_variant({value})"
    return F.expr(
        f"CASE WHEN {value} IS NULL OR {s} = 'VOID' THEN NULL WHEN {s} = 'STRING' THEN 'text' WHEN {s} = 'BOOLEAN' THEN 'boolean' WHEN {s} LIKE 'ARRAY%' THEN 'list' WHEN {s} LIKE 'OBJECT%' THEN 'object' ELSE 'number' END"
    )


def _plain(value: str) -> str:
    """A variant as text, in SQL: lists and objects as their leaves apart by blanks, whole numbers without .0."""
    t = f"CAST({value} AS STRING)"
    leaves = f"trim(regexp_replace(regexp_replace({t}, '\"(?:[^\"\\\\\\\\]|\\\\\\\\.)*\"\\\\s*:', ' '), '[\\\\[\\\\]{{}}\",\\\\s]+', ' '))"
    s = f"schema_of_variant({value})"
    return f"CASE WHEN {s} LIKE 'ARRAY%' OR {s} LIKE 'OBJECT%' THEN {leaves} WHEN {s} = 'STRING' THEN {t} ELSE regexp_replace({t}, '\\\\.0+$', '') END"


def cells(raw: DataFrame) -> DataFrame:
    """(feed_id, file_id, line_no, field, kind, h): every field of every record; kind and h are null for a null value."""
    parsed = raw.select("feed_id", "file_id", "line_no", F.expr("try_parse_json(payload)").alias("v")).where("schema_of_variant(v) LIKE 'OBJECT%'")
    x = raw.sparkSession.sql("SELECT r.feed_id, r.file_id, r.line_no, e.key AS field, e.value AS value FROM {r} r, LATERAL variant_explode(r.v) e", r=parsed)
    words = F.array_sort(F.regexp_extract_all(F.lower(F.expr(_plain("value"))), F.lit(r"[\p{L}\p{M}\p{N}_]+"), F.lit(0)))
    x = x.withColumn("kind", _kind("value"))
    return x.select("feed_id", "file_id", "line_no", "field", "kind", F.when(F.col("kind").isNotNull(), F.xxhash64(F.array_join(words, " "))).alias("h"))


def files_of(raw: DataFrame) -> DataFrame:
    """(feed_id, file_id, lender, file_no, last_no): the files of each feed, numbered by date."""
    f = raw.groupBy("feed_id", "file_id").agg(F.max("lender").alias("lender"), F.min(F.col("file_date").cast("timestamp")).alias("file_date"))
    order = Window.partitionBy("feed_id").orderBy(F.col("file_date").asc_nulls_last(), "file_id")
    f = f.withColumn("file_no", F.row_number().over(order)).withColumn("last_no", F.count("*").over(Window.partitionBy("feed_id")))
    return f.withColumn("lender", F.max("lender").over(Window.partitionBy("feed_id"))).select("feed_id", "file_id", "lender", "file_no", "last_no")


def catalogue(cell: DataFrame, files: DataFrame) -> DataFrame:
    """(feed_id, file_id, lender, file_no, last_no, field, kind, records, nulls and the count of every type): one row per field of a file."""
    counts = [F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in KINDS]
    c = cell.groupBy("feed_id", "file_id", "field").agg(F.count("*").alias("records"), F.count_if(F.col("kind").isNull()).alias("nulls"), *counts)
    most = F.greatest(*[F.col(f"n_{k}") for k in KINDS])
    kind = F.coalesce(*[F.when((F.col(f"n_{k}") == most) & (most > 0), F.lit(k)) for k in KINDS])
    return c.withColumn("kind", kind).join(files, ["feed_id", "file_id"])


def lifespans(c: DataFrame, by: list[str]) -> DataFrame:
    """(feed_id, *by, first_no, until_no, last_no): the unbroken runs of files in which a field (with its type) is there."""
    of = Window.partitionBy("feed_id", *by).orderBy("file_no")
    begins = F.when(F.lag("file_no").over(of) == F.col("file_no") - 1, 0).otherwise(1)
    runs = c.withColumn("begins", begins).withColumn("run", F.sum("begins").over(of))
    return runs.groupBy("feed_id", *by, "run").agg(F.min("file_no").alias("first_no"), F.max("file_no").alias("until_no"), F.max("last_no").alias("last_no")).drop("run")


def loan_fields(c: DataFrame, cell: DataFrame, configs: DataFrame) -> DataFrame:
    """(feed_id, file_id, field): the field of each file that names the loan."""
    named = configs.select("lender", F.posexplode("lan_cols").alias("place", "field")).where("lender IS NOT NULL")
    by_name = c.join(F.broadcast(named), ["lender", "field"]).groupBy("feed_id", "file_id").agg(F.min_by("field", "place").alias("field"))  # the agreed layouts: a few rows for each lender
    lacking = c.select("feed_id", "file_id").distinct().join(by_name.select("file_id"), "file_id", "left_anti")
    loans = cell.join(small(by_name), ["feed_id", "file_id", "field"]).where("h IS NOT NULL").select("feed_id", "h").distinct()
    held = cell.join(small(lacking), ["feed_id", "file_id"]).join(loans, ["feed_id", "h"], "left_semi").groupBy("feed_id", "file_id", "field").agg(F.count("*").alias("n"))
    by_value = held.groupBy("feed_id", "file_id").agg(F.min_by("field", F.struct(-F.col("n"), "field")).alias("field"))
    return by_name.unionAll(by_value)


def renamings(cell: DataFrame, loan: DataFrame, gone: DataFrame, new: DataFrame, files: DataFrame) -> DataFrame:
    """(feed_id, file_no, field, prev_field): the pairs of ended (feed_id, file_no, field) and begun fields with the same data of the
    same loans, the surest first and each field once."""
    both = gone.select("feed_id", "file_no").intersect(new.select("feed_id", "file_no"))
    number = files.select("feed_id", "file_id", "file_no")
    before = gone.join(both, ["feed_id", "file_no"]).select("feed_id", (F.col("file_no") - 1).alias("at"), "file_no", "field", F.lit(True).alias("old"))
    after = new.join(both, ["feed_id", "file_no"]).select("feed_id", F.col("file_no").alias("at"), "file_no", "field", F.lit(False).alias("old"))
    wanted = before.unionAll(after).join(number.withColumnRenamed("file_no", "at"), ["feed_id", "at"]).select("feed_id", "file_id", "file_no", "field", "old")
    lines = cell.join(small(loan), ["feed_id", "file_id", "field"]).where("h IS NOT NULL").select("feed_id", "file_id", "line_no", F.col("h").alias("loan"))
    values = cell.where("h IS NOT NULL").join(small(wanted), ["feed_id", "file_id", "field"]).join(lines, ["feed_id", "file_id", "line_no"])
    values = shared(values.select("feed_id", "file_no", "old", "field", "loan", "h").distinct(), "p7-values")
    p = values.where("old").select("feed_id", "file_no", "loan", F.col("field").alias("g"), "h")
    q = values.where("NOT old").select("feed_id", "file_no", "loan", F.col("field").alias("a"), "h")
    met = p.join(q.select("feed_id", "file_no", "loan", "a").distinct(), ["feed_id", "file_no", "loan"]).groupBy("feed_id", "file_no", "g", "a")
    met = met.agg(F.count_distinct("loan").alias("both"), F.count_distinct("h").alias("different"))
    same = p.join(q, ["feed_id", "file_no", "loan", "h"]).groupBy("feed_id", "file_no", "g", "a").agg(F.count_distinct("loan").alias("same"))
    few = F.col("different") <= F.least(F.lit(FEW), F.floor(F.col("both") / 2))
    sure = met.join(same, ["feed_id", "file_no", "g", "a"]).where(F.col("same") >= F.when(few, SAME_FEW).otherwise(SAME) * F.col("both"))
    ranked = sure.groupBy("feed_id", "file_no").agg(F.array_sort(F.collect_list(F.struct((-F.col("same") / F.col("both")).alias("r"), (-F.col("same")).alias("s"), "g", "a"))).alias("c"))
    taken = F.expr(
        "aggregate(c, cast(array() as array<struct<g:string,a:string>>), (t, x) -> if(exists(t, y -> y.g = x.g OR y.a = x.a), t, array_append(t, named_struct('g', x.g, 'a', x.a))))"
    )
    return ranked.select("feed_id", "file_no", F.explode(taken).alias("x")).select("feed_id", "file_no", F.col("x.a").alias("field"), F.col("x.g").alias("prev_field"))


class Drift:
    """The catalogue, lifespans, renamings and changes of all feeds in one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.raw = spread(table(spark, sf_dir, "raw_lender_records").select("feed_id", "file_id", "lender", "file_date", "line_no", "payload"))
        self.configs = table(spark, sf_dir, "lender_configs").select("lender", "lan_cols", "current_cols")
        self.files = shared(files_of(self.raw), "p7-files")
        self.cells = shared(cells(self.raw), "p7-cells")
        self.catalogue = shared(catalogue(self.cells, self.files), "p7-catalogue")

    def changes(self) -> DataFrame:
        """(feed_id, file_no, change_kind, field_name, prev_name)."""
        there = lifespans(self.catalogue, ["field"])
        new = there.where("first_no > 1").select("feed_id", F.col("first_no").alias("file_no"), "field")
        gone = there.where("until_no < last_no").select("feed_id", (F.col("until_no") + 1).alias("file_no"), "field")
        self.renamed = shared(renamings(self.cells, loan_fields(self.catalogue, self.cells, self.configs), gone, new, self.files), "p7-renamed")
        r = self.renamed
        key = ["feed_id", "file_no", "field"]
        added = new.join(r, key, "left_anti").select("feed_id", "file_no", F.lit("added"), "field", F.lit(""))
        removed = gone.join(r.select("feed_id", "file_no", F.col("prev_field").alias("field")), key, "left_anti").select("feed_id", "file_no", F.lit("removed"), "field", F.lit(""))
        as_renamed = r.select("feed_id", "file_no", F.lit("renamed"), "field", "prev_field")
        typed = self.catalogue.where("kind IS NOT NULL")
        spans = lifespans(typed, ["field", "kind"])
        ends = spans.select("feed_id", (F.col("until_no") + 1).alias("file_no"), "field", F.col("kind").alias("old_kind"))
        starts = spans.where("first_no > 1").select("feed_id", F.col("first_no").alias("file_no"), "field", "kind")
        same_name = starts.join(ends, key).where("kind <> old_kind").select("feed_id", "file_no", "field")
        kinds = typed.select("feed_id", "file_no", "field", "kind")
        before = kinds.select("feed_id", (F.col("file_no") + 1).alias("file_no"), F.col("field").alias("prev_field"), F.col("kind").alias("old_kind"))
        new_name = r.join(kinds, key).join(before, ["feed_id", "file_no", "prev_field"]).where("kind <> old_kind").select("feed_id", "file_no", "field")
        retyped = same_name.unionAll(new_name).distinct().select("feed_id", "file_no", F.lit("retyped"), "field", F.lit(""))
        return added.unionAll(removed).unionAll(as_renamed).unionAll(retyped).toDF("feed_id", "file_no", "change_kind", "field_name", "prev_name")

    def aliases(self) -> DataFrame:
        """(feed_id, file_id, lender, field, name, kind, cast): the first name of every field of every file, and the type it is cast to:
        number or boolean if all of the name's values in all feeds of the lender are, else text."""
        names = self.catalogue.select("feed_id", "file_id", "lender", "file_no", "field", "kind").join(self.renamed, ["feed_id", "file_no", "field"], "left")

        def chain(feed: pd.DataFrame) -> pd.DataFrame:
            """Names of one feed's catalogue rows (files by fields, no data)."""
            last: dict[str, str] = {}
            out = []
            for _, f in feed.sort_values(["file_no", "field"]).groupby("file_no", sort=True):
                now: dict[str, str] = {}
                for field, prev in zip(f["field"], f["prev_field"]):
                    source = prev if isinstance(prev, str) else field
                    name = last.get(source, source)
                    now[field] = name if name not in now.values() else field + "'"
                last = {**last, **now}
                out += [now[x] for x in f["field"]]
            feed = feed.sort_values(["file_no", "field"])
            return pd.DataFrame({"feed_id": feed["feed_id"], "file_id": feed["file_id"], "lender": feed["lender"], "field": feed["field"], "kind": feed["kind"], "name": out})

        named = names.groupBy("feed_id").applyInPandas(chain, "feed_id bigint, file_id bigint, lender string, field string, kind string, name string")
        of = Window.partitionBy("lender", "name")
        one = F.when(F.min("kind").over(of) == F.max("kind").over(of), F.min("kind").over(of))
        cast = F.when(one == "number", "double").when(one == "boolean", "boolean").otherwise("string")
        return named.select("feed_id", "file_id", "lender", "field", "name", "kind", cast.alias("cast"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Added, removed, renamed and retyped fields of each file against the file before it in its feed."""
    d = Drift(spark, sf_dir)
    return d.changes().join(d.files, ["feed_id", "file_no"]).select("file_id", "change_kind", "field_name", "prev_name")


def p7_lifespans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unbroken runs of files of every feed, field and type, by number of the file in its feed."""
    return lifespans(Drift(spark, sf_dir).catalogue.where("kind IS NOT NULL"), ["field", "kind"]).withColumnRenamed("until_no", "last_file_no").withColumnRenamed("first_no", "first_file_no").drop("last_no")


def p7_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alias table with its casts."""
    d = Drift(spark, sf_dir)
    d.changes()
    return d.aliases()


def p7_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records of all files in one consistent table: loan, current address, and a JSON object of every field under its
    first name, as text whatever its type in the file; p7_casts has the type to read it as.

    Lists and objects become their leaves apart by blanks. Null and absent fields are absent; a malformed payload gives null fields."""
    d = Drift(spark, sf_dir)
    d.changes()
    a = d.aliases()
    by_file = a.groupBy("file_id").agg(F.max("lender").alias("of_lender"), F.map_from_entries(F.collect_list(F.struct("field", F.struct("name", "cast")))).alias("alias"))
    configs = d.configs.select(F.col("lender").alias("of_lender"), "lan_cols", "current_cols")
    by_file = by_file.join(F.broadcast(configs), "of_lender", "left")  # the agreed layouts: one row for each lender
    rows = d.raw.select("feed_id", "file_id", "line_no", "lender", F.expr("try_parse_json(payload)").alias("v")).join(small(shared(by_file, "p7-alias")), "file_id", "left")
    rows = rows.withColumn("m", F.expr("CASE WHEN schema_of_variant(v) LIKE 'OBJECT%' THEN map_filter(CAST(v AS MAP<STRING, VARIANT>), (k, x) -> x IS NOT NULL AND schema_of_variant(x) <> 'VOID') END"))
    name = "coalesce(try_element_at(alias, e.key).name, e.key)"
    entries = f"transform(map_entries(m), e -> named_struct('key', {name}, 'value', {_plain('e.value')}))"
    rows = rows.withColumn("fields", F.expr(f"map_from_entries({entries})"))
    pick = "nullif(array_join(filter(transform({0}, c -> try_element_at(fields, c)), x -> x IS NOT NULL AND trim(x) <> ''), ', '), '')"
    return rows.select("feed_id", "file_id", "line_no", F.coalesce("of_lender", "lender").alias("lender"), F.expr(pick.format("lan_cols")).alias("lan"), F.expr(pick.format("current_cols")).alias("current_address"), F.to_json("fields").alias("fields"))


QUERIES = {"p7_found": p7_found, "p7_lifespans": p7_lifespans, "p7_casts": p7_casts, "p7_records": p7_records}
SQL: dict[str, str] = {}
