"""Column-level quality profile: expressions induced by minimum description length, and loads whose columns stand out.

1. Every column becomes counts of its distinct values by load: one shuffle of partly aggregated counts, whatever the number of rows.
2. A value has an exact shape (each digit 9, capital A, small letter a, white space a blank; other characters themselves) and a general one
   (runs of a class as one with +). Bottom up, the shorter description in bits is taken: an exact shape with the letters of its
   values, or these values listed one by one; a general shape with the lengths and letters of its values, or what its exact shapes
   chose. The sums are plain aggregations over all distinct values. A value listed by itself conforms only if it holds `KEYWORD`
   of the column's cells; the others are the nonconforming ones.
3. Loads are compared by coverage: the share of each expression in a load against the share in all other loads of the table pooled, beside
   the shares of missing and invalid cells. For the findings the expressions are first put into the declared buckets: an expression that
   describes valid and invalid values, or values of several buckets, by its values, any other as a whole.

Null, NaN and placeholder words are missing; they have no expression. An empty table has no rows in any of the reports; a load without
valid cells (or alone in its table) has no drift. Null loads count in the pool and are not named.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.names import MISSING
from ..plans.tables import shared, spread, table

#: The classes of quality_class.
CLASSES = ("EXCELLENT", "GOOD", "USABLE", "REQUIRES_CALL", "INVALID")
#: Exact and general shapes of the classes, all of capitals and other characters.
CLASS_SHAPES = sorted({re.sub("[A-Z]", "A", c) for c in CLASSES})
CLASS_FORMS = sorted({re.sub("[A-Z]+", "A+", c) for c in CLASSES})
HIGHER = 0.10
DRIFT = 0.25
#: Share of a column's cells from which a value listed by itself is a keyword of the column.
KEYWORD = 0.01
#: Bits of a character in a pattern or a listed value, of a run's length, of a digit and of a letter.
CHARACTER, LENGTH, DIGIT, LETTER = 7.0, 4.0, 3.33, 4.71
_ROUNDING = 1e-12


def typed(c: Column) -> Column:
    """A value in capitals without white space around it; null if it is missing."""
    t = F.upper(F.regexp_replace(c, r"^\s+|\s+$", ""))
    return F.when(~t.isin(*MISSING), t)


def cells(df: DataFrame, load: str, columns: list[str]) -> DataFrame:
    """(load_no, column_name, value, n): how often each value of `columns` occurs in each load; values as text, null where missing."""
    pairs = []
    for c in columns:
        text = F.col(c).cast("string")
        gone = typed(text).isNull() | (F.isnan(c) if df.schema[c].dataType.simpleString() in ("double", "float") else F.lit(False))
        pairs.append(F.struct(F.lit(c).alias("column_name"), F.when(~gone, text).alias("value")))
    long = df.select(F.col(load).cast("long").alias("load_no"), F.explode(F.array(*pairs)).alias("x"))
    return long.groupBy("load_no", F.col("x.column_name").alias("column_name"), F.col("x.value").alias("value")).agg(F.count("*").alias("n"))


def shape(c: Column) -> Column:
    """Exact shape of a value."""
    for pattern, mark in (("[a-z]", "a"), ("[A-Z]", "A"), ("[0-9]", "9"), (r"\s", " ")):
        c = F.regexp_replace(c, pattern, mark)
    return c


def expressions(counted: DataFrame) -> DataFrame:
    """(column_name, value, expression, listed, whole, n) of every distinct value of `counted` (column_name, value, n): the expression is
    the value itself behind = if `listed`, a general shape if `whole`, else an exact shape."""
    v = counted.where("value IS NOT NULL").groupBy("column_name", "value").agg(F.sum("n").alias("n"))
    v = v.withColumn("exact", shape(F.col("value"))).withColumn("general", F.regexp_replace("exact", r"([9Aa ])\1*", "$1+"))
    runs = F.length(F.regexp_replace("general", r"[^+]", ""))
    letters = DIGIT * F.length(F.regexp_replace("exact", "[^9]", "")) + LETTER * F.length(F.regexp_replace("exact", "[^Aa]", ""))
    v = v.withColumn("runs", runs).withColumn("letters", letters).withColumn("alone", CHARACTER * F.length("value"))
    pattern = CHARACTER * F.length("general")
    by_exact = v.groupBy("column_name", "general", "exact").agg(F.sum("letters").alias("letters"), F.sum("alone").alias("alone"), F.count("*").alias("values"), F.max("runs").alias("runs"))
    as_exact = pattern + LENGTH * F.col("runs") + F.col("letters")
    by_exact = by_exact.withColumn("listed", F.col("alone") <= as_exact).withColumn("bits", F.least("alone", as_exact))
    by_general = by_exact.groupBy("column_name", "general").agg(F.sum("bits").alias("split"), F.sum(F.col("letters") + LENGTH * F.col("runs") * F.col("values")).alias("letters"))
    by_general = by_general.select("column_name", "general", (pattern + F.col("letters") < F.col("split")).alias("whole"))
    chosen = by_exact.join(by_general, ["column_name", "general"]).select("column_name", "exact", "whole", "listed")
    out = v.join(chosen, ["column_name", "exact"])
    expression = F.when(F.col("whole"), F.col("general")).when(F.col("listed"), F.concat(F.lit("="), "value")).otherwise(F.col("exact"))
    return out.select("column_name", "value", expression.alias("expression"), (~F.col("whole") & F.col("listed")).alias("listed"), "whole", "n")


def _counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the values of the three profiled columns."""
    a = spread(table(spark, sf_dir, "cleaned_address_data").select("load_no", "pincode"))
    q = spread(table(spark, sf_dir, "quality_outputs").select("load_no", "quality_class", "raw_quality_score"))
    both = cells(a, "load_no", ["pincode"]).unionAll(cells(q, "load_no", ["quality_class", "raw_quality_score"]))
    return shared(both, "p5-cells")


def _expressed(counted: DataFrame) -> DataFrame:
    """`counted` with the expression of each value and whether it conforms."""
    found = expressions(counted)
    whole = Window.partitionBy("column_name", "expression")
    total = counted.groupBy("column_name").agg(F.sum("n").alias("total"))
    rows = F.sum("n").over(whole)
    found = found.withColumn("rows", rows).join(F.broadcast(total), "column_name")
    conforms = ~F.col("listed") | (F.col("rows") >= KEYWORD * F.col("total"))
    found = found.select("column_name", "value", "expression", conforms.alias("conforms"))
    return counted.join(found, ["column_name", "value"], "left")


def p5_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The induced expressions of each column: distinct values, cells, and whether they conform."""
    x = _expressed(_counted(spark, sf_dir)).where("value IS NOT NULL")
    return x.groupBy("column_name", "expression").agg(F.max("conforms").alias("conforms"), F.count_distinct("value").alias("values"), F.sum("n").alias("n"))


def compared(counts: DataFrame) -> DataFrame:
    """(column_name, load_no, bucket, n, load_n, other_n, other_total): each load's count of a bucket beside that of all other loads pooled.

    `counts` is (column_name, load_no, bucket, n). Buckets that a load lacks come with n = 0."""
    by_bucket = counts.groupBy("column_name", "bucket").agg(F.sum("n").alias("all_n"))
    by_load = counts.groupBy("column_name", "load_no").agg(F.sum("n").alias("load_n"))
    total = by_load.groupBy("column_name").agg(F.sum("load_n").alias("total"))
    grid = by_load.join(by_bucket, "column_name").join(total, "column_name")  # loads x buckets of a column, not rows
    own = counts.groupBy("column_name", "load_no", "bucket").agg(F.sum("n").alias("n"))
    same = (grid["column_name"] == own["column_name"]) & grid["load_no"].eqNullSafe(own["load_no"]) & (grid["bucket"] == own["bucket"])
    x = grid.join(own, same, "left").select(grid["column_name"], grid["load_no"], grid["bucket"], F.coalesce(own["n"], F.lit(0)).alias("n"), "load_n", "all_n", "total")
    return x.select("column_name", "load_no", "bucket", "n", "load_n", (F.col("all_n") - F.col("n")).alias("other_n"), (F.col("total") - F.col("load_n")).alias("other_total"))


def p5_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of every expression's cells in each load and in all others pooled; nonconforming values under one name."""
    x = _expressed(_counted(spark, sf_dir)).where("value IS NOT NULL")
    bucket = F.when(F.col("conforms"), F.col("expression")).otherwise("nonconforming")
    x = compared(x.groupBy("column_name", "load_no", bucket.alias("bucket")).agg(F.sum("n").alias("n"))).where("load_no IS NOT NULL")
    return x.select("load_no", "column_name", F.col("bucket").alias("expression"), "n", F.try_divide("n", "load_n").alias("share"), F.try_divide("other_n", "other_total").alias("other_share"))


def p5_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard aggregates of every load and column: cells, missing, distinct values, least and greatest value (of scores by number), and
    nonconforming cells."""
    x = _expressed(_counted(spark, sf_dir))
    n, there, number = F.col("n"), F.col("value").isNotNull(), F.col("column_name") == "raw_quality_score"
    score = F.when(number, F.expr("try_cast(value AS double)"))
    out = x.groupBy("load_no", "column_name").agg(
        F.sum(n).alias("cells"), F.sum(F.when(there, 0).otherwise(n)).alias("missing"), F.count("value").alias("distinct_values"),
        F.sum(F.when(there & ~F.coalesce("conforms", F.lit(False)), n).otherwise(0)).alias("nonconforming"),
        F.coalesce(F.min(score).cast("string"), F.min(F.when(~number, F.col("value")))).alias("least"),
        F.coalesce(F.max(score).cast("string"), F.max(F.when(~number, F.col("value")))).alias("greatest"),
    )
    return out.where("load_no IS NOT NULL")


def declared(column: Column, value: Column) -> Column:
    """The bucket of a value by the declared expression of its column; null if it is invalid."""
    score = F.when(column == "raw_quality_score", F.expr("try_cast(value AS double)"))
    by_score = F.when((score >= 0) & (score <= 100), F.when(score < 40, "=0").when(score < 60, "=40").when(score < 75, "=60").when(score < 90, "=75").otherwise("=90"))
    by_pin = F.when(value.rlike(r"\A[1-9][0-9]{5}\z"), F.concat(F.lit("="), F.substring(value, 1, 1)))
    by_class = F.when(value.isin(*CLASSES), F.concat(F.lit("="), value))
    return F.when(column == "pincode", by_pin).when(column == "quality_class", by_class).otherwise(by_score)


def bucketed(found: DataFrame) -> DataFrame:
    """(column_name, value, bucket) of `expressions`: the declared bucket of each value, or invalid, told by its expression.

    A listed expression is a value. A shape tells the length and the characters: it is invalid as a whole if no valid value has it, an exact
    shape of six digits is a pincode unless the first is 0, and one of a single digit before the point is a score below 40. The values
    themselves are looked at only under the shapes that leave it open: those of the classes, other numbers, and digits of any length."""
    column, value, shown, whole = F.col("column_name"), F.col("value"), F.col("expression"), F.col("whole")
    first, open_ = F.substring("value", 1, 1), declared(column, value)
    by_pin = F.when(whole, F.when(shown == "9+", open_)).when(shown == "999999", F.when(first != "0", F.concat(F.lit("="), first)))
    by_class = F.when(F.when(whole, shown.isin(CLASS_FORMS)).otherwise(shown.isin(CLASS_SHAPES)), open_)
    by_score = F.when(~whole & shown.rlike(r"\A9\.9+\z"), "=0").when(F.contains(shown, F.lit("9")), open_)
    by_shape = F.when(column == "pincode", by_pin).when(column == "quality_class", by_class).otherwise(by_score)
    bucket = F.when(F.col("listed"), declared(column, F.expr("substring(expression, 2)"))).otherwise(by_shape)
    return found.select("column_name", "value", F.coalesce(bucket, F.lit("invalid")).alias("bucket"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads that stand out, with the column and the finding: coverage of the buckets, made up of induced expressions, between each load
    and the rest."""
    counted = _counted(spark, sf_dir)
    x = counted.join(bucketed(expressions(counted)), ["column_name", "value"], "left")
    kind = F.when(F.col("value").isNull(), "missing").otherwise(F.col("bucket"))
    x = compared(x.groupBy("column_name", "load_no", kind.alias("bucket")).agg(F.sum("n").alias("n")))
    by = ["column_name", "load_no"]
    own = {b: F.sum(F.when(F.col("bucket") == b, F.col("n")).otherwise(0)).alias(b) for b in ("missing", "invalid")}
    rest = {b: F.sum(F.when(F.col("bucket") == b, F.col("other_n")).otherwise(0)).alias(f"other_{b}") for b in ("missing", "invalid")}
    load = x.groupBy(*by, "load_n", "other_total").agg(*own.values(), *rest.values())
    valid = (F.col("load_n") - F.col("missing") - F.col("invalid")).alias("valid")
    other = (F.col("other_total") - F.col("other_missing") - F.col("other_invalid")).alias("other_valid")
    load = load.select("*", valid, other).where("load_no IS NOT NULL")
    good = x.where("bucket LIKE '=%'").join(load.select(*by, "valid", "other_valid"), by)
    drift = good.where("valid > 0 AND other_valid > 0").groupBy(*by).agg((F.sum(F.abs(F.col("n") / F.col("valid") - F.col("other_n") / F.col("other_valid"))) / 2).alias("drift"))
    x = load.join(drift, by, "left")
    share = F.try_divide
    finding = F.array_compact(F.array(
        F.when(share("missing", "load_n") - share("other_missing", "other_total") >= HIGHER - _ROUNDING, "missing"),
        F.when(share("invalid", F.col("load_n") - F.col("missing")) - share("other_invalid", F.col("other_total") - F.col("other_missing")) >= HIGHER - _ROUNDING, "invalid"),
        F.when(F.col("drift") >= DRIFT - _ROUNDING, "drift"),
    ))
    return x.select("load_no", "column_name", F.explode(finding).alias("finding"))


#: The findings by plain counting, in SQL.
FOUND_SQL = """
WITH c AS (
  SELECT CAST(load_no AS BIGINT) load_no, 'pincode' column_name,
    CASE WHEN pincode IS NULL OR upper(trim(pincode)) IN ('','NA','N/A','NAN','NULL','NONE','NIL','-','--','0','NOT AVAILABLE','UNKNOWN') THEN 'missing'
         WHEN regexp_full_match(pincode, '[1-9][0-9]{5}') THEN '=' || pincode[1] ELSE 'invalid' END b FROM cleaned_address_data
  UNION ALL SELECT CAST(load_no AS BIGINT), 'quality_class',
    CASE WHEN quality_class IS NULL OR upper(trim(quality_class)) IN ('','NA','N/A','NAN','NULL','NONE','NIL','-','--','0','NOT AVAILABLE','UNKNOWN') THEN 'missing'
         WHEN quality_class IN ('EXCELLENT','GOOD','USABLE','REQUIRES_CALL','INVALID') THEN '=' || quality_class ELSE 'invalid' END FROM quality_outputs
  UNION ALL SELECT CAST(load_no AS BIGINT), 'raw_quality_score',
    CASE WHEN raw_quality_score IS NULL OR isnan(raw_quality_score) THEN 'missing' WHEN raw_quality_score NOT BETWEEN 0 AND 100 THEN 'invalid'
         WHEN raw_quality_score < 40 THEN '=0' WHEN raw_quality_score < 60 THEN '=40' WHEN raw_quality_score < 75 THEN '=60' WHEN raw_quality_score < 90 THEN '=75' ELSE '=90' END FROM quality_outputs),
l AS (SELECT DISTINCT column_name, load_no FROM c WHERE load_no IS NOT NULL),
s AS (
  SELECT l.column_name, l.load_no, b.b,
    (SELECT count(*) FROM c WHERE c.column_name = l.column_name AND c.load_no = l.load_no AND c.b = b.b) n,
    (SELECT count(*) FROM c WHERE c.column_name = l.column_name AND c.load_no IS DISTINCT FROM l.load_no AND c.b = b.b) o
  FROM l JOIN (SELECT DISTINCT column_name, b FROM c) b ON b.column_name = l.column_name),
t AS (
  SELECT column_name, load_no, sum(n) cells, sum(o) ocells, sum(n) FILTER (b = 'missing') mis, sum(o) FILTER (b = 'missing') omis,
    sum(n) FILTER (b = 'invalid') inv, sum(o) FILTER (b = 'invalid') oinv, sum(n) FILTER (b LIKE '=%') ok, sum(o) FILTER (b LIKE '=%') ook FROM s GROUP BY ALL),
d AS (
  SELECT s.column_name, s.load_no, sum(abs(s.n / t.ok - s.o / t.ook)) / 2 drift FROM s JOIN t USING (column_name, load_no)
  WHERE s.b LIKE '=%' AND t.ok > 0 AND t.ook > 0 GROUP BY ALL)
SELECT load_no, column_name, 'missing' finding FROM t WHERE coalesce(mis, 0) / cells - coalesce(omis, 0) / ocells >= 0.1 - 1e-12
UNION ALL SELECT load_no, column_name, 'invalid' FROM t WHERE coalesce(inv, 0) / (cells - coalesce(mis, 0)) - coalesce(oinv, 0) / (ocells - coalesce(omis, 0)) >= 0.1 - 1e-12
UNION ALL SELECT load_no, column_name, 'drift' FROM d WHERE drift >= 0.25 - 1e-12
"""
QUERIES = {"p5_found": p5_found, "p5_profile": p5_profile, "p5_expressions": p5_expressions, "p5_coverage": p5_coverage}
SQL = {"p5_found": FOUND_SQL}
