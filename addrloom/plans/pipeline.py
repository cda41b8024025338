"""The stages in one plan: a customer file of any known layout becomes scored addresses, the final and the audit table.

Nothing is collected between the stages; masters are read once for each run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import extract as x
from ..functions import text as t
from ..functions.similar import collapse_repeats
from ..operators.infer import auto_resolved, cleaned
from ..operators.resolve import Reference
from ..operators.route import KINDS, NO_RESOLUTION, combined, long_form, standardised_input
from ..operators.score import scored
from ..plans.tables import shared
from ..sources.files import load_masters, load_table


def numbered(df: DataFrame, name: str) -> DataFrame:
    """`df` with a number for every row, from 1 in the order of the file. The numbers are fixed by writing the table once."""
    df = shared(df.withColumn("__at", F.monotonically_increasing_id()), "rows")
    starts = df.groupBy(F.shiftright("__at", 33).alias("__part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition of the file
    starts = starts.withColumn("__start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    joined = df.withColumn("__part", F.shiftright("__at", 33)).join(F.broadcast(starts), "__part")
    return joined.withColumn(name, F.col("__start") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1).drop("__at", "__part", "__start")


def run(spark: SparkSession, path: str, masters: str, layouts: Mapping[str, Mapping[str, list[str]]], respect_clean_city: bool = False) -> dict[str, DataFrame]:
    """standardised, cleaned, resolved, scored, final and audit table of the customer file at `path` with the masters of a folder."""
    m = load_masters(spark, masters)
    ref = Reference(spark, "", m)
    std = shared(numbered(standardised_input(load_table(spark, path), layouts), "std_id"), "standardised")
    rows = shared(long_form(std).withColumn("row_id", F.col("std_id") * len(KINDS) + F.element_at(F.create_map(*[F.lit(v) for i, k in enumerate(KINDS) for v in (k, i)]), F.col("address_kind"))), "long")
    offices = m["india_post"].select(t.last_pin(F.col("pincode")).alias("pin"), t.clean_text(F.col("officename")).alias("office")).where("pin <> '' AND office <> ''").distinct()
    c = cleaned(rows, ref, offices)
    c = c.withColumn("body", x.first_of_repeats(t.clean_text(collapse_repeats(t.clean_text(F.col("body")))), F.col("city"), 3))
    clean = shared(c.select("row_id", x.first_of_repeats(F.col("body"), F.col("state"), 4).alias("full_address"), "city", "state", F.col("pin").alias("pincode")), "cleaned")
    fixed = auto_resolved(clean, ref, respect_clean_city)
    resolved = shared(rows.select("row_id", "std_id", "lan", "address_kind").join(clean.select("row_id", "full_address"), "row_id").join(fixed, "row_id"), "resolved")
    ready = resolved.withColumn("district", F.lit("")).withColumn("post_office", x.labelled(F.col("full_address"), "post_office"))
    s = shared(scored(ready.select("row_id", "full_address", "city", "state", "district", "pincode", "post_office"), ref).select("row_id", "raw_score", "score", "class", "metadata"), "scored")
    both = resolved.join(s, "row_id").withColumn("address", combined(F.col("full_address"), F.col("city"), F.col("state"), F.col("pincode")))

    def pivot(columns: Mapping[str, str], blank: Mapping[str, str]) -> DataFrame:
        cols = [F.coalesce(F.max(F.when(F.col("address_kind") == k, F.col(v).cast("string"))), F.lit(blank.get(n, ""))).alias(f"{k}_{n}") for k in KINDS for n, v in columns.items()]
        return both.groupBy("std_id", "lan").agg(*cols)

    return {
        "standardised": std, "cleaned": clean, "resolved": resolved, "scored": both.drop("address"),
        "final": pivot({"clean_address": "address", "quality_class": "class", "raw_quality_score": "raw_score"}, {}), "audit": pivot({"address": "full_address", "remark": "remark", "class": "class"}, {"remark": NO_RESOLUTION}),
    }
