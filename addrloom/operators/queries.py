"""The general (not llm) queries and their SQL by name; each query takes (spark, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.tables import spread, table
from . import checks, gapfill, indexes, infer, lifespan, profile, resolve, route, score, textqueries
from .multivalue import split_values


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table_name, rec_id, text) of the two fields that may hold several addresses."""
    a = table(spark, sf_dir, "standardized_input").select(F.lit("standardized_input").alias("table_name"), F.col("std_id").alias("rec_id"), F.col("current_address").alias("text"))
    b = table(spark, sf_dir, "cleaned_address_data").select(F.lit("cleaned_address_data").alias("table_name"), F.col("row_id").alias("rec_id"), F.col("full_address").alias("text"))
    return spread(a.unionAll(b))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per address of each field with two or more complete addresses."""
    return split_values(_packed(spark, sf_dir), "text", ["table_name", "rec_id"], several_only=True).select("table_name", "rec_id", "pos")


def p4_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of both fields in a row of its own, with position and error flags."""
    return split_values(_packed(spark, sf_dir), "text", ["table_name", "rec_id"])


MODULES = (gapfill, profile, lifespan, textqueries, indexes, checks, resolve, infer, route, score)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p4_found": p4_found, "p4_values": p4_values}
SQL: dict[str, str] = {}
for _m in MODULES:
    QUERIES |= _m.QUERIES
    SQL |= _m.SQL
