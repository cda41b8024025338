"""Reading and writing tables of texts: CSV, workbooks, SpreadsheetML and row XML by suffix; finding files; matching columns by alias.

Every column is text, a missing cell the empty text. CSV and XML are read by the cluster; a workbook (.xls, .xlsx, .xlsm) is read on the
driver with whatever engine pandas has, as Spark has no reader for it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORKBOOKS = (".xls", ".xlsx", ".xlsm")
#: What the quality stage reads as a missing cell.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
# The columns of the five reference tables with the names under which they come, by table; ? marks one that may be absent.
MASTERS = {
    "india_post": {"pincode": ("pincode", "pin", "pin_code"), "statename": ("statename", "state_name", "state"), "district": ("district", "districtname", "district_name"), "officename": ("officename", "office_name", "post_office", "postoffice")},
    "district": {"district_code": ("district_code", "districtcode"), "district_name": ("district_name_in_english", "district_name", "district")},
    "subdistrict": {
        "district_code": ("district_code", "districtcode"), "district_name": ("district_name", "district_name_in_english"), "subdistrict_code": ("subdistrict_code", "sub_district_code"),
        "subdistrict_name": ("subdistrict_name_in_english", "sub_district_name_in_english", "subdistrict_name", "sub_district_name"),
    },
    "village": {
        "district_code": ("district_code", "districtcode"), "district_name": ("district_name", "district_name_in_english"), "subdistrict_code": ("sub_district_code", "subdistrict_code"),
        "subdistrict_name": ("sub_district_name", "subdistrict_name", "sub_district_name_in_english", "subdistrict_name_in_english"), "village_code": ("village_code", "villagecode"), "village_name": ("village_name_in_english", "village_name"),
    },
    "ulb": {
        "ulb_code": ("local_body_code", "localbody_code"), "ulb_name": ("local_body_name_in_english", "localbody_name_in_english", "local_body_name", "localbody_name"),
        "?ulb_type": ("localbody_type_name", "local_body_type_name"),
    },
}
#: The names under which the columns of a customer table come; the first that is there counts, in any case.
CUSTOMER = {
    "address": ("full address", "full_address", "address", "clean full address", "clean_address"), "city": ("city", "clean city", "clean_city"), "pincode": ("pincode", "pin", "clean pincode", "clean_pincode"),
    "state": ("state", "clean state", "clean_state"), "district": ("district",), "subdistrict": ("subdistrict", "sub-district", "sub_district"), "village": ("village",), "post_office": ("post office", "post_office", "po"),
}
REQUIRED = ("address", "pincode", "state")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header (a byte order mark is skipped) as texts."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return df.na.fill("")


def with_gaps(df: DataFrame) -> DataFrame:
    """`df` with every cell that is an NA token emptied, as the quality stage reads it."""
    return df.select([F.when(F.col(f"`{c}`").isin(*NA_TOKENS), "").otherwise(F.col(f"`{c}`")).alias(c) for c in df.columns])


def read_spreadsheet_xml(spark: SparkSession, path: str) -> DataFrame:
    """A SpreadsheetML workbook: the first row names the columns; shorter rows are filled up, longer ones cut.

    Rows stay distributed; only the header reaches the driver. Gaps that a cell's index leaves are not kept."""
    rows = spark.read.format("xml").option("rowTag", "Row").option("inferSchema", False).schema("Cell array<struct<Data:struct<_VALUE:string,`_ss:Type`:string>>>").load(path)
    cells = rows.select(F.transform("Cell", lambda c: F.coalesce(c["Data"]["_VALUE"], F.lit(""))).alias("c"), F.monotonically_increasing_id().alias("at"))
    first = cells.orderBy("at").limit(1).collect()
    if not first:
        raise ValueError(f"no row in {path}")
    names = [n.strip() for n in first[0].c]
    body = cells.where(F.col("at") > first[0].at)
    return body.select(*[F.trim(F.coalesce(F.get("c", F.lit(i)), F.lit(""))).alias(n) for i, n in enumerate(names)])


def read_row_xml(spark: SparkSession, path: str) -> DataFrame:
    """Plain XML with one Row element for each row, its columns as elements or attributes."""
    df = spark.read.format("xml").option("rowTag", "Row").option("inferSchema", False).load(path)
    return df.select([F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c.lstrip("_")) for c in df.columns])


def read_workbook(spark: SparkSession, path: str) -> DataFrame:
    import pandas as pd

    return spark.createDataFrame(pd.read_excel(path, dtype=str, keep_default_na=False).astype(str))


def load_table(spark: SparkSession, path: str) -> DataFrame:
    """A table of texts by the suffix of its file. An .xls that pandas can't open is read as row XML, then as SpreadsheetML."""
    suffix = Path(path).suffix.lower()
    if suffix == ".csv":
        return read_csv(spark, path)
    if suffix == ".xml":
        return read_row_xml(spark, path)
    if suffix not in WORKBOOKS:
        raise ValueError(f"no reader for {path}")
    try:
        return read_workbook(spark, path)
    except (ImportError, ValueError, OSError):
        rows = read_row_xml(spark, path)
        return rows if rows.columns and "Cell" not in rows.columns else read_spreadsheet_xml(spark, path)


def find_file(folder: str, keyword: str) -> str:
    """The table whose name holds the keyword: the shortest name, then the first in order; searched in all folders below."""
    hits = [p for p in Path(folder).rglob("*") if p.suffix.lower() in (".csv", *WORKBOOKS) and keyword in p.name.lower()]
    if not hits:
        raise FileNotFoundError(f"no table with {keyword} in its name below {folder}")
    return str(min(hits, key=lambda p: (len(p.name), str(p))))


def first_input(folder: str) -> str | None:
    """The first customer file of a folder in order of name; None without one."""
    hits = sorted(str(p) for p in Path(folder).glob("*") if p.suffix.lower() in (".csv", ".xls", ".xlsx"))
    return hits[0] if hits else None


def plain_name(name: str) -> str:
    """A column name in small letters, & as and, everything else but letters and digits as one underscore."""
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower().replace("&", " and ")).strip("_")


def plain_names(df: DataFrame) -> DataFrame:
    """`df` with plain column names; names that become the same keep their order and get a number."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        n = plain_name(c)
        seen[n] = seen.get(n, 0) + 1
        names.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
    return df.toDF(*names)


def find_column(columns: Iterable[str], names: Iterable[str], required: bool = False, of: str = "") -> str | None:
    """The column that has the first of the names once both are plain; None, or an error if required."""
    columns = list(columns)
    by_name = {plain_name(c): c for c in reversed(columns)}
    for n in names:
        if plain_name(n) in by_name:
            return by_name[plain_name(n)]
    if required:
        raise ValueError(f"no column {list(names)} in {of or 'the table'}; it has {columns}")
    return None


def customer_columns(columns: Iterable[str]) -> dict[str, str]:
    """The customer columns that a table has, by what they hold; an error if address, pincode or state is missing."""
    by_name = {c.strip().lower(): c for c in reversed(list(columns))}
    out = {k: next((by_name[n] for n in names if n in by_name), None) for k, names in CUSTOMER.items()}
    lacking = [k for k in REQUIRED if out[k] is None]
    if lacking:
        raise ValueError(f"no column for {lacking}")
    return {k: v for k, v in out.items() if v}


def standardised(df: DataFrame, kind: str) -> DataFrame:
    """A reference table with its columns under their fixed names, trimmed, and a *_clean form of every name (of the PIN: its digits)."""
    from ..functions.text import for_resolving, loose_pin

    df = plain_names(df)
    out = {}
    for name, aliases in MASTERS[kind].items():
        column = find_column(df.columns, aliases, not name.startswith("?"), kind)
        out[name.lstrip("?")] = F.trim(F.coalesce(F.col(column).cast("string"), F.lit(""))) if column else F.lit("")
    rest = [c for c in df.columns if c not in out]
    clean = {f"{n}_clean": (loose_pin(c) if n == "pincode" else for_resolving(c)) for n, c in out.items() if not n.endswith(("_code", "_type"))}
    return df.select(*rest, *[c.alias(n) for n, c in out.items()], *[c.alias(n) for n, c in clean.items()])


def load_masters(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five reference tables of a folder, standardised."""
    return {kind: standardised(load_table(spark, find_file(folder, kind)), kind) for kind in MASTERS}


def write_csv(df: DataFrame, path: str) -> None:
    """`df` as CSV files with header, quoted where needed; an empty text stays empty."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
