"""From files of any layout to one long table of addresses, and from scored addresses to the final and audit tables.

A layout is known by its signature: the first layout, in the order given, all of whose signature columns a file has. Columns are joined
without those that are absent, null or stand for nothing. The three kinds of address stay rows of one long table until the end, where they
are pivoted by loan and place; nothing is collected."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..plans.tables import shared, small, spread, table
from .infer import NO_RESOLUTION
from .textqueries import q, s_no_decimal, s_six, s_text

# Texts that stand for nothing in a joined column, and the columns that may hold an audit remark.
NOTHING = ("", "0", "0.0", "nan", "none", "null")
AUDIT_COLUMNS = ("auto_resolution_remark", "audit remark", "audit_remark", "resolution_remark", "qc_resolution_remark")
KINDS = ("current", "office", "alternate")


def identify(columns: Iterable[str], layouts: Mapping[str, Mapping[str, list[str]]]) -> str:
    """The name of the first layout whose signature the columns hold; an error if there is none."""
    have = set(columns)
    for name, layout in layouts.items():
        if set(layout["signature"]) <= have:
            return name
    raise ValueError(f"no layout has its signature in {sorted(have)}")


def joined(df: DataFrame, columns: list[str]) -> Column:
    """The filled ones of the columns that `df` has, apart by a comma and a blank."""
    parts = [t.text(F.col(f"`{c}`")) for c in columns if c in df.columns]
    if not parts:
        return F.lit("")
    return F.array_join(F.filter(F.array(*parts), lambda p: ~F.lower(p).isin(*NOTHING)), ", ")


def standardised_input(df: DataFrame, layouts: Mapping[str, Mapping[str, list[str]]]) -> DataFrame:
    """(lan in quotes, current, office, alternate address) of one file; rows without a loan number are left out."""
    layout = layouts[identify(df.columns, layouts)]
    lan = F.concat(F.lit("'"), joined(df, layout["lan"]), F.lit("'"))
    out = df.select(lan.alias("lan"), *[joined(df, layout.get(k, [])).alias(f"{k}_address") for k in KINDS])
    return out.where(F.replace("lan", F.lit("'"), F.lit("")) != "")


def long_form(df: DataFrame) -> DataFrame:
    """(std_id, lan, address_kind, full_address): the three addresses of a row as three rows."""
    return df.select("std_id", "lan", *[f"{k}_address" for k in KINDS]).unpivot(["std_id", "lan"], [f"{k}_address" for k in KINDS], "address_kind", "full_address").withColumn("address_kind", F.replace("address_kind", F.lit("_address"), F.lit("")))


def routed(raw: DataFrame, configs: DataFrame) -> DataFrame:
    """(file_id, line_no, layout, lan, current, office, alternate address) of JSON records: each file by the layout that its fields show.

    Layouts are tried in order of name; a file that shows none has a null layout and no rows here."""
    keys = raw.select("file_id", F.explode(F.json_object_keys("payload")).alias("key")).distinct()
    signs = configs.select("lender", F.explode(F.array_distinct("signature_cols")).alias("key"))
    need = configs.select("lender", F.size(F.array_distinct("signature_cols")).alias("need"))
    shown = keys.join(small(signs), "key").groupBy("file_id", "lender").agg(F.count("*").alias("n")).join(small(need), "lender").where("n = need")
    layout = shown.groupBy("file_id").agg(F.min("lender").alias("layout"))
    c = configs.select(F.col("lender").alias("layout"), *[f"{k}_cols" for k in ("lan", *KINDS)])
    rows = raw.select("file_id", "line_no", F.from_json("payload", "map<string,string>").alias("m")).join(small(shared(layout, "layouts")), "file_id").join(small(c), "layout")
    nothing = ", ".join(q(n) for n in NOTHING)

    def pick(k: str) -> str:
        return f"array_join(filter(transform({k}_cols, c -> trim(coalesce(try_element_at(m, c), ''))), p -> lower(p) NOT IN ({nothing})), ', ')"

    out = rows.select("file_id", "line_no", "layout", F.expr(f"concat('''', {pick('lan')}, '''')").alias("lan"), *[F.expr(pick(k)).alias(f"{k}_address") for k in KINDS])
    return out.where("lan <> ''''''")


def combined(address: Column, city: Column, state: Column, pin: Column) -> Column:
    """The address with city, state and PIN behind it, each only if what is there so far doesn't hold it in any case."""
    acc, seen = t.text(address), F.upper(t.text(address))
    parts = [F.nullif(acc, F.lit(""))]
    for v in (t.text(city), t.text(state), t.plain_pin(pin)):
        new = (v != "") & ~F.contains(seen, F.upper(v))
        parts.append(F.when(new, v))
        seen = F.when(new, F.concat(seen, F.lit(" "), F.upper(v))).otherwise(seen)
    return F.array_join(F.array_compact(F.array(*parts)), ", ")


def audit_remark(df: DataFrame) -> Column:
    """The first audit column that `df` has, blank ones as left unresolved; all unresolved without one."""
    found = next((c for c in AUDIT_COLUMNS if c in df.columns), None)
    return F.coalesce(F.nullif(t.text(F.col(f"`{found}`")), F.lit("")), F.lit(NO_RESOLUTION)) if found else F.lit(NO_RESOLUTION)


def check_alignment(base: DataFrame, other: DataFrame, at: str = "row_id", lan: str = "lan") -> None:
    """An error unless both tables have the same number of rows and the same loan at every place."""
    a, b = base.select(at, F.col(lan).alias("a")), other.select(at, F.col(lan).alias("b"))
    met = a.withColumn("in_a", F.lit(1)).join(b.withColumn("in_b", F.lit(1)), at, "full")
    r = met.agg(F.count("in_a").alias("a"), F.count("in_b").alias("b"), F.count_if(F.col("in_a").isNotNull() & F.col("in_b").isNotNull() & ~F.col("a").eqNullSafe(F.col("b"))).alias("differ")).collect()[0]
    if r.a != r.b:
        raise ValueError(f"{r.a} rows against {r.b}")
    if r.differ or r.a != met.count():
        raise ValueError(f"the loans differ at {r.differ} places")


def check_rows(before: DataFrame, after: DataFrame) -> None:
    """An error if a step changed the number of rows."""
    a, b = before.count(), after.count()
    if a != b:
        raise ValueError(f"{a} rows became {b}")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses with the class and score of their last scoring, and the place of each among the loan's addresses of its kind."""
    a = table(spark, sf_dir, "cleaned_address_data").select("row_id", "lan", "address_kind", "full_address", "city", "state", "pincode")
    last = table(spark, sf_dir, "quality_outputs").groupBy("row_id").agg(F.max_by(F.struct("quality_class", "raw_quality_score"), F.struct("scored_at", "quality_id")).alias("x")).select("row_id", "x.*")
    of = Window.partitionBy("lan", "address_kind").orderBy("row_id")
    return spread(a).join(last, "row_id", "left").withColumn("place", F.row_number().over(of))


def op_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each loan and place: the combined address, class and score of its current, office and alternate address."""
    x = _scored(spark, sf_dir).withColumn("address", combined(F.col("full_address"), F.col("city"), F.col("state"), F.col("pincode")))
    cols = []
    for k in KINDS:
        mine = F.col("address_kind") == k
        cols += [F.max(F.when(mine, F.col("address"))).alias(f"{k}_address"), F.max(F.when(mine, F.col("quality_class"))).alias(f"{k}_class"), F.max(F.when(mine, F.col("raw_quality_score"))).alias(f"{k}_score")]
    return x.groupBy("lan", "place").agg(*cols)


def op_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each loan and place: address, remark and class of the three kinds; blanks and an unresolved remark for absent ones."""
    x = _scored(spark, sf_dir)
    x = x.withColumn("remark", audit_remark(x))
    cols = []
    for k in KINDS:
        mine = F.col("address_kind") == k
        cols += [F.coalesce(F.max(F.when(mine, t.text(F.col("full_address")))), F.lit("")).alias(f"{k}_address"), F.coalesce(F.max(F.when(mine, F.col("remark"))), F.lit(NO_RESOLUTION)).alias(f"{k}_remark"), F.coalesce(F.max(F.when(mine, t.text(F.col("quality_class")))), F.lit("")).alias(f"{k}_class")]
    return x.groupBy("lan", "place").agg(*cols)


def op_long_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The standardised input as one long table, loans and addresses without white space around them."""
    x = long_form(table(spark, sf_dir, "standardized_input"))
    return x.select("std_id", t.text(F.col("lan")).alias("lan"), "address_kind", t.text(F.col("full_address")).alias("full_address"))


def op_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw record of a file whose layout is known, as loan number and three addresses."""
    raw = spread(table(spark, sf_dir, "raw_lender_records").select("file_id", "line_no", "payload"))
    return routed(raw, table(spark, sf_dir, "lender_configs"))


def _sql() -> dict[str, str]:
    scored = """SELECT a.*, quality_class, raw_quality_score, row_number() OVER (PARTITION BY a.lan, address_kind ORDER BY a.row_id) AS place FROM cleaned_address_data a
      LEFT JOIN (SELECT * FROM quality_outputs QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY scored_at DESC NULLS LAST, quality_id DESC) = 1) l ON a.row_id = l.row_id"""
    ad, ci, st, pi = s_text("full_address"), s_text("city"), s_text("state"), s_six(s_no_decimal("pincode"))
    step = "CASE WHEN {v} <> '' AND NOT contains(upper({acc}), upper({v})) THEN CASE WHEN {acc} = '' THEN {v} ELSE {acc} || ', ' || {v} END ELSE {acc} END"
    comb = f"SELECT *, {step.format(v='pi', acc='c2')} AS address FROM (SELECT *, {step.format(v='st', acc='c1')} AS c2 FROM (SELECT *, {step.format(v='ci', acc='ad')} AS c1 FROM (SELECT lan, address_kind, place, quality_class, raw_quality_score, {ad} AS ad, {ci} AS ci, {st} AS st, {pi} AS pi FROM ({scored}))))"
    fin = ", ".join(f"max(address) FILTER (address_kind = '{k}') AS {k}_address, max(quality_class) FILTER (address_kind = '{k}') AS {k}_class, max(raw_quality_score) FILTER (address_kind = '{k}') AS {k}_score" for k in KINDS)
    aud = ", ".join(f"coalesce(max({ad}) FILTER (address_kind = '{k}'), '') AS {k}_address, {q(NO_RESOLUTION)} AS {k}_remark, coalesce(max({s_text('quality_class')}) FILTER (address_kind = '{k}'), '') AS {k}_class" for k in KINDS)
    nothing = ", ".join(q(n) for n in NOTHING)
    pick = "array_to_string(list_filter(list_transform({k}_cols, lambda c: trim(coalesce(m[c], ''))), lambda p: lower(p) NOT IN (" + nothing + ")), ', ')"
    routes = f"""WITH r AS (SELECT file_id, line_no, payload, map_from_entries(list_transform(json_keys(payload), lambda k: struct_pack(k := k, v := json_extract_string(payload, '$."' || k || '"')))) AS m FROM raw_lender_records),
      k AS (SELECT DISTINCT file_id, unnest(json_keys(payload)) AS key FROM r), g AS (SELECT file_id, list(key) AS keys FROM k GROUP BY file_id),
      l AS (SELECT file_id, min(lender) AS layout FROM g JOIN lender_configs ON len(list_filter(signature_cols, lambda s: NOT list_contains(keys, s))) = 0 GROUP BY file_id)
      SELECT * FROM (SELECT r.file_id, line_no, layout, '''' || {pick.format(k='lan')} || '''' AS lan, {', '.join(pick.format(k=k) + f' AS {k}_address' for k in KINDS)} FROM r JOIN l USING (file_id) JOIN lender_configs c ON c.lender = layout) WHERE lan <> ''''''"""
    return {
        "op_final": f"SELECT lan, CAST(place AS INTEGER) AS place, {fin} FROM ({comb}) GROUP BY lan, place",
        "op_audit": f"SELECT lan, CAST(place AS INTEGER) AS place, {aud} FROM ({scored}) GROUP BY lan, place",
        "op_long_form": " UNION ALL ".join(f"SELECT std_id, {s_text('lan')} AS lan, '{k}' AS address_kind, {s_text(k + '_address')} AS full_address FROM standardized_input" for k in KINDS),
        "op_routed": routes,
    }


QUERIES = {f.__name__: f for f in (op_final, op_audit, op_long_form, op_routed)}
SQL = _sql()
