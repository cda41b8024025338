"""Validation of addresses: presence, PIN format, PIN known, PIN against state, garbage, and evidence of the PIN's district.

Each check gives a status (PASS, FAIL, AMBIGUOUS, NOT_CHECKED, and NOT_FOUND for evidence) and a fraction of its score. One join with the PIN
table, broadcast while that is small; null and empty inputs have the statuses stated at each function."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..plans.tables import small, spread, table
from .indexes import masters, pin_context
from .textqueries import q, s_collapsed, s_digits, s_entity, s_in, s_mapped, s_resolving, s_six, s_text, s_checking, s_has


def check(status: Column, fraction: Column | None = None, reason: Column | None = None, severity: Column | None = None, auto: Column | None = None) -> Column:
    """A check's result as a struct; the fraction is 1, 0.5 or 0 by the status unless given."""
    by_status = F.when(status == "PASS", 1.0).when(status == "FAIL", 0.0).otherwise(0.5)
    empty = F.lit("")
    return F.struct(status.alias("status"), F.coalesce(fraction, by_status).alias("fraction") if fraction is not None else by_status.alias("fraction"), (reason if reason is not None else empty).alias("reason"), (severity if severity is not None else F.when(status == "FAIL", "CRITICAL").otherwise("INFO")).alias("severity"), (auto if auto is not None else F.lit(False)).alias("auto_correctable"))


def present(address: Column) -> Column:
    """FAIL for a null, empty or placeholder address."""
    return check(F.when(t.is_meaningful_text(address), "PASS").otherwise("FAIL"), reason=F.when(t.is_meaningful_text(address), "").otherwise("no meaningful address"))


def pin_format(pin: Column) -> Column:
    """PASS for six digits, also with other characters between or around them (auto-correctable then); FAIL otherwise."""
    raw = t.collapsed(pin)
    exact, six = raw.rlike(rf"\A{t.DIGIT}{{6}}\z"), F.length(F.regexp_replace(raw, rf"[^{t.DIGIT}]", "")) == 6
    return check(F.when(exact | six, "PASS").otherwise("FAIL"), severity=F.when(exact, "INFO").when(six, "LOW").otherwise("HIGH"), auto=six & ~exact)


def pin_exists(pin: Column, n: Column) -> Column:
    """PASS if the PIN table knows the PIN (`n` is its row count there, null if unknown)."""
    return check(F.when((t.six_digits(pin) != "") & n.isNotNull(), "PASS").otherwise("FAIL"))


def pin_state(pin: Column, state: Column, states: Column) -> Column:
    """NOT_CHECKED without PIN or state; else whether the state is one of the PIN's, AMBIGUOUS if it is none of several."""
    st = t.validator_state(state)
    status = F.when((t.six_digits(pin) == "") | (st == ""), "NOT_CHECKED").when(states.isNull(), "FAIL").when(F.array_contains(states, st), "PASS").when(F.size(states) > 1, "AMBIGUOUS").otherwise("FAIL")
    return check(status)


def garbage(address: Column, city: Column, state: Column, pin: Column) -> Column:
    """FAIL for nothing, a placeholder, or up to four words all of which are city, state or PIN; AMBIGUOUS if a placeholder is among the words."""
    text = t.for_checking(address)
    words = F.split(text, " ")
    known = F.concat(F.split(t.for_checking(city), " "), F.split(t.validator_state(state), " "), F.array(t.six_digits(pin)))
    only = (F.size(words) <= 4) & (F.size(F.array_except(words, known)) == 0)
    noise = text.rlike(rf"\b(?:{'|'.join(t.GARBAGE)})\b")
    return check(F.when((text == "") | text.isin(*t.GARBAGE) | only, "FAIL").when(noise, "AMBIGUOUS").otherwise("PASS"))


def district_evidence(a: Column, pin: Column, districts: Column) -> Column:
    """Of the address as an entity: PASS if one district of the PIN stands in the address, AMBIGUOUS if several do, NOT_FOUND if none, NOT_CHECKED without data."""
    found = F.size(F.filter(districts, lambda d: F.contains(F.concat(F.lit(" "), a, F.lit(" ")), F.concat(F.lit(" "), d, F.lit(" ")))))
    status = F.when((t.six_digits(pin) == "") | (a == "") | districts.isNull() | (F.size(districts) == 0), "NOT_CHECKED").when(found == 1, "PASS").when(found > 1, "AMBIGUOUS").otherwise("NOT_FOUND")
    return check(status)


def checked(rows: DataFrame, pins: DataFrame) -> DataFrame:
    """`rows` (row_id, full_address, city, state, pincode, ...) with one struct for each check and the PIN's districts as text."""
    ctx = pins.select(F.col("pin").alias("ctx_pin"), F.col("n").alias("ctx_n"), F.col("states").alias("ctx_states"), F.col("district_entities").alias("ctx_entities"), F.col("districts").alias("ctx_districts"))
    a, p, s, c = (F.col(k) for k in ("full_address", "pincode", "state", "city"))
    out = rows.join(small(ctx), t.six_digits(p) == F.col("ctx_pin"), "left").withColumn("ctx_address", t.entity(a))  # once, not for every district
    return out.select(
        *rows.columns, present(a).alias("present"), pin_format(p).alias("pin_format"), pin_exists(p, F.col("ctx_n")).alias("pin_exists"), pin_state(p, s, F.col("ctx_states")).alias("pin_state"),
        garbage(a, c, s, p).alias("garbage"), district_evidence(F.col("ctx_address"), p, F.col("ctx_entities")).alias("district_evidence"), F.coalesce(F.array_join("ctx_districts", "; "), F.lit("")).alias("india_post_district"),
    )


CHECKS = ("present", "pin_format", "pin_exists", "pin_state", "garbage", "district_evidence")


def op_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of every row: status and fraction."""
    rows = spread(table(spark, sf_dir, "cleaned_address_data").select("row_id", "full_address", "city", "state", "pincode"))
    x_ = checked(rows, pin_context(masters(spark, sf_dir)["india_post"]))
    return x_.select("row_id", *[F.col(f"{c}.status").alias(c) for c in CHECKS], *[F.col(f"{c}.fraction").alias(f"{c}_fraction") for c in CHECKS], F.col("pin_format.auto_correctable").alias("auto_correctable"), "india_post_district")


def op_check_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows have each status of each check, and how many columns are filled: the summary of a run."""
    one = F.explode(F.expr("array(" + ", ".join(f"named_struct('what', '{c}', 'status', {c})" for c in CHECKS) + ")"))
    counts = op_checks(spark, sf_dir).select(one.alias("x")).groupBy("x.what", "x.status").agg(F.count("*").alias("n"))
    rows = table(spark, sf_dir, "cleaned_address_data")
    filled = rows.agg(*[F.count_if(t.text(F.col(c)) != "").alias(c) for c in ("full_address", "city", "state", "pincode")], F.count_if(t.six_digits(F.col("pincode")) != "").alias("valid_pin"))
    more = filled.select(F.explode(F.expr("array(" + ", ".join(f"named_struct('what', '{c}', 'status', 'FILLED', 'n', {c})" for c in ("full_address", "city", "state", "pincode", "valid_pin")) + ")")).alias("x")).select("x.*")
    return counts.unionAll(more)


def preflight(df: DataFrame, columns: dict[str, str], strict: bool = False) -> dict[str, int]:
    """Counts of rows and of filled cells by column; strict raises for an empty table, an empty column or half of the PINs invalid."""
    cells = {k: F.count_if(t.text(F.col(f"`{c}`")) != "").alias(k) for k, c in columns.items()}
    got = df.agg(F.count("*").alias("rows"), *cells.values(), F.count_if(t.six_digits(F.col(f"`{columns['pincode']}`")) != "").alias("valid_pin")).collect()[0].asDict()
    if strict:
        if not got["rows"]:
            raise ValueError("the table has no rows")
        empty = [k for k in columns if not got[k]]
        if empty:
            raise ValueError(f"no value in {empty}")
        if got["valid_pin"] * 2 <= got["rows"]:
            raise ValueError("half of the PINs or more are invalid")
    return got


def _sql() -> dict[str, str]:
    garb = rf"\b(?:{'|'.join(t.GARBAGE)})\b"
    st = s_mapped(s_checking("state"), t.VALIDATOR_STATES)
    inner = f"""
      WITH ctx AS (SELECT trim(pincode) AS pin, count(*) AS n, list_sort(list(DISTINCT {s_resolving('statename')})) AS states, list_sort(list(DISTINCT {s_resolving('district')})) AS districts, list(DISTINCT {s_entity('district')}) AS entities FROM pin_directory GROUP BY 1),
      b AS (SELECT row_id, {s_checking('full_address')} AS tx, {s_entity('full_address')} AS a, {s_six(s_text('pincode'))} AS p, {s_collapsed('pincode')} AS raw, {st} AS st, {s_checking('city')} AS ci FROM cleaned_address_data),
      j AS (SELECT b.*, n, states, districts, entities, len(list_filter(entities, lambda d: contains(' ' || a || ' ', ' ' || d || ' '))) AS found,
        len(string_split(tx, ' ')) <= 4 AND len(list_filter(string_split(tx, ' '), lambda w: NOT list_contains(list_concat(string_split(ci, ' '), string_split(st, ' '), [p]), w))) = 0 AS only_known FROM b LEFT JOIN ctx ON b.p = ctx.pin)
      SELECT row_id, CASE WHEN tx <> '' AND NOT {s_in('tx', t.GARBAGE)} THEN 'PASS' ELSE 'FAIL' END AS present,
        CASE WHEN length({s_digits('raw')}) = 6 THEN 'PASS' ELSE 'FAIL' END AS pin_format, length({s_digits('raw')}) = 6 AND length(raw) <> 6 AS auto_correctable,
        CASE WHEN p <> '' AND n IS NOT NULL THEN 'PASS' ELSE 'FAIL' END AS pin_exists,
        CASE WHEN p = '' OR st = '' THEN 'NOT_CHECKED' WHEN states IS NULL THEN 'FAIL' WHEN list_contains(states, st) THEN 'PASS' WHEN len(states) > 1 THEN 'AMBIGUOUS' ELSE 'FAIL' END AS pin_state,
        CASE WHEN tx = '' OR {s_in('tx', t.GARBAGE)} OR only_known THEN 'FAIL' WHEN {s_has('tx', garb)} THEN 'AMBIGUOUS' ELSE 'PASS' END AS garbage,
        CASE WHEN p = '' OR a = '' OR entities IS NULL THEN 'NOT_CHECKED' WHEN found = 1 THEN 'PASS' WHEN found > 1 THEN 'AMBIGUOUS' ELSE 'NOT_FOUND' END AS district_evidence,
        coalesce(array_to_string(districts, '; '), '') AS india_post_district FROM j"""
    fr = ", ".join(f"CASE {c} WHEN 'PASS' THEN 1.0::DOUBLE WHEN 'FAIL' THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS {c}_fraction" for c in CHECKS)
    n = " UNION ALL ".join(f"SELECT {q(c)} AS what, {c} AS status, count(*) AS n FROM i GROUP BY {c}" for c in CHECKS)
    f = " UNION ALL ".join(f"SELECT {q(c)}, 'FILLED', count(*) FILTER ({s_text(c)} <> '') FROM cleaned_address_data" for c in ("full_address", "city", "state", "pincode"))
    return {
        "op_checks": f"SELECT *, {fr} FROM ({inner})",
        "op_check_counts": f"WITH i AS ({inner}) {n} UNION ALL {f} UNION ALL SELECT 'valid_pin', 'FILLED', count(*) FILTER ({s_six(s_text('pincode'))} <> '') FROM cleaned_address_data",
    }


QUERIES = {"op_checks": op_checks, "op_check_counts": op_check_counts}
SQL = _sql()
