"""Same postal address written differently: a set-containment join over address parts.

1. Each address is scanned once (Arrow batches, no shuffle) into house with letter, flat with wing, street, locality with
   number, PIN and town; fields with several addresses are left out.
2. Street and locality names are corrected against the whole table's own spelling counts: a name turns into another one slip
   away, or sounding the same, that is at least `RATIO` times as frequent (deletion-neighbourhood equi-join on the distinct names).
3. Tokens are (house, flat, street) and (house, flat, locality). Every address is *indexed* under its rarest token - that of the less
   frequent name - and *probes* with its tokens. A pair that both directions find comes from the one that indexes the lower row, so
   no pair arises twice and nothing is deduplicated. The join carries hashes only.
4. A candidate is verified: no part that both have may differ (no contradiction), and the parts they share must hold `CONTAINED` of the
   weight of the poorer address. A part weighs the bits of its rarity in the whole table, log2(N / rows with it), so a common house
   number on a common street alone is not enough if each has other parts that the other lacks.

Null, empty and unparseable addresses (no house, or neither street nor locality) are in no pair; repeated rows are pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.addressgrammar import prepared, scan_prepared
from ..functions.names import NameIndex, bare_name, plain_pin
from ..plans.tables import shared, small, spread, table

RATIO = 3
CONTAINED = 0.7
#: Most rows of the two directories, which are sent to the tasks. They are lists of fixed size; more is an error, not another result.
DIRECTORY_ROWS = 200_000
PARSED = "row_id bigint, house string, flat string, sname string, stype string, lname string, ltype string, pin string, town string"
_NAMES = [x.split()[0] for x in PARSED.split(", ")]


def _directory(spark: SparkSession, sf_dir: str) -> tuple[dict[str, str], dict[str, str]]:
    """PIN to town and town spelling to town, from the directories of fixed size."""
    pins = table(spark, sf_dir, "pin_directory").select("pincode", "city")
    towns = table(spark, sf_dir, "geo_directory").where("entity_type = 'ULB'").select("geo_name", "former_name")
    p, t = pins.limit(DIRECTORY_ROWS + 1).collect(), towns.limit(DIRECTORY_ROWS + 1).collect()
    if max(len(p), len(t)) > DIRECTORY_ROWS:
        raise ValueError(f"a directory has more than {DIRECTORY_ROWS} rows")
    spelt = {bare_name(r.former_name): r.geo_name for r in t if r.former_name} | {bare_name(r.geo_name): r.geo_name for r in t}
    return {r.pincode: r.city for r in p if r.pincode and r.city}, spelt


def parse(df: DataFrame, pins: dict[str, str], towns: dict[str, str]) -> DataFrame:
    """One row of parts for each row of `df` (row_id, full_address, city, pincode) that holds one address."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = NameIndex(towns)
        for b in batches:
            ids, texts, cities, codes = (b.column(i).to_pylist() for i in range(4))
            out: tuple[list, ...] = tuple([] for _ in _NAMES)
            for rid, text, city, code in zip(ids, texts, cities, codes):
                if not text or rid is None:
                    continue
                house = flat = street = loc = ""
                tpin = ""
                n = [0, 0, 0]
                words = []
                for kind, value, _, _ in scan_prepared(prepared(text)):
                    if kind == "house":
                        house, n[0] = house or value, n[0] + 1
                    elif kind == "street":
                        street, n[1] = street or value, n[1] + 1
                    elif kind == "locality":
                        loc, n[2] = loc or value, n[2] + 1
                    elif kind == "flat":
                        flat = flat or value
                    elif kind == "pin":
                        tpin = value
                    elif kind == "word":
                        words.append(value)
                if min(n) > 1 or not house or not (street or loc):
                    continue
                town = index.find(bare_name(city))
                cpin = plain_pin(code)
                pin = tpin if tpin in pins else ""
                if pin:
                    town = pins[pin]
                else:
                    if not town and words:
                        town = next((t for w in reversed(words) if len(w) > 5 and (t := index.find(w))), "")
                    if cpin in pins and (not town or town == pins[cpin]):
                        pin, town = cpin, pins[cpin]
                sname, _, stype = street.partition(" ")
                lname, _, ltype = loc.partition(" ")
                for col, v in zip(out, (rid, house, flat, sname, stype, lname, ltype, pin, town)):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), *(pa.array(c, pa.string()) for c in out[1:])], names=_NAMES)

    return df.select("row_id", "full_address", "city", "pincode").mapInArrow(run, PARSED)


def spellings(parts: DataFrame) -> DataFrame:
    """(name, canon, n): of every street and locality name its correct spelling and that spelling's count in the whole table."""
    counts = (
        parts.select(F.explode(F.array("sname", "lname")).alias("name")).where("name rlike '^[A-Z]{4,}$'").groupBy("name").agg(F.count("*").alias("n"))
    )
    sound = "replace(replace(replace(name, 'OO', 'U'), 'EE', 'I'), 'PH', 'F')"  # functions.names.sounds
    counts = counts.withColumn("sound", F.expr(sound))
    forms = F.expr("array_union(array(name, sound), transform(sequence(1, length(name)), i -> concat(substring(name, 1, i - 1), substring(name, i + 1))))")
    near = counts.select("name", "n", "sound", F.explode(forms).alias("form"))
    right = near.where(f"n >= {RATIO}").select(F.col("name").alias("canon"), F.col("n").alias("cn"), F.col("sound").alias("csound"), "form")
    same_letters = F.array_sort(F.split("name", "")) == F.array_sort(F.split("canon", ""))
    d = F.levenshtein("name", "canon")
    best = (
        near.join(right, "form")
        .where((F.col("name") != F.col("canon")) & (F.col("cn") >= RATIO * F.col("n")))
        .where((d <= 1) | (F.col("sound") == F.col("csound")) | ((d == 2) & (F.length("name") == F.length("canon")) & same_letters))
        .groupBy("name")
        .agg(F.max_by("canon", F.struct("cn", "canon")).alias("canon"), F.max("cn").alias("cn"))
    )
    return counts.join(best, "name", "left").select("name", F.coalesce("canon", "name").alias("canon"), F.coalesce("cn", "n").alias("n"))


def same_location(parts: DataFrame) -> DataFrame:
    """(row_id_a, row_id_b), a < b: every pair of `parts` that denotes one location."""
    names = small(shared(spellings(parts), "spellings"))
    for side in ("s", "l"):
        fixed = names.select(F.col("name").alias(f"{side}name"), F.col("canon").alias(f"{side}canon"), F.col("n").alias(f"{side}n"))
        parts = parts.withColumn(f"{side}name", F.nullif(f"{side}name", F.lit(""))).join(fixed, f"{side}name", "left")
    s = F.concat_ws(" ", F.coalesce("scanon", "sname"), F.nullif("stype", F.lit("")))
    loc = F.concat_ws(" ", F.coalesce("lcanon", "lname"), F.nullif("ltype", F.lit("")))
    full = parts.select(
        "row_id", "house", "flat", F.when(F.col("sname").isNotNull(), s).alias("s"), F.when(F.col("lname").isNotNull(), loc).alias("l"), "sn", "ln",
        F.nullif("pin", F.lit("")).alias("pin"), F.nullif("town", F.lit("")).alias("town"),
    )
    full = shared(full, "corrected")
    total = full.count()
    for c in ("house", "s", "l", "town"):  # bits of each value's rarity
        bits = full.where(F.col(c).isNotNull()).groupBy(c).agg(F.log2(F.lit(float(max(2, total))) / F.count("*")).cast("float").alias(f"{c}_bits"))
        full = full.join(small(shared(bits, f"bits-{c}")), c, "left")
    # ordinal streets (6 CROSS) have no name of their own and are the more frequent of the two
    by_l = F.col("l").isNotNull() & (F.col("s").isNull() | F.col("sn").isNull() | (F.col("ln") < F.col("sn")))
    place = [F.col("house"), F.col("flat")]
    full = full.select(
        "row_id", F.xxhash64("s").alias("hs"), F.xxhash64("l").alias("hl"), F.col("pin").cast("int").alias("pin"), F.when(F.col("town").isNotNull(), F.xxhash64("town")).alias("town"),
        F.when(F.col("s").isNotNull(), F.xxhash64(*place, F.lit("s"), "s")).alias("ts"), F.when(F.col("l").isNotNull(), F.xxhash64(*place, F.lit("l"), "l")).alias("tl"),
        by_l.alias("by_l"), "house_bits", "s_bits", "l_bits", "town_bits",
    )
    full = full.withColumns({"hs": F.when(F.col("ts").isNotNull(), F.col("hs")), "hl": F.when(F.col("tl").isNotNull(), F.col("hl"))})
    full = full.withColumn("own", F.when(F.col("by_l"), F.col("tl")).otherwise(F.coalesce("ts", "tl"))).drop("by_l")
    cols = ("row_id", "hs", "hl", "pin", "town", "ts", "tl", "own", "house_bits", "s_bits", "l_bits", "town_bits")
    index = full.select(F.col("own").alias("token"), *(F.col(c).alias(f"{c}_a") for c in cols))
    probe = full.select(F.explode(F.array_compact(F.array("ts", "tl"))).alias("token"), *(F.col(c).alias(f"{c}_b") for c in cols))

    def agree(c: str) -> F.Column:
        return F.col(f"{c}_a") == F.col(f"{c}_b")

    def lacks(c: str) -> F.Column:
        return F.col(f"{c}_a").isNull() | F.col(f"{c}_b").isNull()

    def bits(c: str, side: str) -> F.Column:
        return F.coalesce(F.col(f"{c}_bits_{side}"), F.lit(0.0))

    both = F.coalesce(F.col("own_b") == F.col("ts_a"), F.lit(False)) | F.coalesce(F.col("own_b") == F.col("tl_a"), F.lit(False))  # the other direction finds it too
    weight = [sum((bits(c, x) for c in ("s", "l", "town")), bits("house", x)) for x in "ab"]
    alike = sum((F.when(F.coalesce(agree(h), F.lit(False)), bits(c, "a")).otherwise(0.0) for h, c in (("hs", "s"), ("hl", "l"), ("town", "town"))), bits("house", "a"))
    area = F.when(~lacks("pin"), agree("pin")).otherwise(lacks("town") | agree("town"))
    return (
        index.join(probe, "token")
        .where((F.col("row_id_a") < F.col("row_id_b")) | ((F.col("row_id_a") > F.col("row_id_b")) & ~both))
        .where((lacks("hs") | agree("hs")) & (lacks("hl") | agree("hl")) & area)
        .where(alike >= CONTAINED * F.least(*weight))
        .select(F.least("row_id_a", "row_id_b").alias("row_id_a"), F.greatest("row_id_a", "row_id_b").alias("row_id_b"))
    )


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of rows of cleaned_address_data that denote one location."""
    pins, towns = _directory(spark, sf_dir)
    parts = parse(spread(table(spark, sf_dir, "cleaned_address_data").select("row_id", "full_address", "city", "pincode")), pins, towns)
    return same_location(shared(parts, "addressparts"))
