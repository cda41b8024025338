"""Mapping free-entered values to a canonical list by a partition-based pigeonhole join, in SQL only.

Distinct values are brought to bare capital letters (look-alikes, accents, punctuation and words such as CITY or DIST gone) and
then matched against the spellings of the list (present name, former name, abbreviation):

* equal spellings first;
* else a spelling cut into k+1 segments: within k edits at least one segment survives whole, shifted by at most k places, so
  the candidates are an equality join of segments with the value's substrings at those places; each is verified with the
  built-in levenshtein, and the one nearest spelling wins (none if two entries are equally near and not namesakes).
  It runs over the letters as typed and over their spelling by sound. Spellings of 8 letters or more may also have two pairs of
  neighbours exchanged (four edits, the same letters): they are cut a second time at other places, and as an exchange damages
  two segments only across a cut, the two cuttings leave a whole segment in one of them;
* values without a match are what an anti-join against the matched values leaves; they are reported with code 0.

k is 1 for spellings of 4, 2 of 5 to 7 and 3 of 8 or more letters; shorter ones and abbreviations must be equal.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.charforms import INVISIBLE, LOOKALIKES
from ..functions.names import MISSING
from ..plans.tables import shared, small, table

MOST_EDITS = 3


def _plain_letters() -> dict[str, str]:
    """Character to plain capital letter or digit, from the Unicode database and the table of look-alikes."""
    out = {k: v.upper() for k, v in LOOKALIKES.items()}
    for a, b in ((0xA0, 0x250), (0x1E00, 0x1F00), (0xFF00, 0xFFEF), (0x1D400, 0x1D800), (0x24B6, 0x24EA)):
        for cp in range(a, b):
            ch = chr(cp)
            base = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
            if len(base) == 1 and base.isascii() and base != ch and not base.isspace():
                out.setdefault(ch, base.upper())
    return out


_PLAIN = _plain_letters()


def bare(c: Column) -> Column:
    """Capital letters of a typed value, words apart by one space; '' if nothing is left."""
    t = F.regexp_replace(c, f"[{INVISIBLE}̀-ͯ]", "")
    t = F.upper(F.translate(t, "".join(_PLAIN), "".join(_PLAIN.values())))
    t = F.regexp_replace(t, r"\([^)]*\)|,.*$", " ")
    t = F.trim(F.regexp_replace(F.regexp_replace(t, r"\.(?=[A-Z](?:\.|$))", ""), r"[^A-Z]+", " "))
    return F.trim(F.regexp_replace(t, r"^(?:CITY|DIST|DISTRICT|TOWN) | (?:CITY|DIST|DISTRICT|URBAN|TOWN)$", ""))


def by_sound(c: Column) -> Column:
    """Letters only, doubled vowels and PH spelt in one way."""
    t = F.replace(c, F.lit(" "), F.lit(""))
    for a, b in (("OO", "U"), ("EE", "I"), ("PH", "F")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return t


def _forms(c: Column) -> Column:
    """The letters of a bare value as typed and by sound."""
    return F.array_distinct(F.array(F.replace(c, F.lit(" "), F.lit("")), by_sound(c)))


def is_missing(c: Column) -> Column:
    return c.isNull() | F.upper(F.trim(c)).isin(*MISSING)


def spellings(entries: DataFrame) -> DataFrame:
    """(kind, word, code, state, k) of a list with geo_code, entity_type, geo_name, statename, abbrev, former_name.

    k is how many edits the spelling allows: none for abbreviations and for names whose last word is cut to two letters."""
    listed = (
        "explode(array(named_struct('w', geo_name, 'short', false), named_struct('w', former_name, 'short', false), named_struct('w', abbrev, 'short', true),"
        " named_struct('w', if(geo_name LIKE '% %', regexp_extract(geo_name, '^(.* ..)[^ ]*$', 1), null), 'short', true)))"
    )
    n = F.length("word")
    k = F.when(F.col("short") | (n < 4), 0).when(n == 4, 1).when(n <= 7, 2).otherwise(MOST_EDITS)
    return (
        entries.select(F.col("entity_type").alias("kind"), F.col("geo_code").alias("code"), F.col("statename").alias("state"), F.expr(listed).alias("x"))
        .where("x.w IS NOT NULL").select("kind", "code", "state", F.explode(_forms(bare(F.col("x.w")))).alias("word"), F.col("x.short").alias("short")).where("word != ''")
        .select("kind", "word", "code", "state", k.alias("k"))
    )


def _segments(words: DataFrame) -> DataFrame:
    """Each spelling's k+1 segments, in the longer ones cut twice: (kind, word, k, from, seg)."""
    n, parts, i = F.length("word"), F.col("k") + 1, F.col("i")
    shift = F.col("shift")

    def cut(at: Column) -> Column:
        return F.floor(n * at / parts) + F.when((at > 0) & (at < parts), shift).otherwise(0)

    cuttings = F.explode(F.when(F.col("k") == MOST_EDITS, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (
        words.where("k > 0").select("kind", "word", "k").distinct().select("*", cuttings.alias("shift")).select("*", F.explode(F.sequence(F.lit(0), F.col("k"))).alias("i"))
        .select("kind", "word", "k", (cut(i) + 1).cast("int").alias("from"), (cut(i + 1) - cut(i)).cast("int").alias("size"))
        .select("kind", "word", "k", "from", F.substring("word", F.col("from"), F.col("size")).alias("seg"))
    )


def match(values: DataFrame, entries: DataFrame) -> DataFrame:
    """(kind, value, entries) of the distinct `values` (kind, value) that name an entry: the array of (code, state) of the nearest
    spelling; more than one element only for namesakes. Values that name none are absent. Null kinds or values match nothing."""
    words = spellings(entries)
    typed = values.where("kind IS NOT NULL AND value IS NOT NULL").select("kind", "value", F.explode(_forms(bare(F.col("value")))).alias("typed")).where("typed != ''")
    typed = shared(typed, "typed")  # read by several branches: the values are normalised once
    keys = typed.select("kind", "typed").distinct()
    exact = keys.join(words.select("kind", F.col("word").alias("typed"), "word").distinct(), ["kind", "typed"]).select("kind", "typed", "word", F.lit(0).alias("d"))
    rest = keys.join(exact, ["kind", "typed"], "left_anti")
    segments = _segments(words)
    # places where a segment may start in the value, and the sizes that segments have: both follow from the list alone
    places = segments.select("kind", "from", F.length("seg").alias("size"), "k").distinct().groupBy("kind").agg(F.collect_set(F.struct("from", "size", "k")).alias("places"))
    probes = (
        rest.join(places, "kind").select("kind", "typed", F.explode("places").alias("p"))
        .select("kind", "typed", F.col("p.from").alias("from"), F.col("p.size").alias("size"), F.col("p.k").alias("k"), F.explode(F.expr("sequence(p.`from` - p.k, p.`from` + p.k)")).alias("at"))
        .where("at >= 1 AND at + size - 1 <= length(typed)")
        .select("kind", "typed", "from", "k", F.substring("typed", F.col("at"), F.col("size")).alias("seg")).distinct()
    )
    d = F.levenshtein("typed", "word", MOST_EDITS + 1)
    exchanged = (F.col("k") == MOST_EDITS) & (F.col("d") == MOST_EDITS + 1) & (F.length("typed") == F.length("word")) & (F.array_sort(F.split("typed", "")) == F.array_sort(F.split("word", "")))
    near = (
        probes.join(segments, ["kind", "from", "k", "seg"]).where(F.abs(F.length("typed") - F.length("word")) <= F.col("k"))
        .select("kind", "typed", "word", "k").distinct().withColumn("d", d).where(F.col("d").between(F.lit(0), F.col("k")) | exchanged)
        .select("kind", "typed", "word", F.when(exchanged, 2).otherwise(F.col("d")).alias("d"))
    )
    hits = typed.join(exact.unionAll(near), ["kind", "typed"]).join(words.select("kind", "word", "code", "state"), ["kind", "word"])
    best = hits.groupBy("kind", "value").agg(F.min("d").alias("least"), F.collect_set(F.struct("d", "code", "state", "word")).alias("all"))
    nearest = best.select("kind", "value", F.expr("filter(all, x -> x.d = least)").alias("n"))
    entry = F.expr("array_distinct(transform(n, x -> named_struct('code', x.code, 'state', x.state)))")
    return nearest.select("kind", "value", entry.alias("entries"), F.expr("size(array_distinct(transform(n, x -> x.word)))").alias("words")).where(
        "size(entries) = 1 OR words <= 2 AND size(entries) = size(array_distinct(transform(entries, x -> x.state)))"
    )


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field_name, kind, rec_id, value, state, pincode, row_id) of every cell that isn't missing."""
    rows = table(spark, sf_dir, "cleaned_address_data").select("row_id", "city", "state", "pincode")
    pair = F.expr("explode(array(named_struct('f', 'cleaned_address_data.city', 'k', 'ULB', 'v', city), named_struct('f', 'cleaned_address_data.state', 'k', 'STATE', 'v', state)))")
    a = rows.select("row_id", "state", "pincode", pair.alias("c")).select(F.col("c.f").alias("field_name"), F.col("c.k").alias("kind"), F.col("row_id").alias("rec_id"), F.col("c.v").alias("value"), "state", "pincode", "row_id")
    r = table(spark, sf_dir, "resolution")
    b = r.select(F.lit("resolution.input_value").alias("field_name"), F.col("entity_type").alias("kind"), F.col("res_id").alias("rec_id"), F.col("input_value").alias("value"), "state", F.lit(None).cast("string").alias("pincode"), "row_id")
    return a.unionAll(b).where(~is_missing(F.col("value")))


def linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field_name, kind, rec_id, value, geo_code) of each value that isn't exactly a name of its kind; 0 if it names no entry.

    Of namesakes the one in the row's state is taken; the state is the row's own, else that of its PIN (of a resolution: of the
    row it belongs to), else the lower code."""
    entries = table(spark, sf_dir, "geo_directory")
    names = small(entries.select(F.col("entity_type").alias("kind"), F.col("geo_name").alias("value")).distinct())
    cases = _cells(spark, sf_dir).join(names, ["kind", "value"], "left_anti")
    # the states are values of their own: those that namesakes need are matched along with the rest
    typed = cases.select("kind", "value").distinct()
    found = shared(match(typed, entries), "matched")
    one, several = found.where("size(entries) = 1"), found.where("size(entries) > 1")
    plain = cases.join(small(one), ["kind", "value"]).select("field_name", "kind", "rec_id", "value", F.expr("entries[0].code").cast("bigint").alias("geo_code"))
    lost = cases.join(small(found.select("kind", "value")), ["kind", "value"], "left_anti").select("field_name", "kind", "rec_id", "value", F.lit(0).cast("bigint").alias("geo_code"))
    two = cases.join(small(several), ["kind", "value"])
    states = entries.where("entity_type = 'STATE'")
    own = found.where("kind = 'STATE' AND size(entries) = 1").select(F.col("value").alias("state"), F.expr("entries[0].state").alias("own_state"))
    exact = states.select(F.col("geo_name").alias("state"), F.col("geo_name").alias("exact_state"))
    pin = F.regexp_extract("pincode", r"^(?:PIN)?[\s-]*([0-9]{3})[\s-]?([0-9]{3})(?:\.0+)?\s*$", 0)
    digits = F.substring(F.regexp_replace(pin, "[^0-9]", ""), 1, 6)
    pins = table(spark, sf_dir, "pin_directory").select(F.col("pincode").alias("pin6"), F.col("statename").alias("pin_state")).distinct()
    # rows that name two towns are few: only they meet the rows of cleaned_address_data
    back = table(spark, sf_dir, "cleaned_address_data").select("row_id", F.col("state").alias("row_state"), F.col("pincode").alias("row_pin"))
    far = two.where("field_name = 'resolution.input_value'").select("row_id").distinct()
    two = two.join(back.join(small(far), "row_id", "left_semi"), "row_id", "left")
    two = two.withColumn("state", F.when(is_missing(F.col("state")), F.col("row_state")).otherwise(F.col("state"))).withColumn("pincode", F.coalesce("pincode", "row_pin"))
    two = two.join(small(exact), "state", "left").join(small(own), "state", "left").withColumn("pin6", digits).join(small(pins), "pin6", "left")
    want = F.coalesce("exact_state", "own_state", "pin_state")
    two = two.withColumn("want", want).withColumn("codes", F.expr("array_sort(transform(filter(entries, x -> x.state = want), x -> x.code))"))
    code = F.coalesce(F.expr("get(codes, 0)"), F.expr("array_min(transform(entries, x -> x.code))"))
    return plain.unionAll(lost).unionAll(two.select("field_name", "kind", "rec_id", "value", code.cast("bigint").alias("geo_code")))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entry that every freely typed city, state and input value names, 0 if none."""
    return linked(spark, sf_dir).select("field_name", "rec_id", "geo_code")


def p6_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that name no entry of the list, with how often they occur: the report for whoever keeps the list."""
    return linked(spark, sf_dir).where("geo_code = 0").groupBy("field_name", "kind", "value").agg(F.count("*").alias("n"))


__all__ = ["bare", "by_sound", "linked", "match", "p6_found", "p6_unmatched"]
