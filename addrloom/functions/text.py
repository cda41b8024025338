"""Text forms of addresses, place names, states and PINs as Column expressions. Null counts as the empty text everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of all scripts, in a form that every regular expression dialect in use understands.
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
DIGIT = r"\p{Nd}"

# Spellings of the states, by canonical name; the second table is known to the cleaner only, the third to the validators only.
STATE_SPELLINGS = {
    "ANDHRA PRADESH": ("ANDHRAPRADESH", "AP"), "ARUNACHAL PRADESH": ("ARUNACHALPRADESH",), "ASSAM": ("AS",), "BIHAR": ("BR",),
    "CHHATTISGARH": ("CHHATISGARH", "CG"), "DELHI": ("DL",), "GOA": ("GA",), "GUJARAT": ("GJ",), "HARYANA": ("HR",),
    "HIMACHAL PRADESH": ("HIMACHALPRADESH", "HP"), "JAMMU AND KASHMIR": ("JAMMUANDKASHMIR", "JK", "J AND K"), "JHARKHAND": ("JH",),
    "KARNATAKA": ("KA",), "KERALA": ("KL",), "LADAKH": ("UT",), "MADHYA PRADESH": ("MADHYAPRADESH", "MP"), "MAHARASHTRA": ("MH",),
    "ODISHA": ("ORISSA", "OD"), "PUDUCHERRY": ("PONDICHERRY", "PY"), "PUNJAB": ("PB",), "RAJASTHAN": ("RJ",), "TAMIL NADU": ("TAMILNADU", "TN"),
    "TELANGANA": ("TS", "TG"), "UTTAR PRADESH": ("UTTARPRADESH", "UP"), "UTTARAKHAND": ("UK",), "WEST BENGAL": ("WESTBENGAL", "WB"),
}
CLEANER_SPELLINGS = {"ODISHA": ("OR",)}
VALIDATOR_SPELLINGS = {"JAMMU AND KASHMIR": ("J K",)}
#: States that the cleaner finds in a text though they have no other spelling; J K is what is left of J&K.
PLAIN_STATES = ("CHANDIGARH", "J K", "MANIPUR", "MEGHALAYA", "MIZORAM", "NAGALAND", "SIKKIM", "TRIPURA")
# Former names of cities.
FORMER_NAMES = {
    "BANGALORE": "BENGALURU", "BOMBAY": "MUMBAI", "CALCUTTA": "KOLKATA", "COCHIN": "KOCHI", "GURGAON": "GURUGRAM", "MADRAS": "CHENNAI",
    "POONA": "PUNE", "TRIVANDRUM": "THIRUVANANTHAPURAM",
}
# Single words that may stand before a place name.
LABELS = ("DIST", "DISTRICT", "DT", "GAON", "GRAM", "PO", "POST", "SUBDISTRICT", "TAHSIL", "TALUK", "TALUKA", "TEHSIL", "VILL", "VILLAGE")
# Texts that stand for no value, for the cleaner and for the validators, as they read once punctuation is gone.
PLACEHOLDERS = ("0", "N A", "NA", "NIL", "NONE", "NOT APPLICABLE", "NOT AVAILABLE", "NOT PROVIDED", "NULL", "UNAVAILABLE", "UNKNOWN")
GARBAGE = ("0", "ASK CUSTOMER", "CALL CUSTOMER", "NA", "NONE", "NOT AVAILABLE", "NOT PROVIDED", "NULL", "UNKNOWN", "XXXX", "XXXXXX")


def spellings(*tables: dict[str, tuple[str, ...]]) -> dict[str, str]:
    """Spelling to canonical name."""
    return {s: name for t in tables for name, forms in t.items() for s in forms}


CLEANER_STATES = spellings(STATE_SPELLINGS, CLEANER_SPELLINGS)
VALIDATOR_STATES = spellings(STATE_SPELLINGS, VALIDATOR_SPELLINGS)
#: Every spelling that the cleaner looks for in a text, to its canonical name.
STATES_IN_TEXT = CLEANER_STATES | {s: s for s in (*STATE_SPELLINGS, *PLAIN_STATES)}


def text(c: Column) -> Column:
    """The value without white space around it; '' for null."""
    return F.coalesce(F.regexp_replace(c.cast("string"), rf"\A{WS}+|{WS}+\z", ""), F.lit(""))


def one_blank(c: Column) -> Column:
    return F.regexp_replace(c, f"{WS}+", " ")


def collapsed(c: Column) -> Column:
    """The value with single blanks and its case kept."""
    return one_blank(text(c))


def clean_text(c: Column) -> Column:
    """Capitals; commas, semicolons and bars as single commas without blanks beside them and none at the ends."""
    t = one_blank(F.upper(text(c)))
    t = F.regexp_replace(t, r" ?[,;|] ?", ",")
    t = F.regexp_replace(t, ",+", ",")
    return F.regexp_replace(t, r"\A[ ,;]+|[ ,;]+\z", "")


def _bare(c: Column) -> Column:
    """Only A-Z, 0-9 and single blanks."""
    return F.trim(F.regexp_replace(c, r"[^A-Z0-9]+", " "))


def for_matching(c: Column) -> Column:
    """The cleaner's form for comparing: capitals and digits, words apart by one blank."""
    return _bare(clean_text(c))


def for_checking(c: Column) -> Column:
    """The validators' form: like `for_matching`, from the text as it stands."""
    return _bare(F.upper(text(c)))


def for_resolving(c: Column) -> Column:
    """The resolvers' and masters' form: & reads AND."""
    return _bare(F.replace(F.upper(text(c)), F.lit("&"), F.lit(" AND ")))


def mapped(c: Column, table: dict[str, str]) -> Column:
    """The table's value for the text, the text itself where it has none."""
    pairs = F.create_map(*[F.lit(x) for kv in sorted(table.items()) for x in kv])
    return F.coalesce(F.try_element_at(pairs, c), c)


def entity(c: Column) -> Column:
    """A place name without labels before it, by its present name."""
    t = F.regexp_replace(for_resolving(c), rf"\A(?:(?:{'|'.join(LABELS)})(?: |\z))+", "")
    return mapped(t, FORMER_NAMES)


def entity_words(c: Column) -> Column:
    """The different words of at least two letters in a place name, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.split(entity(c), " "), lambda w: F.length(w) >= 2)))


def cleaner_state(c: Column) -> Column:
    return mapped(for_matching(c), CLEANER_STATES)


def validator_state(c: Column) -> Column:
    return mapped(for_checking(c), VALIDATOR_STATES)


def resolver_state(c: Column) -> Column:
    return mapped(for_resolving(c), FORMER_NAMES | VALIDATOR_STATES)


def pin_runs(c: Column) -> Column:
    """Every run of exactly six digits in a text, in order."""
    return F.filter(F.split(F.coalesce(c.cast("string"), F.lit("")), rf"[^{DIGIT}]+"), lambda x: F.length(x) == 6)


def last_pin(c: Column) -> Column:
    """The last run of exactly six digits in a text, '' without one: the cleaner's PIN of a text and of a PIN field."""
    return F.coalesce(F.try_element_at(pin_runs(c), F.lit(-1)), F.lit(""))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, rf"[^{DIGIT}]", "")


def six_digits(c: Column) -> Column:
    """The validators' PIN: the digits if there are six."""
    d = _digits(text(c))
    return F.when(F.length(d) == 6, d).otherwise("")


def plain_pin(c: Column) -> Column:
    """The PIN of resolvers, repair and assembly: like `six_digits`, a decimal .0 dropped first."""
    d = _digits(F.regexp_replace(text(c), rf"\A({DIGIT}+)\.0+\z", "$1"))
    return F.when(F.length(d) == 6, d).otherwise("")


def loose_pin(c: Column) -> Column:
    """The masters' PIN: all digits, however many, a decimal .0 dropped first."""
    return _digits(F.regexp_replace(text(c), rf"\A({DIGIT}+)\.0+\z", "$1"))


def is_meaningful(c: Column) -> Column:
    """Whether the cleaner counts a text as a value."""
    t = for_matching(c)
    return (t != "") & ~t.isin(*PLACEHOLDERS)


def is_meaningful_text(c: Column) -> Column:
    """Whether the validators count a text as a value."""
    t = for_checking(c)
    return (t != "") & ~t.isin(*GARBAGE)


def phrase_pattern(c: Column) -> Column:
    """A regular expression for the words of a text with any white space between them; '' for an empty one."""
    t = for_matching(c)
    return F.when(t != "", F.concat(F.lit(r"\b"), F.replace(t, F.lit(" "), F.lit(r"\s+")), F.lit(r"\b"))).otherwise("")
