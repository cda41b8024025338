"""Parts of an address by labels, words and patterns, as Column expressions over the raw text. Null counts as the empty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import PLACEHOLDERS, STATES_IN_TEXT, WS, clean_text, collapsed, entity, for_matching, last_pin, resolver_state, text

#: Edges of a word in any script, spelt out because the dialects of \\b differ.
EDGE, END = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"
# How a label is written before the name that it announces; the first that captures something counts.
LABELLED = {
    "village": (r"VILL(?:AGE)?", r"GRAM", r"GAON"),
    "post_office": (r"P\.?\s*O\.?", r"POST\s+OFFICE", r"POST"),
    "district": (r"DIST(?:RICT)?", r"DT"),
    "subdistrict": (r"TEHSIL", r"TAHSIL", r"TALUK(?:A)?", r"TALUKAM?", r"MANDAL", r"BLOCK", r"SUB[- ]?DISTRICT"),
    "locality": (r"LOCALITY", r"AREA", r"MOHALLA(?:H)?"),
}
NAME = r"\s*[-.:]?\s*([^,;]+)"
# Words that show a part of an address.
WORDS = {
    "building": "APARTMENT APPARTMENT BLOCK BUILDING BUNGALOW COLLEGE COMPLEX FACTORY GARMENTS HOSPITAL HOSTEL HOTEL MALL MARKET OFFICE RESIDENCE RESIDENCY SCHOOL SHOP SOCIETY TOWER",
    "street": "BYPASS CHOWK CROSS GALI GALII HIGHWAY HWY LANE MARG PATH RD ROAD SECTOR ST STREET WARD",
    "locality": "AREA BASTI COLONY DHANI ENCLAVE EXTENSION GAON GRAM KHEDA LOCALITY MOHALLA MOHALLAH NAGAR PARA PHASE PURA PURAM SOCIETY TOLA VILL VILLAGE WARD",
    "anchor": "AREA BASTI BLOCK CHOWK CHOWRAHA COLONY CROSSING DHANI DIST DISTRICT ENCLAVE GALI GAON GRAM HIGHWAY LANE MARG MOHALLA NAGAR PATH PO POST PURA RD ROAD SECTOR STREET VILL VILLAGE WARD",
}
#: What stands for two words or holds a blank among the words above.
PHRASES = {"street": (r"RING\s*ROAD", r"MAIN\s*ROAD", r"CIRCULAR\s*ROAD"), "anchor": (r"P\s*O",)}
NUMBERED = "DOOR FLAT HOUSE KHASRA PLOT ROOM SHOP SURVEY UNIT"
RURAL = r"VILL(?:AGE)?|GRAM|GAON|KHET|KHEDA|DHANI|TOLA|PURA|MAJRA|MAUZA|TEHSIL|TAHSIL|TALUKA?|MANDAL|SUB[- ]?DISTRICT|FARM HOUSE|FARMS"
URBAN = "APARTMENT|CHOWK|COLONY|COMPLEX|DOOR|ENCLAVE|FLAT|GALI|HNO|HOUSE|LANE|MALL|MARG|MARKET|NAGAR|OFFICE|PLOT|RESIDENCE|RESIDENCY|ROAD|SECTOR|SHOP|SHOPPING|SOCIETY|STREET|TOWER|UNIT|WARD"
NO_CITY = "APARTMENT|BEHIND|BESIDE|BUILDING|COLONY|COMPLEX|FLAT|GALI|HNO|HOUSE|LANE|MARG|NAGAR|NEAR|OPP|OPPOSITE|PLOT|RD|ROAD|SHOP|SOCIETY|ST|STREET|TOWER"
#: How the number of a house is written. The edges (no letter or digit beside it) are spelt out, as not every dialect can look around.
_EDGE, _END = r"(?:^|[^A-Z0-9])", r"(?:[^A-Z0-9]|$)"
PREMISE = (
    EDGE + r"H\.?\s*N\.?\s*O\.?\s*[-:.]?\s*[A-Z0-9][A-Z0-9/-]*" + END,
    EDGE + rf"(?:{NUMBERED.replace(' ', '|')})\s*(?:NO|NUMBER)?\s*[-:.]?\s*[A-Z0-9][A-Z0-9/-]*" + END,
    rf"{_EDGE}[A-Z]{{1,3}}\s*-\s*\p{{Nd}}{{1,6}}[A-Z0-9/-]*{_END}",
    rf"{_EDGE}[A-Z]{{1,4}}\s*-\s*\p{{Nd}}{{1,6}}(?:/[A-Z]{{1,4}}\s*-\s*\p{{Nd}}{{1,6}})+",
    rf"{_EDGE}\p{{Nd}}{{1,6}}\s*/\s*\p{{Nd}}{{1,6}}(?:\s*/\s*\p{{Nd}}{{1,6}})?{_END}",
    rf"{_EDGE}\p{{Nd}}{{1,6}}[A-Z](?:[-/]\p{{Nd}}{{1,6}}[A-Z0-9]*)?{_END}",
    r"^\s*\p{Nd}{1,6}\s*[, -]",
    r"^\s*\p{Nd}{1,6}\s+[A-Z]",
)


def word_pattern(kind: str) -> str:
    """Any of the words of a kind, as a whole word."""
    return f"{EDGE}(?:{'|'.join([*WORDS[kind].split(), *PHRASES.get(kind, ())])}){END}"


def labelled(c: Column, kind: str) -> Column:
    """The name behind the first label of a kind that has one, up to a comma or semicolon; '' without one."""
    t = text(c)
    found = [F.nullif(text(F.regexp_extract(t, "(?i)" + EDGE + label + NAME, 1)), F.lit("")) for label in LABELLED[kind]]
    return F.coalesce(*found, F.lit(""))


def segments(c: Column) -> Column:
    """The pieces of an address between commas and semicolons, in order, blank ones left out."""
    pieces = F.transform(F.split(F.replace(collapsed(c), F.lit(";"), F.lit(",")), ","), lambda x: F.trim(x))
    return F.filter(pieces, lambda x: x != "")


def has(c: Column, kind: str) -> Column:
    """Whether the text shows a building, street, locality or anchor."""
    return F.upper(text(c)).rlike(word_pattern(kind))


def has_premise(c: Column) -> Column:
    t = F.upper(text(c))
    out = F.lit(False)
    for p in PREMISE:
        out = out | t.rlike(p)
    return out


def address_type(c: Column) -> Column:
    """RURAL, URBAN or UNKNOWN by marker words; rural ones win."""
    t = text(c)
    return F.when(t.rlike(f"(?i){EDGE}(?:{RURAL}){END}"), "RURAL").when(t.rlike(f"(?i){EDGE}(?:{URBAN}){END}"), "URBAN").otherwise("UNKNOWN")


def may_be_city(c: Column, state: Column, pin: Column) -> Column:
    """Whether a piece may name a city: no placeholder, PIN, state, premise or road word, not only digits. State and PIN are in their
    forms for matching."""
    return _may_be_city(for_matching(c), state, pin)


def _may_be_city(m: Column, state: Column, pin: Column) -> Column:
    return (m != "") & ~m.isin(*PLACEHOLDERS) & (m != pin) & (m != state) & ~m.rlike(rf"\b(?:{NO_CITY})\b") & ~m.rlike(r"\A[0-9]+\z")


def _cities(pieces: Column, state: Column, pin: Column) -> Column:
    """Those of the pieces that may name a city. Each piece is brought to its form for matching once, in an array of its own."""
    both = F.transform(pieces, lambda x: F.struct(x.alias("shown"), for_matching(x).alias("m")))
    return F.transform(F.filter(both, lambda x: _may_be_city(x["m"], state, pin)), lambda x: x["shown"])


def may_be_place(c: Column, city: Column, state: Column) -> Column:
    """Whether a segment may name a village or office: up to 80 letters, no PIN, neither the row's state nor its city."""
    t = entity(c)
    return (t != "") & (F.length(t) <= 80) & ~t.rlike(r"\A[0-9]{6}\z") & (t != resolver_state(state)) & ~((text(city) != "") & (t == entity(city)))


def state_in_text(c: Column) -> Column:
    """The canonical name of the last state spelling in a text, '' without one."""
    longest = sorted(STATES_IN_TEXT, key=lambda s: (-len(s), s))
    found = F.regexp_extract_all(for_matching(c), F.lit(rf"\b(?:{'|'.join(longest)})\b"), F.lit(0))
    table = F.create_map(*[F.lit(x) for kv in sorted(STATES_IN_TEXT.items()) for x in kv])
    return F.coalesce(F.try_element_at(table, F.try_element_at(found, F.lit(-1))), F.lit(""))


def state_forms(state: Column) -> Column:
    """A pattern of all spellings of a canonical state, the state itself included."""
    by: dict[str, list[str]] = {}
    for s, name in STATES_IN_TEXT.items():
        by.setdefault(name, []).append(s)
    table = F.create_map(*[F.lit(x) for name in sorted(by) for x in (name, "|".join(sorted({*by[name], name}, key=lambda s: (-len(s), s))))])
    return F.concat(F.lit(r"\b(?:"), F.coalesce(F.try_element_at(table, state), state), F.lit(r")\b"))


def without_state(c: Column, state: Column) -> Column:
    """The text for matching without any spelling of the (canonical) state; only its form for matching if there is none."""
    t = for_matching(c)
    return F.when(state == "", t).otherwise(F.trim(F.regexp_replace(F.regexp_replace(t, state_forms(state), F.lit(" ")), " +", " ")))


def without_pin(c: Column, pin: Column) -> Column:
    """The text with the PIN, where it is no part of a longer number, replaced by a blank."""
    return F.when(pin == "", c).otherwise(F.regexp_replace(c, F.concat(F.lit(r"(?<!\p{Nd})"), pin, F.lit(r"(?!\p{Nd})")), F.lit(" ")))


def without_metadata(c: Column, state: Column, pin: Column) -> Column:
    """The clean text without its PIN and, if a state is given, without the state (which takes all punctuation along)."""
    t = without_pin(clean_text(c), pin)
    t = F.when(state == "", t).otherwise(without_state(t, state))
    return F.regexp_replace(F.regexp_replace(t, f"{WS}+", " "), r"\A[ ,]+|[ ,]+\z", "")


def without_pin_segments(c: Column, pin: Column) -> Column:
    """The clean text without the pieces that are nothing but the PIN."""
    t = clean_text(c)
    pieces = F.transform(F.split(t, ","), lambda x: F.trim(x))
    return F.when(pin == "", t).otherwise(F.array_join(F.filter(pieces, lambda x: (x != "") & (for_matching(x) != pin)), ","))


def city_by_segment(c: Column, state: Column, pin: Column) -> Column:
    """The right-most piece that may be a city once PIN and state are gone, '' without one."""

    def bare(x: Column) -> Column:
        t = without_pin(clean_text(x), pin)
        t = F.when(state == "", t).otherwise(without_state(t, state))
        return F.regexp_replace(F.regexp_replace(t, f"{WS}+", " "), r"\A[ ,/-]+|[ ,/-]+\z", "")

    pieces = F.transform(F.filter(F.split(clean_text(c), ","), lambda x: x != ""), bare)
    return F.coalesce(F.try_element_at(_cities(pieces, state, pin), F.lit(-1)), F.lit(""))


def city_by_suffix(c: Column, state: Column, pin: Column) -> Column:
    """The shortest run of one to four last words that may be a city, '' without one."""
    words = F.split(without_metadata(c, state, pin), " ")
    tails = F.transform(F.sequence(F.lit(1), F.least(F.lit(4), F.size(words))), lambda n: F.array_join(F.slice(words, -n, n), " "))
    return F.coalesce(F.try_element_at(_cities(tails, state, pin), F.lit(1)), F.lit(""))


def first_of_repeats(c: Column, name: Column, least: int) -> Column:
    """The clean text with every later occurrence of a name of at least `least` letters blanked if there are two or more."""
    t = clean_text(c)
    n = for_matching(name)
    pattern = F.concat(F.lit(r"\b"), F.replace(n, F.lit(" "), F.lit(r"\s+")), F.lit(r"\b"))
    many = (F.length(n) >= least) & (F.size(F.regexp_extract_all(for_matching(t), pattern, F.lit(0))) >= 2)
    at = F.regexp_instr(t, pattern)
    head = F.substring(t, F.lit(1), at + F.length(F.regexp_substr(t, pattern)) - 1)
    tail = F.substring(t, at + F.length(F.regexp_substr(t, pattern)), F.length(t))
    return clean_text(F.when(many & (at > 0), F.concat(head, F.regexp_replace(tail, pattern, F.lit(" ")))).otherwise(t))


__all__ = ["address_type", "city_by_segment", "city_by_suffix", "first_of_repeats", "has", "has_premise", "labelled", "last_pin", "may_be_city", "may_be_place", "segments", "state_in_text", "without_metadata", "without_pin_segments", "without_state"]
