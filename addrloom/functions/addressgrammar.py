"""Token scanner for free-form postal addresses: one left-to-right pass, no backtracking, no directory look-ups.

`scan(text)` returns the components in order of appearance as (kind, value, start, end) with kinds
``house`` ("31E"), ``flat`` ("A1301" = wing + number), ``street`` ("SIKAAN STREET", "6 CROSS"), ``locality``
("HUPIRAAN EXTENSION", "THEYABELAN SECTOR 35", "TARVESPHUI ENCLAVE 2"), ``pin`` and ``word`` (what is left over: town and
state names, building and landmark words). Names keep their spelling; only the type words are canonical.
"""

from __future__ import annotations

import re

from .charforms import fold

# Spellings of the type words.
STREET_TYPES = {
    "STREET": ("STREET", "ST", "STR"), "ROAD": ("ROAD", "RD"), "LANE": ("LANE", "LN"), "GALI": ("GALI", "GALLI", "GALLY"),
    "MARG": ("MARG", "MRG"), "PATH": ("PATH", "PTH"), "CROSS": ("CROSS", "CRS"), "MAIN": ("MAIN", "MN"),
}
LOCALITY_TYPES = {
    "NAGAR": ("NAGAR", "NGR", "NAGER"), "COLONY": ("COLONY", "COL", "CLNY"), "ENCLAVE": ("ENCLAVE", "ENC", "ENCL"),
    "LAYOUT": ("LAYOUT", "LYT"), "EXTENSION": ("EXTENSION", "EXT", "EXTN"), "VIHAR": ("VIHAR", "VHR", "VIHAAR"),
    "GARDENS": ("GARDENS", "GDNS", "GARDEN", "GDN"), "BAZAR": ("BAZAR", "BZR", "BAZAAR"),
    "SECTOR": ("SECTOR", "SEC", "SECT"), "BASTI": ("BASTI",), "PARK": ("PARK",),
}
BUILDING_TYPES = {
    "APARTMENTS": ("APARTMENTS", "APARTMENT", "APTS", "APT", "APPTS", "APPT"), "HEIGHTS": ("HEIGHTS", "HEIGHT", "HTS", "HT"),
    "TOWERS": ("TOWERS", "TOWER", "TWRS", "TWR"), "RESIDENCY": ("RESIDENCY", "RESI"), "SOCIETY": ("SOCIETY", "SOC"),
    "COMPLEX": ("COMPLEX", "CPLX", "COMPLX"),
}
FLAT_WORDS = {"FLAT", "FLT", "UNIT"}
HOUSE_WORDS = {"HNO", "HOUSE", "DOOR", "PLOT", "NO", "H", "DNO"}
LANDMARK_WORDS = {"NEAR", "NR", "OPP", "OPPOSITE", "BEHIND", "BH"}
ROMAN = {"I": 1, "II": 2, "III": 3, "IV": 4, "V": 5, "VI": 6, "VII": 7, "VIII": 8, "IX": 9, "X": 10}

_KIND: dict[str, tuple[str, str]] = {}
for _kind, _table in (("street", STREET_TYPES), ("locality", LOCALITY_TYPES), ("building", BUILDING_TYPES)):
    for _canon, _forms in _table.items():
        for _f in _forms:
            _KIND[_f] = (_kind, _canon)
_GLUE = re.compile(r"([A-Z]{4,}?)(%s)\Z" % "|".join(sorted((f for f in _KIND if len(f) > 1 and f not in ("MAIN", "CROSS", "MN", "CRS", "PARK")), key=len, reverse=True)))
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\n|[^\w\s]+|_")
_KEYS = {k for k in _KIND} | FLAT_WORDS | HOUSE_WORDS | LANDMARK_WORDS | {"PHASE", "PH", "WING", "LAY", "OUT", "LATE", "PIN"}


def _near(word: str) -> set[str]:
    n = len(word)
    return {word[:i] + word[i + 1 :] for i in range(n)} | {word[:i] + word[i + 1] + word[i] + word[i + 2 :] for i in range(n - 1)}


#: Misspelt type words: one deletion, doubling, exchange or replacement away from a word of five letters or more.
_MISSPELT: dict[str, str] = {}
_WILD: dict[str, str] = {}
for _f in sorted(_KEYS):
    if len(_f) >= 5:
        for _x in _near(_f):
            if len(_x) >= 4 and _x not in _KEYS:
                _MISSPELT.setdefault(_x, _f)
        for _i in range(len(_f)):
            _WILD.setdefault(_f[:_i] + "?" + _f[_i + 1 :], _f)
_CACHE: dict[str, str | None] = {}


def key_word(word: str) -> str | None:
    """The type or marker word that `word` spells, allowing one slip in words of five letters or more; None if it is a name."""
    if word in _KEYS:
        return word
    if len(word) < 4:
        return None
    hit = _CACHE.get(word, 0)
    if hit == 0:
        hit = _MISSPELT.get(word)
        if not hit:
            for i in range(len(word)):  # one letter more or another letter
                if (w := word[:i] + word[i + 1 :]) in _KEYS and len(w) >= 5 or (w := _WILD.get(word[:i] + "?" + word[i + 1 :])):
                    hit = w
                    break
        if len(_CACHE) < 200_000:
            _CACHE[word] = hit or None
    return hit or None


def _number(tok: str) -> str | None:
    return (tok.lstrip("0") or "0") if tok.isdigit() else None


def scan(text: str) -> list[tuple[str, str, int, int]]:
    """Components of `text` in order; an empty text has none. Offsets are those of the folded, upper-cased text, see `prepared`."""
    return scan_prepared(prepared(text))


def prepared(text: str) -> str:
    """Folded upper-case text that `scan` works on; line breaks stay."""
    return fold(text).upper()


def scan_prepared(t: str) -> list[tuple[str, str, int, int]]:
    toks = [(m.group(), m.start(), m.end()) for m in _TOKEN.finditer(t)]
    out: list[tuple[str, str, int, int]] = []
    n, i = len(toks), 0
    name: tuple[str, int] | None = None  # the name that a type word may follow

    def spell(j: int) -> str:
        return toks[j][0] if j < n else ""

    def skip(j: int, marks: str) -> int:
        while j < n and toks[j][0] in marks and toks[j][0] != "":
            j += 1
        return j

    while i < n:
        w, s, e = toks[i]
        if w.isdigit():
            nxt = spell(i + 1)
            if nxt[:1] == ")" and len(w) <= 2 and not (i and toks[i - 1][0][-1] == "("):  # a list mark: 1)
                i += 2
                continue
            # ordinal street: 6 TH CROSS, 10TH X, 3 RD MAIN RD
            if nxt in ("ST", "ND", "RD", "TH") and len(w) <= 3:
                k = spell(i + 2)
                kk = "CROSS" if k == "X" else (_KIND.get(key_word(k) or "", ("", ""))[1] if k else "")
                if kk in ("CROSS", "MAIN"):
                    end = toks[i + 2][2]
                    i += 3
                    if spell(i) in ("RD", "ROAD") and toks[i][1] - end <= 2:
                        end = toks[i][2]
                        i += 1
                    out.append(("street", f"{int(w)} {kk}", s, end))
                    name = None
                    continue
            if len(w) == 6 and w[0] != "0":
                out.append(("pin", w, s, e))
                i += 1
                name = None
                continue
            if len(w) == 3 and w[0] != "0" and nxt.isdigit() and len(nxt) == 3 and toks[i + 1][1] - e <= 1 and out:
                out.append(("pin", w + nxt, s, toks[i + 1][2]))
                i += 2
                name = None
                continue
            if len(w) <= 4 and w.strip("0"):  # a bare number is the house
                i = _house(toks, i, s, out)
                name = None
                continue
            out.append(("word", w, s, e))
            i += 1
            name = None
            continue
        if not w[0].isalpha():
            if w[0] == "#" and spell(i + 1).isdigit() and len(spell(i + 1)) <= 4 and w == "#":
                i = _house(toks, i + 1, s, out)
                name = None
                continue
            i += 1
            continue
        k = key_word(w)
        if k is None:
            if w == "ADD" and spell(i + 1).isdigit() and spell(i + 2)[:1] in (":", "-"):  # a label: ADD1:
                i += 3
                continue
            if len(w) == 1 and spell(i + 1) == "/" and spell(i + 2) == "O" and w in "CSWD":
                # care of: the name that follows belongs to no component
                i += 3
                if spell(i) == "LATE":
                    i += 1
                if i < n and toks[i][0].isalpha() and key_word(toks[i][0]) is None:
                    i += 1
                name = None
                continue
            if len(w) == 1 and spell(i + 1) == "/" and spell(i + 2) == "H" and w == "B":
                i += 3
                name = None
                continue
            if w == "F":  # F NO 1205
                j = skip(i + 1, ".-")
                if spell(j) == "NO":
                    j2 = _flat(toks, skip(j + 1, ".-"), s, out)
                    if j2:
                        i, name = j2, None
                        continue
            if len(w) >= 7 and w.endswith("LAY") and spell(i + 1) == "OUT":
                i = _typed(toks, i + 1, w[:-3], s, ("locality", "LAYOUT"), out)
                name = None
                continue
            g = _GLUE.match(w) if len(w) >= 6 and _KIND.get(key_word(spell(i + 1)) or "") is None and spell(i + 1) != "LAY" else None
            if g and key_word(g.group(1)) is None and _KIND[g.group(2)][0] != "building":
                i = _typed(toks, i, g.group(1), s, _KIND[g.group(2)], out)
                name = None
                continue
            out.append(("word", w, s, e))
            name = (w, s)
            i += 1
            continue
        if k in FLAT_WORDS:
            j = skip(i + 1, ".-")
            if spell(j) == "NO":
                j = skip(j + 1, ".-")
            j2 = _flat(toks, j, s, out)
            if j2:
                i, name = j2, None
                continue
            i += 1
            continue
        if k == "LAY" and spell(i + 1) == "OUT" and name:
            if out and out[-1][0] == "word":
                out.pop()
            i = _typed(toks, i + 1, name[0], name[1], ("locality", "LAYOUT"), out)
            name = None
            continue
        if k in HOUSE_WORDS:
            j = skip(i + 1, ".-")
            if k != "NO" and spell(j) == "NO":
                j = skip(j + 1, ".-")
            if spell(j).isdigit() and len(spell(j)) <= 4 and not (spell(j + 1) in ("ST", "ND", "RD", "TH") and spell(j + 2) in ("CROSS", "MAIN", "CRS", "MN", "X")):
                i = _house(toks, j, s, out)
                name = None
                continue
            i += 1
            continue
        if k in _KIND and name:
            if out and out[-1][0] == "word":
                out.pop()
            i = _typed(toks, i, name[0], name[1], _KIND[k], out)
            name = None
            continue
        if k in LANDMARK_WORDS or k == "LATE":
            name = None
        i += 1
    return out


def _house(toks: list, i: int, start: int, out: list) -> int:
    """The house whose number is token i, with its letter."""
    w, _, e = toks[i]
    num, j, letter = _number(w), i + 1, ""
    if j < len(toks):
        k = j + 1 if toks[j][0] in ("-", "/") and j + 1 < len(toks) else j
        x = toks[k][0]
        if len(x) == 1 and x.isalpha() and x.isascii() and not (k + 1 < len(toks) and toks[k + 1][0] in ("WING", "/", "NO")) and not (x == "H" and k + 1 < len(toks) and toks[k + 1][0] == "-" and k + 2 < len(toks) and toks[k + 2][0].isdigit()):
            letter, e, j = x, toks[k][2], k + 1
    out.append(("house", num + letter, start, e))
    return j


def _flat(toks: list, j: int, start: int, out: list) -> int:
    """The flat whose number or wing is token j; 0 if there is none."""
    n, wing = len(toks), ""
    if j < n and len(toks[j][0]) == 1 and toks[j][0].isalpha():
        wing = toks[j][0]
        j += 1
        while j < n and toks[j][0] in ("-", "/"):
            j += 1
    if j >= n or not toks[j][0].isdigit() or len(toks[j][0]) > 4:
        return 0
    num, e = _number(toks[j][0]), toks[j][2]
    j += 1
    if not wing and j < n:
        k = j + 1 if toks[j][0] in ("-", "/", ",") and j + 1 < n else j
        x = toks[k][0]
        y = toks[k + 1][0] if k + 1 < n else ""
        if x == "WING" and len(y) == 1 and y.isalpha():
            wing, e, j = y, toks[k + 1][2], k + 2
        elif len(x) == 1 and x.isalpha() and y == "WING":
            wing, e, j = x, toks[k + 1][2], k + 2
        elif k == j and len(x) == 1 and x.isalpha() and toks[k][1] == e:
            wing, e, j = x, toks[k][2], k + 1
    out.append(("flat", wing + num, start, e))
    return j


def _typed(toks: list, i: int, name: str, start: int, kind: tuple[str, str], out: list) -> int:
    """The street, locality or building of this name whose type word is token i (for a locality, with its number)."""
    n, e, j, num = len(toks), toks[i][2], i + 1, ""
    if kind[0] == "locality":
        k = j
        while k < n and toks[k][0] in (".", "-", ",", ".,", ".-") and k - j < 2:
            k += 1
        if kind[1] == "SECTOR":
            while k < n and toks[k][0] in (".", "-"):
                k += 1
            num = _ordinal(toks, k)
            if num:
                e, j = toks[k][2], k + 1
        if k < n and key_word(toks[k][0]) in ("PHASE", "PH"):
            k += 1
            while k < n and toks[k][0] in (".", "-", ".-"):
                k += 1
            if p := _ordinal(toks, k):
                num, e, j = num + ("/" + p if num else p), toks[k][2], k + 1
    out.append((kind[0], f"{name} {kind[1]}" + (f" {num}" if num else ""), start, e))
    return j


def _ordinal(toks: list, k: int) -> str:
    if k >= len(toks):
        return ""
    x = toks[k][0]
    if x.isdigit() and len(x) <= 3:
        return str(int(x))
    return str(ROMAN[x]) if x in ROMAN else ""
