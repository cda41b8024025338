"""Character-level folding shared by parsers: compatibility forms, invisible characters, look-alike letters.

Only a light fold lives here (what a parser needs before it can compare ASCII keywords); deciding which script a
token should be written in is a training-data operator of its own and builds on the same tables.
"""

from __future__ import annotations

import re
import unicodedata

# Capital and small letters of other alphabets whose usual glyph equals a Latin letter's, letter case by letter case (Cyrillic
# capital Te looks like T, its small letter unlike t).
LOOKALIKES = {
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J", "α": "a", "ι": "i", "ν": "v", "ο": "o",
    "ρ": "p", "υ": "u", "ϲ": "c", "ϳ": "j",
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P",
    "С": "C", "Т": "T", "У": "Y", "Ү": "Y", "Х": "X", "Ԁ": "D", "Ԛ": "Q", "Ԝ": "W", "Ԍ": "G", "Ӏ": "I", "Ѵ": "V",
    "а": "a", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "о": "o",
    "р": "p", "с": "c", "у": "y", "ү": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ѵ": "v",
    "ӏ": "l", "ԍ": "g",
    # Armenian
    "Ս": "U", "Տ": "S", "Օ": "O", "Լ": "L", "ա": "w", "հ": "h", "ո": "n", "ս": "u", "օ": "o", "յ": "j", "ց": "g",
    # Cherokee
    "Ꭰ": "D", "Ꭱ": "R", "Ꭲ": "T", "Ꭺ": "A", "Ꭻ": "J", "Ꭼ": "E", "Ꮃ": "W", "Ꮇ": "M", "Ꮋ": "H", "Ꮐ": "G", "Ꮓ": "Z",
    "Ꮖ": "I", "Ꮞ": "4", "Ꮟ": "b", "Ꮢ": "R", "Ꮩ": "V", "Ꮪ": "S", "Ꮮ": "L", "Ꮯ": "C", "Ꮲ": "P", "Ꮶ": "K", "Ᏼ": "B",
    # Lisu, Coptic
    "ꓐ": "B", "ꓑ": "P", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M",
    "ꓠ": "N", "ꓡ": "L", "ꓢ": "S", "ꓣ": "R", "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E",
    "ꓲ": "I", "ꓳ": "O", "ꓴ": "U", "Ⲟ": "O", "ⲟ": "o", "Ⲥ": "C", "ⲥ": "c",
}

# Characters that take no room of their own.
INVISIBLE = "­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ\U000e0000-\U000e0fff"

_DROP = re.compile(f"[{INVISIBLE}]")
_LOOK = str.maketrans(LOOKALIKES)
_ASCII = re.compile(r"[\x00-\x7f]*\Z")


def fold(text: str) -> str:
    """ASCII-leaning form for keyword matching: NFKC, no invisibles, look-alikes as Latin, Latin accents dropped, decimal digits 0-9.

    Devanagari letters stay as they are; `None` is not accepted (callers pass '')."""
    if text.isascii():
        return text
    t = unicodedata.normalize("NFKD", _DROP.sub("", text).translate(_LOOK))
    out = []
    for ch in t:
        if ch.isascii():
            out.append(ch)
        elif unicodedata.combining(ch):
            if out and not out[-1].isascii():
                out.append(ch)
        elif (d := unicodedata.decimal(ch, None)) is not None:
            out.append(str(d))
        elif unicodedata.category(ch) == "Zs":
            out.append(" ")
        else:
            out.append(ch)
    return "".join(out)


def fold_with_offsets(text: str) -> tuple[str, list[int]]:
    """`fold(text).upper()` made character by character, and for each of its characters the place in `text` it comes from (with the length
    of `text` behind the last)."""
    out: list[str] = []
    places: list[int] = []
    for i, source in enumerate(text):
        for ch in unicodedata.normalize("NFKD", _DROP.sub("", source).translate(_LOOK)):
            if ch.isascii():
                new = ch
            elif unicodedata.combining(ch):
                new = ch if out and not out[-1].isascii() else ""
            elif (d := unicodedata.decimal(ch, None)) is not None:
                new = str(d)
            else:
                new = " " if unicodedata.category(ch) == "Zs" else ch
            for up in new.upper():
                out.append(up)
                places.append(i)
    return "".join(out), [*places, len(text)]
