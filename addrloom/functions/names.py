"""Misspelling-tolerant look-up in a bounded list of names, for use inside Arrow batches."""

from __future__ import annotations

import re

from .charforms import fold

_JUNK = re.compile(r"\([^)]*\)|,.*$|[^A-Z ]")
_WORDS = re.compile(r"^(?:CITY|DIST|DISTRICT|TOWN)\s+|\s+(?:CITY|DIST|DISTRICT|URBAN|TOWN|D)$")

# Spellings that stand for no value.
MISSING = ("", "NA", "N/A", "NAN", "NULL", "NONE", "NIL", "-", "--", "0", "NOT AVAILABLE", "UNKNOWN")


def sounds(name: str) -> str:
    """Spelling by sound: OO as U, EE as I, PH as F."""
    return name.replace("OO", "U").replace("EE", "I").replace("PH", "F")


def bare_name(value: str | None) -> str:
    """A typed place name without case, punctuation and words such as CITY or DIST; '' for a missing one."""
    if value is None:
        return ""
    t = fold(value).upper().strip()
    if t in MISSING:
        return ""
    t = re.sub(r"\s+", " ", _JUNK.sub(" ", t)).strip()
    return _WORDS.sub("", t).strip()


def plain_pin(value: str | None) -> str:
    """Six digits of a PIN once spaces, dashes, a leading PIN and a trailing .0 are gone; '' otherwise."""
    if value is None:
        return ""
    t = re.sub(r"[\s\-]", "", fold(value).upper())
    t = re.sub(r"\.0+$", "", re.sub(r"^PIN[:.]?", "", t))
    return t if len(t) == 6 and t.isdigit() and t.isascii() else ""


def slips(a: str, b: str) -> bool:
    """Whether b is a with one letter dropped, added, replaced or exchanged with its neighbour."""
    if a == b:
        return True
    n, m = len(a), len(b)
    if abs(n - m) > 1:
        return False
    i = 0
    while i < n and i < m and a[i] == b[i]:
        i += 1
    if n == m:
        return a[i + 1 :] == b[i + 1 :] or a[i : i + 2] == b[i + 1 : i + 2] + b[i : i + 1] and a[i + 2 :] == b[i + 2 :]
    return a[i + 1 :] == b[i:] if n > m else a[i:] == b[i + 1 :]


class NameIndex:
    """Names by the forms that one deletion leaves; `find` gives the one name within one slip (two deletions in long ones)."""

    def __init__(self, names: dict[str, str], keep: int = 300_000):
        self.exact = {k: v for k, v in names.items() if k}
        self.by: dict[str, set[str]] = {}
        for n in {sounds(k) for k in self.exact} | set(self.exact):
            for f in self._forms(n):
                self.by.setdefault(f, set()).add(n)
        self.spelt = {sounds(k): v for k, v in self.exact.items()} | self.exact
        self.cache: dict[str, str] = {}
        self.keep = keep

    @staticmethod
    def _forms(w: str) -> set[str]:
        one = {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}
        return one if len(w) < 7 else one | {x[:i] + x[i + 1 :] for x in one for i in range(len(x)) if len(x) < len(w)}

    def find(self, name: str) -> str:
        """The name's canonical form, '' if none or several are equally near."""
        if name in self.exact:
            return self.exact[name]
        hit = self.cache.get(name)
        if hit is None:
            hit = self._look(name)
            if len(self.cache) < self.keep:
                self.cache[name] = hit
        return hit

    def _look(self, name: str) -> str:
        if len(name) < 4:
            return ""
        w = sounds(name)
        if w in self.spelt:
            return self.spelt[w]
        near = {n for f in self._forms(w) for n in self.by.get(f, ())}
        for ok in (lambda n: slips(w, n), lambda n: len(w) >= 7):
            got = {self.spelt[n] for n in near if ok(n)}
            if len(got) == 1:
                return got.pop()
            if got:
                return ""
        return ""
