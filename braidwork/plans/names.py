"""Finding the raw column of a property from header names. Driver side, names only.

A file's headers are turned once into a list of claims: a claim says that a column answers
to a name, how it came by that name, and its place in the header. Looking a property up is
the least claim, by kind and then by place, among those that answer to it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from enum import IntEnum


class By(IntEnum):
    """How a column comes by a name, the surest first."""

    CHOICE = 0  # the binding names the column
    RENAME = 1  # an alias of the binding or its profile
    COMMON_RENAME = 2  # an alias that all profiles share
    CAMEL = 3  # the header in camel case
    LETTERS = 4  # letters and digits alone, without case
    LAST_PART = 5  # the part after the last dot, in camel case
    LAST_LETTERS = 6  # the letters of that part


#: Kinds whose names are compared by their letters and digits alone.
LOOSE = (By.LETTERS, By.LAST_LETTERS)
_EDGE = re.compile(r"[^0-9A-Za-z]+(.)?")


def camel(name: str) -> str:
    """first_word and First.word become firstWord; inner capitals stay."""
    joined = _EDGE.sub(lambda m: (m[1] or "").upper(), name)
    return joined[:1].lower() + joined[1:]


def plain(name: str) -> str:
    return "".join(ch for ch in name.lower() if ch in "0123456789abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True, order=True)
class Claim:
    by: By
    place: int
    column: str
    name: str


@dataclass(frozen=True)
class Match:
    column: str | None
    strategy: str


class Columns:
    """The claims of one file's headers, and look-ups among them."""

    def __init__(self, headers, choices=None, aliases=None, profile_aliases=None, common_aliases=None, prefixes=()):
        self.headers = list(headers)
        renames = {**(profile_aliases or {}), **(aliases or {})}  # for one column the binding's alias counts, at the profile's place
        claims = self._listed([(c, p) for p, c in (choices or {}).items()], By.CHOICE) + self._listed(renames.items(), By.RENAME)
        claims += self._unclaimed(claims, common_aliases)
        claims += self._read_from_headers(prefixes)
        self._best: dict[tuple[bool, str], Claim] = {}
        self.collisions: dict[str, list[str]] = {}
        for c in sorted(claims, key=lambda c: (c.by, c.place)):
            self._best.setdefault((c.by in LOOSE, c.name), c)
            if c.by == By.CAMEL and c.column not in self.collisions.setdefault(c.name, []):
                self.collisions[c.name].append(c.column)
        self.collisions = {name: columns for name, columns in self.collisions.items() if len(columns) > 1}

    def _listed(self, pairs, by: By) -> list[Claim]:
        """Claims of (column, name) pairs whose column is here; the place is the pair's."""
        return [Claim(by, k, column, name) for k, (column, name) in enumerate(pairs) if column in self.headers]

    def _unclaimed(self, claims: list[Claim], common) -> list[Claim]:
        """Shared aliases of the columns that no own alias has put to use."""
        firsts: dict[str, str] = {}
        for c in claims:
            if c.by == By.RENAME:
                firsts.setdefault(c.name, c.column)
        return [c for c in self._listed((common or {}).items(), By.COMMON_RENAME) if c.column not in firsts.values()]

    def _read_from_headers(self, prefixes) -> Iterator[Claim]:
        n = len(self.headers)
        for k, h in enumerate(self.headers):
            # Whole headers come before those that lose a prefix.
            cut = [h[len(p) :] for p in prefixes if p and h.startswith(p) and h != p]
            for place, form in [(k, h), *((n + k, c) for c in cut)]:
                yield from (Claim(by, place, h, name) for by, name in ((By.CAMEL, camel(form)), (By.LETTERS, plain(form))) if name)
            if "." in h:
                tail = h.split(".")[-1]
                yield from (Claim(by, k, h, name) for by, name in ((By.LAST_PART, camel(tail)), (By.LAST_LETTERS, plain(tail))) if name)

    def find(self, prop: str) -> Match:
        found = [c for key in ((False, prop), (True, plain(prop))) if (c := self._best.get(key))]
        if not found:
            return Match(None, "unmatched")
        best = min(found)
        return Match(best.column, best.by.name.lower().replace("last_letters", "last_part"))
