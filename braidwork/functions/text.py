"""Cleaning, key minting and number text as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cells that mean "missing", compared without case after trimming.
PLACEHOLDERS = ("na", "n/a", "null", "none", "--", "unknown", "not reported", "not available", "'--")

# The characters that count as white space at the ends of a cell.
ASCII_WHITE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"
WHITE = ASCII_WHITE + "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def blank(c: Column) -> Column:
    """Text of a cell; null is the empty text."""
    return F.coalesce(c.cast("string"), F.lit(""))


def trimmed(c: Column) -> Column:
    """Text without white space at its ends. No regular expression, and the long list only
    for text beyond ASCII, since Spark copies this into filters and tests of the same cell."""
    text = blank(c)
    return F.when(F.octet_length(text) == F.length(text), F.btrim(text, F.lit(ASCII_WHITE))).otherwise(F.btrim(text, F.lit(WHITE)))


def _missing(text: Column, placeholders) -> Column:
    return F.lower(text).isin(["", *(p.lower() for p in placeholders)])


def scrub(c: Column, placeholders=PLACEHOLDERS) -> Column:
    """Trimmed text; placeholders and null become empty."""
    text = trimmed(c)
    return F.when(_missing(text, placeholders), F.lit("")).otherwise(text) if placeholders else text


def strip_prefix(c: Column, prefix: str | None) -> Column:
    """The text without a literal prefix, where it has it."""
    return c if not prefix else F.when(F.startswith(c, F.lit(prefix)), F.substring(c, F.lit(len(prefix) + 1), F.length(c))).otherwise(c)


def mint_id(parts: list[Column], sep: str = ":", placeholders=PLACEHOLDERS) -> Column:
    """Scrubbed parts joined; empty if any of them is empty. Parts that are scrubbed
    already come with ``placeholders`` None.

    The parts are elements of one array: each is trimmed once, and the expression stays
    small where Spark copies it into a filter, so that the generated code can be compiled.
    """
    if placeholders is None:
        whole = [F.nullif(blank(p), F.lit("")) for p in parts]
        return F.coalesce(F.concat(*[x for p in whole for x in (F.lit(sep), p)][1:]), F.lit(""))
    clean = F.transform(F.array(*[blank(p) for p in parts]), trimmed)
    join = lambda ws: F.when(F.exists(ws, lambda w: _missing(w, placeholders)), F.lit("")).otherwise(F.array_join(ws, sep))
    return F.get(F.transform(F.array(clean), join), F.lit(0))


def fallback_id(parts: list[Column], sep: str = ":", missing: str = "unknown") -> Column:
    """Parts joined, each replaced by ``missing`` where it is null or empty."""
    return F.concat_ws(sep, *[F.coalesce(F.nullif(blank(p), F.lit("")), F.lit(missing)) for p in parts])


def strip_version(c: Column) -> Column:
    """Text before the first dot."""
    return F.split_part(blank(c), F.lit("."), F.lit(1))


def number(c: Column) -> Column:
    """The double that plain decimal text stands for, else null."""
    text = blank(c)
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def is_zero(c: Column) -> Column:
    return F.coalesce(number(c) == 0.0, F.lit(False))


def ratio_text(part: Column, whole: Column) -> Column:
    """part / whole with four decimals; empty unless both are numbers and whole is positive."""
    a, b = number(part), number(whole)
    return F.when((b > 0) & a.isNotNull(), F.call_function("format_number", F.try_divide(a, b), F.lit("0.0000"))).otherwise(F.lit(""))


def platform_code(platform: Column, codes: dict[str, str], missing: str = "unknown") -> Column:
    out = F.lit(missing)
    for name, code in codes.items():
        out = F.when(platform == name, F.lit(code)).otherwise(out)
    return out
