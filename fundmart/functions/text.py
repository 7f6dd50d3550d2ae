"""Text, list and label columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundmart.texts import UNKNOWN_LABEL

LIST_SEPARATOR = ","


# Fixed value: Unicode white space. ``trim`` alone only knows the space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def clean(text: Column) -> Column:
    """Strip white space at both ends; empty -> null."""
    return F.nullif(F.btrim(text, F.lit(WHITE_SPACE)), F.lit(""))


def is_blank(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE + "\x1c\x1d\x1e\x1f")) == ""


def normalise_codes(text: Column) -> Column:
    """Code list in one notation: lower case, no white space, sorted, no empties.

    Repeats stay: they surface later as a duplicate key of the status bridge.
    """
    bare = F.translate(F.lower(text), WHITE_SPACE, "")
    codes = F.sort_array(F.array_remove(F.split(bare, LIST_SEPARATOR), ""))
    return F.nullif(F.array_join(codes, LIST_SEPARATOR), F.lit(""))


def code_array(text: Column) -> Column:
    return F.split(text, LIST_SEPARATOR)


def lacks_code(text: Column, code: str) -> Column:
    """True when the list does not hold ``code``; an empty list does not."""
    return F.coalesce(~F.array_contains(code_array(text), code), F.lit(True))


def label(template: str, *columns: str) -> Column:
    """Fill the ``{}`` places of a template; a missing value reads ``onbekend``."""
    pieces = template.split("{}")
    if len(pieces) != len(columns) + 1:
        raise ValueError(f"Template {template!r} needs {len(pieces) - 1} columns")
    parts: list[Column] = [F.lit(pieces[0])]
    for name, piece in zip(columns, pieces[1:]):
        parts += [F.coalesce(F.col(name).cast("string"), F.lit(UNKNOWN_LABEL)), F.lit(piece)]
    return F.concat(*parts).alias("label")


def first_filled(*columns: str) -> Column:
    """Key from the first filled column (person number, else education number)."""
    return F.coalesce(*[F.col(c) for c in columns])


def share(part: str, whole: str) -> Column:
    return F.col(part) / F.col(whole)
