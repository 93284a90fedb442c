"""Text clean-up and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything that counts as white space at the ends of a name.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_to_null(text: Column) -> Column:
    """Trim any white space from both ends; nothing left means NULL."""
    return F.nullif(F.btrim(text, F.lit(WHITE_SPACE)), F.lit(""))


def blank_to_null(text: Column) -> Column:
    """Trim plain blanks only, as SQL ``TRIM`` does; empty means NULL."""
    return F.nullif(F.trim(text), F.lit(""))


def default_label(text: Column, label: str) -> Column:
    return F.coalesce(text, F.lit(label))


def modification_label(modification: Column) -> Column:
    """Upper-case label with ``ORIGINAL`` for models that modify nothing."""
    return default_label(blank_to_null(F.upper(modification)), "ORIGINAL")


def slug(name: Column) -> Column:
    """Dictionary entry as it is written in a tag: lower case, hyphenated."""
    return F.lower(F.replace(name, F.lit(" "), F.lit("-")))


def sorted_join(items: Column) -> Column:
    """Comma-joined values in code-point order; an empty list is NULL."""
    return F.nullif(F.array_join(F.sort_array(items), ","), F.lit(""))


def not_blank(text: Column, drop_null: bool = True, drop_empty: bool = True) -> Column:
    """Presence predicate.

    Stores disagree on what counts as missing: dropping NULL only, the empty
    string only, or both.  The default drops both.
    """
    keep_empty = F.lit(True) if not drop_empty else F.coalesce(text != "", F.lit(True))
    return (text.isNotNull() & keep_empty) if drop_null else keep_empty
