"""Identifiers linked from a listing page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where paper links point and what a paper id looks like.
PAPER_MARKER = "/papers/"
PAPER_ID = r"^\d{4}\.\d{5}$"

_NOT_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_ANCHOR_HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def anchor_targets(html: Column) -> Column:
    """Every ``href`` of an ``<a>``, in page order; comments and scripts are skipped."""
    markup = F.regexp_replace(html, _NOT_MARKUP, "")
    quoted = F.regexp_extract_all(markup, F.lit(_ANCHOR_HREF), F.lit(1))
    return F.transform(quoted, lambda q: F.regexp_replace(q, "^[\"']|[\"']$", ""))


def linked_ids(html: Column, marker: str = PAPER_MARKER, id_pattern: str = PAPER_ID) -> Column:
    """Distinct ids in page order, read after the last ``marker`` of each link."""
    wanted = F.filter(
        anchor_targets(html), lambda h: F.contains(h, F.lit(marker)) & ~h.endswith(marker)
    )
    tails = F.transform(
        wanted, lambda h: F.btrim(F.substring_index(h, marker, -1), F.lit("/"))
    )
    return F.array_distinct(F.filter(tails, lambda t: t.rlike(id_pattern)))
