"""Numeric guards and exact rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def safe_int(value: Column) -> Column:
    """NULL and NaN become 0; anything else is cut to a whole number.

    The number itself is cast, so whole numbers beyond 2 ** 53 keep all digits.
    """
    zero = F.lit(0).cast("long")
    return F.when(F.isnan(value.cast("double")), zero).otherwise(
        F.coalesce(value.cast("long"), zero)
    )


def round_half_up(value: Column, digits: int, precision: int = 24) -> Column:
    """Round half away from zero in decimal arithmetic."""
    return value.cast(f"decimal({precision},{digits})")


def exact(value: Column, digits: int = 12) -> Column:
    """Double as a decimal, so that a sum does not depend on row order.

    ``digits`` after the point are kept and 26 before it; smaller parts are rounded.
    """
    return value.cast(f"decimal(38,{digits})")


def likes_ratio(likes: Column, downloads: Column) -> Column:
    """Likes per download to four digits; NULL without downloads."""
    ratio = likes.cast("double") / F.nullif(downloads, F.lit(0).cast("long"))
    return round_half_up(ratio, 4)
