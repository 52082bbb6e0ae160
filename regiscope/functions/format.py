"""Presentation-side column functions: ISO timestamps, label lookups,
rank tiers, capped percentages and sentences."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def iso_timestamp(c: ColumnOrName) -> Column:
    """Timestamp -> ``yyyy-MM-ddTHH:mm:ss`` string."""
    return F.date_format(_col(c), ISO_FORMAT)


def lookup(c: ColumnOrName, mapping: Mapping, default=None) -> Column:
    """P25: small literal lookup with a default."""
    if not mapping:
        return F.lit(default)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    v = m[_col(c)]
    return v if default is None else F.coalesce(v, F.lit(default))


def yes_no(c: ColumnOrName, yes: str = "Ya", no: str = "Tidak") -> Column:
    """P25 for booleans (fixed labels of the map tooltip)."""
    x = _col(c)
    return F.when(x, F.lit(yes)).when(~x, F.lit(no))


# Rank tiers of the priority list.
TIER_TOP1, TIER_TOP3, TIER_REST = "1", "top", "mid"


def rank_tier(rank: ColumnOrName) -> Column:
    """Rank 1 / rank <= 3 / the rest."""
    r = _col(rank)
    return (F.when(r == 1, F.lit(TIER_TOP1)).when(r <= 3, F.lit(TIER_TOP3))
            .otherwise(F.lit(TIER_REST)))


def capped_percent(score: ColumnOrName, cap: float = 100.0) -> Column:
    """``min(score * 100, cap)``."""
    return F.least(_col(score) * F.lit(100.0), F.lit(cap))


def rounded_percent(x: ColumnOrName) -> Column:
    """``round(x * 100)`` as int, half to even."""
    return F.bround(_col(x) * F.lit(100.0), 0).cast("int")


def plain_number(c: ColumnOrName) -> Column:
    """A value of at most four decimals as shortest text: 0.5, 0.1234, 1.0."""
    return F.regexp_replace(F.format_string("%.4f", _col(c)), r"(\.\d+?)0+$", "$1")


def round_or_null(c: ColumnOrName, digits: int) -> Column:
    """NULL-safe rounding for display frames."""
    return F.round(_col(c), digits)
