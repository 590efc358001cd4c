"""Periods, trends, returns and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months between neighbouring periods of a kind.
GAP_MONTHS = {"annual": 12, "quarterly": 3, "half_year": 6}
_LABEL = r"(?i)^(?:FY\s*(\d{4}|\d{2})|(\d)[QH]\s*(\d{4}|\d{2}))$"


def period_type(label: Column) -> Column:
    """quarterly with a Q but no FQ, else half_year with an H, else annual."""
    up = F.upper(label)
    quarterly = F.contains(up, F.lit("Q")) & ~F.contains(up, F.lit("FQ"))
    return F.when(quarterly, "quarterly").when(F.contains(up, F.lit("H")), "half_year").otherwise("annual")


def period_key(label: Column) -> Column:
    """(year, part) in order of time; other labels come last, at (9999, 0)."""
    plain = F.trim(label)
    year = F.coalesce(F.nullif(F.regexp_extract(plain, _LABEL, 1), F.lit("")), F.nullif(F.regexp_extract(plain, _LABEL, 3), F.lit(""))).cast("int")
    part = F.coalesce(F.nullif(F.regexp_extract(plain, _LABEL, 2), F.lit("")).cast("int"), F.lit(0))
    full = F.when(year < 100, year + 2000).otherwise(year)
    return F.struct(F.coalesce(full, F.lit(9999)).alias("year"), F.when(year.isNull(), 0).otherwise(part).alias("part"))


def gap_months(kind: Column) -> Column:
    out = F.lit(12)
    for name, months in GAP_MONTHS.items():
        out = F.when(kind == name, F.lit(months)).otherwise(out)
    return out


def change_pct(before: Column, after: Column) -> Column:
    """Change in per cent of the absolute earlier value, two digits; 0 from zero."""
    return F.when(before == 0, F.lit(0.0)).otherwise(F.round((after - before) / F.abs(before) * 100, 2))


def direction(pct: Column, band: float = 1.0) -> Column:
    return F.when(pct > band, "up").when(pct < -band, "down").otherwise("flat")


def reliability_score(
    n_hits: Column, tier: Column, title_hit: Column, weight: float = 1.0, saturation: int = 10, boost: float = 1.5, cap: int | None = 100
) -> Column:
    """Whole number: tier times the saturated share of hits, boosted if the title
    has a priority keyword, times 100, clamped to ``cap`` if there is one."""
    ratio = F.least(n_hits / F.lit(float(saturation)), F.lit(1.0))
    score = (tier * ratio * F.when(title_hit, boost).otherwise(1.0) * weight * 100).cast("int")
    return score if cap is None else F.least(score, F.lit(cap))


def magnitude(total: Column) -> Column:
    return F.when(total >= 40, "strong").when(total >= 30, "moderate").otherwise("slight")


def backoff_seconds(attempt: Column, initial: float = 1.0, base: float = 2.0, most: float = 60.0) -> Column:
    return F.least(initial * F.pow(F.lit(base), attempt - 1), F.lit(most))
