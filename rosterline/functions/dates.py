"""Typed coercion of text cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterline.specs import DATE_PATTERNS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: str | Column, patterns: tuple[str, ...] = DATE_PATTERNS, latest: Column | None = None) -> Column:
    """First pattern that parses wins; unparseable → null.

    Two-digit years parse into 20xx; where ``latest`` is given, a result after it moves back 100 years, so a birth date
    written ``17/05/85`` becomes 1985.  Without it (start and end dates) a future date stays.
    """
    c = _col(c)
    parsed = []
    for p in patterns:
        d = F.try_to_date(c, p)
        if latest is not None and "yy" in p and "yyyy" not in p:
            d = F.when(d > latest, F.add_months(d, -1200)).otherwise(d)
        parsed.append(d)
    return F.coalesce(*parsed)


def to_number(c: str | Column) -> Column:
    """Text → DOUBLE; anything unparseable (and NaN) → null."""
    x = _col(c).try_cast("double")
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def year_start(c: str | Column) -> Column:
    """``YYYY-01-01`` from the first run of four digits in the text, null if there is none."""
    y = F.regexp_extract(_col(c), r"(\d{4})", 1)
    return F.concat(F.nullif(y, F.lit("")), F.lit("-01-01"))
