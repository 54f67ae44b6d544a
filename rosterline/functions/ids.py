"""Deterministic identifiers.

Generated ids are content hashes rather than random UUIDs: a recomputed task (executor loss, AQE re-plan, a second
action on the same plan) must produce the same id, or two datasets built from one resolution would disagree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uuid_from_text(text: Column) -> Column:
    """md5 of ``text`` laid out as a version-3-shaped UUID string."""
    h = F.md5(text)
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"),
        F.substring(h, 9, 4), F.lit("-3"),
        F.substring(h, 14, 3), F.lit("-8"),
        F.substring(h, 18, 3), F.lit("-"),
        F.substring(h, 21, 12),
    )


def row_suffix(text: Column, digits: int = 32) -> Column:
    """``x`` and the first ``digits`` hex digits of md5(text): never a plain number, and wide enough for any table."""
    return F.concat(F.lit("x"), F.substring(F.md5(text), 1, digits))
