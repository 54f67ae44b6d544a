"""Sheet headers: one index of a sheet's headers answers which columns it has, lacks and adds.

A header counts by its normal form: what stands before a line break or an opening parenthesis (format hints), without
outer blanks, in lower case.  The first column of each normal form in sheet order is taken.  Everything here happens
while a plan is built; the data sees one ``select``.
"""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.specs import ROADMAP_COLUMN_RE, DatasetSpec

log = logging.getLogger("rosterline")


def normal_form(header: str) -> str:
    """``TANGGAL LAHIR\\n(DD/MM/YY)`` → ``tanggal lahir``; ``AREA OF DEVELOPMENT (GAP)`` → ``area of development``."""
    return re.split(r"[\n(]", header, maxsplit=1)[0].strip().lower()


@dataclass(frozen=True)
class SheetColumns:
    """found: internal name → sheet column; missing: internal names; unknown: sheet columns nobody asked for."""

    found: dict[str, str]
    missing: tuple[str, ...]
    unknown: tuple[str, ...]


def sheet_columns(columns: list[str], wanted: tuple[tuple[str, str], ...], conformed: bool = False,
                  pattern: re.Pattern | None = ROADMAP_COLUMN_RE) -> SheetColumns:
    """Looks all wanted (internal, header) pairs up in the sheet's columns.

    ``conformed``: the sheet already carries internal names, which then count instead of the headers.  Columns whose
    normal form fits ``pattern`` (one per roadmap year, whichever years a sheet has) are found under that form.
    """
    index: dict[str, str] = {}
    for c in columns:
        index.setdefault(normal_form(c), c)
    asked = {internal: normal_form(internal if conformed else header) for internal, header in wanted}
    if pattern is not None:
        asked |= {form: form for form in index if pattern.match(form)}
    found = {internal: index[form] for internal, form in asked.items() if form in index}
    taken = set(found.values())
    absent = tuple(i for i, form in asked.items() if form not in index and not (pattern and pattern.match(i)))
    return SheetColumns(found, absent, tuple(c for c in columns if c not in taken))


def conform_headers(df: DataFrame, wanted: tuple[tuple[str, str], ...], context: str = "", extra: tuple[str, ...] = ("row_id",),
                    required: tuple[str, ...] = (), conformed: bool = False) -> DataFrame:
    """The sheet with internal names: found columns and ``extra`` ones; a missing ``required`` column is an error."""
    sheet = sheet_columns(df.columns, wanted, conformed)
    lacking = [i for i in required if i not in sheet.found]
    if lacking:
        raise ValueError(f"{context or 'sheet'}: required columns {lacking} not found; it has {df.columns}")
    if sheet.missing:
        log.info("%s: columns not in the sheet: %s", context or "sheet", ", ".join(sheet.missing))
    kept = [c for c in extra if c in df.columns and c not in sheet.found]
    return df.select(*(F.col(f"`{c}`").alias(i) for i, c in sheet.found.items()), *kept)


def project_to_target(df: DataFrame, spec: DatasetSpec, extra: tuple[str, ...] = ()) -> DataFrame:
    """Rename through the spec's column map, drop unmapped columns, keep only those present (still text)."""
    cols = [F.col(src).alias(dst) for src, dst in spec.column_map if src in df.columns]
    cols += [F.col(c) for c in extra if c in df.columns]
    return df.select(*cols)
