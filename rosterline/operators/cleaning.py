"""Row filters and column normalisations (all narrow: no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.functions.dates import parse_date
from rosterline.functions.text import blank_to_default, normalize_gender, strip_ws
from rosterline.session import merged
from rosterline.specs import GENDER_DEFAULT, GENDER_MAP, JOB_TITLE_DEFAULT, DatasetSpec


def drop_all_null(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows whose columns (or ``subset``) are all null."""
    cols = [c for c in (subset or df.columns) if c in df.columns]
    return df.na.drop(how="all", subset=cols) if cols else df


def drop_incomplete_keys(df: DataFrame, key: list[str] | tuple[str, ...]) -> DataFrame:
    """Drop rows with a null in any key column."""
    return df.na.drop(how="any", subset=list(key))


def fill_blank(df: DataFrame, column: str, default: str = JOB_TITLE_DEFAULT) -> DataFrame:
    """Whitespace-only or null → ``default`` (other values kept as they are)."""
    if column not in df.columns:
        return df
    return df.withColumn(column, blank_to_default(column, default))


def normalize_gender_column(df: DataFrame, column: str = "jenis_kelamin", mapping: dict[str, str] = GENDER_MAP,
                            default: str = GENDER_DEFAULT) -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn(column, normalize_gender(column, mapping, default))


def defaulted_genders(df: DataFrame, column: str = "jenis_kelamin", mapping: dict[str, str] = GENDER_MAP) -> DataFrame:
    """``(value, n)``: the cells that ``normalize_gender_column`` gives the default because the map doesn't know them."""
    g = F.upper(strip_ws(column))
    odd = df.where(g.isNull() | ~g.isin(*mapping))
    return odd.groupBy(g.alias("value")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


#: Why a row isn't loaded, in the order in which the reasons are tried; null: it is.
EMPTY, INCOMPLETE, REJECTED, ORPHANED = "empty", "incomplete", "rejected", "orphaned"
REASONS = (EMPTY, INCOMPLETE, REJECTED, ORPHANED)


def classify(df: DataFrame, spec: DatasetSpec, load_date: Column, parents: DataFrame | None = None) -> DataFrame:
    """Target-named text rows → typed rows, all of them, each with ``_reason``, and its text (``_given``) where it has one.

    empty: all cells null; incomplete: a key cell is null; rejected: a cell doesn't parse, or is null in a NOT NULL column;
    orphaned: ``parents`` (ids of the master) lacks the row's employee.  Two-digit years of the spec's ``past_dates`` are
    read as not after ``load_date``.  Columns the spec doesn't know are dropped, those named ``_*`` pass.
    """
    types = {f.name: f.dataType for f in spec.schema.fields}
    present, extra = [c for c in df.columns if c in types], [c for c in df.columns if c.startswith("_")]
    none, lacking, bad, typed = F.lit(True), F.lit(False), F.lit(False), []
    for c in present:
        cell = F.col(c).cast("string")
        if isinstance(types[c], T.StringType):
            value = cell
        elif isinstance(types[c], T.DateType):
            value = parse_date(cell, latest=load_date if c in spec.past_dates else None)
        else:
            value = cell.try_cast(types[c])
        typed.append(value.alias(f"_t_{c}"))
        none = none & F.col(c).isNull()
        if c in spec.key:
            lacking = lacking | F.col(c).isNull()
        bad = bad | (F.col(c).isNotNull() & F.col(f"_t_{c}").isNull())
        if c in spec.not_null:
            bad = bad | F.col(c).isNull()
    out = df.select(*present, *extra, *typed)
    why = F.when(none, EMPTY).when(lacking, INCOMPLETE).when(bad, REJECTED)
    if parents is not None:
        ids = parents.select(F.col("employee_id").alias("_parent")).distinct()
        # rows that are out already look for no parent, each at a place of its own
        out = out.withColumn("_reason", why).withColumn("_child", F.when(F.col("_reason").isNull(), F.col("employee_id")).otherwise(F.concat(F.lit("\u0000"), F.xxhash64(*present).cast("string"))))
        out = out.join(merged(ids), F.col("_child") == F.col("_parent"), "left")
        why = F.coalesce("_reason", F.when(F.col("_parent").isNull(), F.lit(ORPHANED)))
    given = F.to_json(F.struct(*present))
    out = out.select(*present, *(f"_t_{c}" for c in present), *extra, why.alias("_why"))
    return out.select(*(F.col(f"_t_{c}").alias(c) for c in present), *extra, F.col("_why").alias("_reason"), F.when(F.col("_why").isNotNull(), given).alias("_given"))
