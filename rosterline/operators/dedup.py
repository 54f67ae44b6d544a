"""Order-dependent reductions expressed as aggregations.

The reference walks rows in sheet order (keep-first dedup, later row wins, first non-null per column).  Here the order
is an explicit column and each reduction is an ``arg-min``/``arg-max`` aggregate.  Aggregates combine map-side before
the shuffle, so a key holding a third of all rows arrives at its reducer as one partial row per map task instead of a
third of the data; a ``row_number()`` window would sort all of that key's rows in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.session import merged


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_non_null(df: DataFrame, keys: list[str], order: list[str | Column], columns: list[str] | None = None,
                   drop_null_keys: bool = True) -> DataFrame:
    """Per key group, each column's first non-null value in ``order`` (so a result can mix rows).

    Rows with a null key are dropped first, as a group-by on a null key would in the reference.
    """
    columns = [c for c in (columns or df.columns) if c not in keys]
    if drop_null_keys:
        df = df.na.drop(how="any", subset=keys)
    ordering = F.struct(*[_c(o) for o in order])
    aggs = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), ordering)).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*aggs)


def keep_first(df: DataFrame, subset: list[str], order: str | Column = "row_id", keep_order_as: str | None = None,
               copies_as: str | None = None) -> DataFrame:
    """Drop rows repeating an earlier row on ``subset`` (null equals null); the earliest row in ``order`` stays.
    ``copies_as``: how many rows it stands for."""
    others = [c for c in df.columns if c not in subset]
    ordering = _c(order)
    aggs = []
    if others:
        aggs.append(F.min_by(F.struct(*[F.col(c) for c in others]), ordering).alias("_row"))
    if keep_order_as:
        aggs.append(F.min(ordering).alias(keep_order_as))
    if copies_as:
        aggs.append(F.count(F.lit(1)).alias(copies_as))
    if not aggs:
        return df.select(*subset).distinct()
    out = df.groupBy(*subset).agg(*aggs)
    sel = [F.col(c) if c in subset else F.col(f"_row.{c}").alias(c) for c in df.columns]
    if keep_order_as:
        sel.append(F.col(keep_order_as))
    if copies_as:
        sel.append(F.col(copies_as))
    return out.select(*sel)


def last_wins(df: DataFrame, key: list[str], order: str = "_ord") -> DataFrame:
    """One row per key: the latest in ``order`` (a later page overwrites an earlier one)."""
    others = [c for c in df.columns if c not in key]
    if not others:
        return df.select(*key).distinct()
    out = df.groupBy(*key).agg(F.max_by(F.struct(*[F.col(c) for c in others]), F.col(order)).alias("_row"))
    return out.select(*[F.col(k) for k in key], *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)


def distinct_with_order(df: DataFrame, columns: list[str], order: str | Column = "row_id", order_as: str = "_ord") -> DataFrame:
    """``SELECT DISTINCT columns`` that also keeps the first position of each distinct row (for later last-wins) and the
    number of its copies (``_copies``)."""
    return df.groupBy(*columns).agg(F.min(_c(order)).alias(order_as), F.count(F.lit(1)).alias("_copies"))


def duplicate_rows(df: DataFrame, subset: list[str], row_key: str = "row_id") -> DataFrame:
    """Rows that ``keep_first`` removes: every row except the earliest of its ``subset`` group.

    Two balanced shuffles: a partially aggregated ``min(row_id)`` per group, then an anti join on the unique
    ``row_id`` (uniform by construction, whatever the skew of ``subset``).
    """
    kept = df.groupBy(*subset).agg(F.min(row_key).alias(row_key)).select(row_key)
    return df.join(merged(kept), on=row_key, how="left_anti")
