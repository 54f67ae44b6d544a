"""Integrity checks (one pass or one join each)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.session import merged


def check_unique(df: DataFrame, key: list[str], table: str) -> DataFrame:
    """Key values held by more than one row: ``(table_name, key_value, n)``."""
    grouped = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return grouped.select(
        F.lit(table).alias("table_name"),
        F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("<null>")) for k in key]).alias("key_value"),
        F.col("n").cast("bigint").alias("n"),
    )


def check_fk(child: DataFrame, parent: DataFrame, child_key: list[str], parent_key: list[str], relation: str) -> DataFrame:
    """``(relation, checked, orphans)``: child rows with a non-null key missing from the parent."""
    keys = [f"_p{i}" for i in range(len(parent_key))]
    p = parent.select(*[F.col(a).alias(k) for a, k in zip(parent_key, keys)]).distinct().withColumn("_found", F.lit(True))
    cond = F.lit(True)
    for c, k in zip(child_key, keys):
        cond = cond & (F.col(c) == F.col(k))
    # one pass over the child: its keys are unique in the parent's distinct ones, so the join adds no rows
    flagged = child.select(*child_key).na.drop(how="any").join(merged(p), cond, "left")
    return flagged.agg(
        F.count(F.lit(1)).cast("bigint").alias("checked"),
        F.count_if(F.col("_found").isNull()).cast("bigint").alias("orphans"),
    ).select(F.lit(relation).alias("relation"), "checked", "orphans")


def check_domain(df: DataFrame, column: str, domain: tuple[str, ...], table: str) -> DataFrame:
    """Values outside the allowed set (null passes, as in a CHECK constraint): ``(table_name, column_name, value, n)``."""
    c = F.col(column)
    bad = df.where(c.isNotNull() & ~c.isin(*domain))
    return bad.groupBy(c.alias("value")).agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "value", "n"
    )


def check_not_null(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    """Null count per required column in one pass: ``(table_name, column_name, nulls)``."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "nulls").select(
        F.lit(table).alias("table_name"), "column_name", "nulls"
    )


def not_in(df: DataFrame, column: str, sub: DataFrame, sub_column: str) -> DataFrame:
    """``df WHERE column NOT IN (SELECT sub_column FROM sub)`` with SQL's null rules, without a null-aware join.

    NOT IN is false-or-unknown for every row once the subquery holds a null, and unknown for a null probe value unless
    the subquery is empty.  Both facts are one cheap scalar probe each; the rest is an ordinary anti join, which
    shuffles instead of broadcasting the subquery.
    """
    s = sub.select(F.col(sub_column).alias("_v"))
    if not s.where(F.col("_v").isNull()).isEmpty():
        return df.where(F.lit(False))
    if s.isEmpty():
        return df
    return df.where(F.col(column).isNotNull()).join(merged(s), F.col(column) == F.col("_v"), "left_anti")
