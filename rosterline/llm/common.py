"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir

_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application (they need not share the driver's folders)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="code-"), "rosterline_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage and keeps column pruning."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_checked(df: DataFrame, max_rows: int, max_bytes: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if it holds at most ``max_rows`` rows (counted first), else unmarked (sort-merge).

    ``max_bytes``: for rows of any length, their bytes as JSON are summed and bounded as well.
    """
    if df.limit(max_rows + 1).count() > max_rows:
        return df
    if max_bytes is not None and (df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0) > max_bytes:
        return df
    return F.broadcast(df)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` into a fixed number of parts, for groups whose work isn't in proportion to their bytes (joined
    by bytes, as adaptive execution would, a few tasks would have it all)."""
    spark = df.sparkSession
    n = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, *keys)


def text_of(column: str = "text"):
    """The text with null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def others(names: list[str], added: list[str]) -> list[tuple[int, str]]:
    """Place and name of the input columns that no added column replaces."""
    return [(k, n) for k, n in enumerate(names) if n.lower() not in added]
