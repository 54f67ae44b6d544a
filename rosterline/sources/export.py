"""CSV sink: one folder of part files per dataset, with a header row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def export_csv(datasets: dict[str, DataFrame], folder: str, sep: str = ",") -> dict[str, str]:
    """Write every dataset to ``<folder>/<name>``; a failed write is an error."""
    paths: dict[str, str] = {}
    for name, df in datasets.items():
        path = f"{folder.rstrip('/')}/{name}"
        df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
        paths[name] = path
    return paths


def read_back_counts(spark: SparkSession, paths: dict[str, str], sep: str = ",") -> DataFrame:
    """``(dataset, n)`` counted from the written files."""
    parts = [
        spark.read.option("header", True).option("sep", sep).option("multiLine", True).csv(p)
        .agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(F.lit(name).alias("dataset"), "n")
        for name, p in paths.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
