"""Sheet ingest: two text tables in, every cell a string, every row numbered.

A workbook is read as two tables (roster and assessment), each from one or many files.  Row order matters downstream
(keep-first dedup, first-seen numbering), and DataFrames have none, so ingest adds ``row_id``: taken from a column of the
file when one is given, otherwise the rank of (file, position).
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.functions.text import null_if_empty_token, strip_cell
from rosterline.operators.dense_index import dense_index
from rosterline.session import cut
from rosterline.specs import ASSESSMENT_SHEET_NAMES, ROSTER_SHEET_NAMES


def _norm_name(s: str) -> str:
    return " ".join(s.split()).lower()


def find_sheet(names: list[str], wanted: tuple[str, ...]) -> str:
    """Case- and space-insensitive match of a sheet (or table/file stem) name; raises when none matches."""
    by_norm = {}
    for n in names:
        by_norm.setdefault(_norm_name(n), n)
    for w in wanted:
        hit = by_norm.get(_norm_name(w))
        if hit is not None:
            return hit
    raise ValueError(f"sheet {' / '.join(repr(w) for w in wanted)} not found; available: {names}")


def clean_cells(df: DataFrame, keep: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """Strip header names and every string cell; ``nan``/``NaN``/empty → null.  All-null rows are kept.

    Two stacked projections, the second reading the first one's column several times: the optimizer keeps them apart
    rather than inline a trim into every reference, so each cell is trimmed once, if at all.
    """
    fields = [(f.name, f.name.strip(), f.name not in keep and f.dataType.simpleString() == "string") for f in df.schema.fields]
    stripped = df.select(*[(strip_cell(F.col(f"`{o}`")) if s else F.col(f"`{o}`")).alias(n) for o, n, s in fields])
    return stripped.select(*[(null_if_empty_token(F.col(f"`{n}`")) if s else F.col(f"`{n}`")).alias(n) for _, n, s in fields])


def spread(df: DataFrame, key: str = "row_id") -> DataFrame:
    """Rows of a source with fewer files than the cluster has cores, dealt out by ``key``: cleaning is work for the CPU, and
    a small file is one split."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n, key) if len(df.inputFiles()) < n else df


def with_row_id(df: DataFrame, row_id_col: str | None = None) -> DataFrame:
    """Give every row a stable ``row_id``: the file's own numbering (``row_id_col``), else the rank of its
    (file, position), from 0, over all files of the sheet.

    The position is the start of the file split and the row's place in it, so files are read in splits; the numbering is
    staged once (``dense_index``), so a recomputed task can't number differently.
    """
    if row_id_col:
        return df.withColumn("row_id", F.col(f"`{row_id_col}`").cast("bigint"))
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at")]
    return dense_index(cut(df.select("*", *place)), ["_file", "_block", "_at"], "row_id").drop("_file", "_block", "_at")


def csv_lines(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """The lines of CSV files, staged (``value, _file, _block, _in``: place within the task, ``_odd`` number of quotes), and
    per split of a file ``_o`` lines with an odd number of quotes, ``_n`` lines, ``_blank`` ones and the first place ``_in0``."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = cut(spark.read.option("recursiveFileLookup", True).text(paths).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_in"), (quotes % 2).alias("_odd")))
    per_split = lines.groupBy("_file", "_block").agg(F.sum("_odd").alias("_o"), F.count(F.lit(1)).alias("_n"), F.count_if(F.trim("value") == "").alias("_blank"), F.min("_in").alias("_in0"))
    return lines, cut(per_split)


def csv_records(lines: DataFrame, per_split: DataFrame) -> DataFrame:
    """``_file, _at, text``: the records of CSV files (``csv_lines``), whose quoted cells may hold line breaks, read in splits.

    Files are read as lines.  A line lies inside a quoted cell if an odd number of quotes stands before it in its file:
    counted in each split, with the parity of a file's earlier splits added (one row per split).  Lines between two line
    ends outside quotes are one record, numbered by its first line; only lines of records with several are brought
    together.  A line break inside a cell reads as one line feed.
    """
    split = Window.partitionBy("_file", "_block").orderBy("_in")
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = per_split.select("_file", "_block", F.coalesce(F.sum("_o").over(earlier), F.lit(0)).alias("_odd0"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_line0"))
    lines = lines.join(before, ["_file", "_block"])
    after = F.col("_odd0") + F.sum("_odd").over(split)
    lines = lines.select("_file", "_block", (F.col("_line0") + F.row_number().over(split)).alias("_at"), "value", (after % 2).alias("_after"), ((after - F.col("_odd")) % 2).alias("_before"))
    whole = lines.where("_before = 0 AND _after = 0").select("_file", "_at", F.col("value").alias("text"))
    # Every line of a record with several but its first lies inside a cell; the record is named by that first line, which
    # for the first lines of a split is the last one of an earlier split.
    parts = cut(lines.where("_before = 1 OR _after = 1"))
    start = F.when(F.col("_before") == 0, F.col("_at"))
    starts = parts.groupBy("_file", "_block").agg(F.max(start).alias("_s")).select("_file", "_block", F.max("_s").over(earlier).alias("_carried"))
    here = F.max(start).over(Window.partitionBy("_file", "_block").orderBy("_at"))
    parts = parts.withColumn("_here", here).join(starts, ["_file", "_block"]).withColumn("_first", F.coalesce("_here", "_carried"))
    joined = parts.groupBy("_file", F.col("_first").alias("_at")).agg(F.array_sort(F.collect_list(F.struct("_at", "value"))).alias("_l"))
    return whole.unionByName(joined.select("_file", "_at", F.array_join(F.transform("_l", lambda x: x["value"]), "\n").alias("text")))


def line_records(lines: DataFrame, per_split: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of files whose lines are one record each: ``_head, _row, text`` (``_row``: their number over all files)
    without the files' first lines, which name the columns (``_head``); and those lines, ``_file, _head``.

    A line's number is the number of lines before its split plus its place in it, less a first line for every file so far:
    sums over one row per split, which is all that is broadcast.
    """
    first = per_split.where("_block = 0").select("_file", F.col("_in0").alias("_in"))
    heads = cut(lines.join(F.broadcast(first), ["_file", "_in"]).where("_block = 0").select("_file", F.col("value").alias("_head")))
    order = Window.orderBy("_file", "_block")
    before = F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.dense_rank().over(Window.orderBy("_file"))
    splits = per_split.select("_file", "_block", "_in0", before.alias("_before")).join(heads, "_file")
    rows = lines.join(F.broadcast(splits), ["_file", "_block"]).where((F.col("_block") > 0) | (F.col("_in") > F.col("_in0")))
    return rows.select("_head", (F.col("_before") + F.col("_in") - F.col("_in0")).cast("bigint").alias("_row"), F.col("value").alias("text")), heads


def read_csv_sheet(spark: SparkSession, paths: list[str], sep: str = ";") -> DataFrame:
    """All files of one CSV sheet, numbered by (file, position), every cell a string; files may order columns differently.

    Unless a cell may hold a line break (a line with an odd number of quotes) or lines are blank, lines are numbered where
    they are; otherwise records are put together first, and sorted.
    """
    lines, per_split = csv_lines(spark, paths)
    single = per_split.where("_o > 0 OR _blank > 0").isEmpty()
    if single:
        records, heads = line_records(lines, per_split)
    else:
        records = cut(csv_records(lines, per_split))
        records = records.where(F.trim("text") != "")
        heads = records.groupBy("_file").agg(F.min_by("text", "_at").alias("_head"), F.min("_at").alias("_from"))
    place = ["_row"] if single else ["_file", "_at"]
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    out = None
    for (head,) in heads.select("_head").distinct().collect():  # one row per layout of the files
        names = next(csv.reader(io.StringIO(head.removeprefix("\ufeff")), delimiter=sep))
        names = [n if n.strip() else f"column {k + 1}" for k, n in enumerate(names)]
        names = [n if n not in names[:k] else f"{n} {k + 1}" for k, n in enumerate(names)]
        schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(names))])
        if single:
            rows = records.where(F.col("_head") == F.lit(head))
        else:
            rows = records.join(heads.where(F.col("_head") == F.lit(head)).select("_file", "_from"), "_file").where(F.col("_at") > F.col("_from"))
        rows = rows.select(*place, F.from_csv("text", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options).alias("_r"))
        rows = rows.select(*place, *(F.col(f"_r.c{k}").alias(n) for k, n in enumerate(names)))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        return spark.createDataFrame([], "row_id bigint")
    numbered = out.withColumn("row_id", F.col("_row")) if single else dense_index(out, place, "row_id")
    return numbered.drop(*place)


def read_sheet(spark: SparkSession, path: str, fmt: str = "csv", sep: str = ";", row_id_col: str | None = None) -> DataFrame:
    """Read one sheet (a file or a folder of files) as all-string columns (no type inference) and clean it."""
    if fmt == "csv":
        df = read_csv_sheet(spark, [path], sep)
        return clean_cells(with_row_id(df.drop("row_id"), row_id_col) if row_id_col else df)
    if fmt == "parquet":
        df = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(path)
        cells = df.select(*(F.col(f"`{c}`").cast("string").alias(c) if c != row_id_col else F.col(f"`{c}`") for c in df.columns), "_metadata")
        return clean_cells(with_row_id(cells, row_id_col).drop("_metadata"))
    raise ValueError(f"unsupported sheet format {fmt!r}")


def read_workbook(spark: SparkSession, folder: str, fmt: str = "csv", sep: str = ";", row_id_col: str | None = None) -> dict[str, DataFrame]:
    """Two tables from one folder holding one file (or sub-folder) per sheet, named after the sheet."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(folder)  # noqa: SLF001 - listing a folder has no DataFrame API
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    entries = [s.getPath().getName() for s in fs.listStatus(jvm_path)]
    stems = {e.rsplit(".", 1)[0] if "." in e else e: e for e in entries}
    roster = stems[find_sheet(list(stems), ROSTER_SHEET_NAMES)]
    assessment = stems[find_sheet(list(stems), ASSESSMENT_SHEET_NAMES)]
    base = folder.rstrip("/")
    return {
        "raw_data": read_sheet(spark, f"{base}/{roster}", fmt, sep, row_id_col),
        "assesment": read_sheet(spark, f"{base}/{assessment}", fmt, sep, row_id_col),
    }


def write_workbook(sheets: dict[str, DataFrame], folder: str, sep: str = ";", piece: str = "1") -> None:
    """Sheets (name → table) as CSV files under ``<folder>/<name>/<piece>``, rows in the order of ``row_id`` if there is one."""
    for name, df in sheets.items():
        ordered = df.orderBy("row_id").drop("row_id") if "row_id" in df.columns else df
        ordered.write.mode("append").options(header=True, sep=sep, quote='"', escape='"').csv(f"{folder.rstrip('/')}/{name}/{piece}")


__all__ = ["clean_cells", "csv_lines", "csv_records", "find_sheet", "read_csv_sheet", "read_sheet", "read_workbook", "spread", "with_row_id", "write_workbook"]
