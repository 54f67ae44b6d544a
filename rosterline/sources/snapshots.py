"""State tables as Parquet versions of which only touched buckets are rewritten.

All tables are bucketed by a hash of the employee.  A commit writes a new folder ``<root>/<table>/v=<n>`` with the
buckets it touched; the table at a version is, bucket by bucket, the newest folder up to it.  Nothing is overwritten, so
a commit may read what it replaces, and an upload of one person rewrites one bucket per table.  Spark's ``_SUCCESS``
marker is the commit point; the note beside it, written before, names the touched buckets and the upload (owner).

Every row of a version carries ``_action`` and, if the commit changed it, ``_before``, so a commit's changes are read
from its own files.  Older versions stay for comparison; nothing here deletes them.
"""

from __future__ import annotations

import json
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.operators.upsert import conform
from rosterline.session import cut, empty
from rosterline.specs import SPECS

BUCKET_KEY = "employee_id"
#: Folders beyond this number are listed by a Spark job on every read.
BUCKETS = 32


class StateStore(Protocol):
    def read(self, table: str) -> DataFrame: ...

    def touched(self, rows: DataFrame) -> list[int] | None: ...

    def read_buckets(self, table: str, touched: list[int] | None) -> DataFrame: ...

    def commit(self, table: str, df: DataFrame, touched: list[int] | None = None, owner: str | None = None) -> DataFrame: ...


class LazyState:
    """State kept as staged DataFrames instead of versioned tables (tests, the query registry); commits are whole tables."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.tables: dict[str, DataFrame] = {}
        for name, df in (tables or {}).items():
            # Seeded like a committed table: conformed and staged, so absent columns are real (all-null)
            # columns rather than literals the optimizer would fold into join conditions.
            self.tables[name] = cut(conform(df, SPECS[name]) if name in SPECS else df)

    def read(self, table: str) -> DataFrame:
        if table not in self.tables:
            self.tables[table] = empty(self.spark, SPECS[table].schema)
        return self.tables[table]

    def touched(self, rows: DataFrame) -> list[int] | None:
        return None

    def read_buckets(self, table: str, touched: list[int] | None) -> DataFrame:
        return self.read(table)

    def commit(self, table: str, df: DataFrame, touched: list[int] | None = None, owner: str | None = None) -> DataFrame:
        df = cut(df.drop("_before"))
        self.tables[table] = df.drop("_action")
        return df


class SnapshotStore:
    """Versioned Parquet tables under ``root`` (a folder every executor can reach).

    ``buckets`` counts for a new store (default: the session's shuffle partitions, ``BUCKETS`` at most); an old one keeps its own.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark._jvm  # noqa: SLF001 - Hadoop FileSystem for listing, markers and notes; data goes through DataFrames
        self._Path, self._io = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.commons.io.IOUtils
        self._fs = self._Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
        kept = self.note("store", "buckets")
        if kept is None:
            kept = {"n": buckets or min(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))}
            self.write_note("store", "buckets", kept)
        self.buckets: int = kept["n"]

    # -- versions -------------------------------------------------------------------------------------------------
    def children(self, path: str) -> list[str]:
        p = self._Path(path)
        return sorted(st.getPath().getName() for st in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def exists(self, path: str) -> bool:
        return bool(self._fs.exists(self._Path(path)))

    def _folder(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/v={version}"

    def _numbers(self, table: str) -> list[int]:
        return sorted(int(n[2:]) for n in self.children(f"{self.root}/{table}") if n.startswith("v="))

    def committed_versions(self, table: str) -> list[int]:
        return [v for v in self._numbers(table) if self.exists(f"{self._folder(table, v)}/_SUCCESS")]

    def latest_version(self, table: str) -> int | None:
        v = self.committed_versions(table)
        return v[-1] if v else None

    def commit_note(self, table: str, version: int) -> dict:
        """touched (list of buckets) and owner of a version."""
        return self.note(f"commits/{table}", str(version))

    def _load(self, table: str, folders: list[str], extra: tuple[str, ...] = ()) -> DataFrame:
        schema = SPECS[table].schema
        held = T.StructType([*schema.fields, T.StructField("_action", T.StringType()), T.StructField("_before", schema)])
        if not folders:
            return empty(self.spark, held).select(*schema.names, *extra)
        return self.spark.read.schema(held).option("basePath", f"{self.root}/{table}").parquet(*folders).select(*schema.names, *extra)

    def _bucket_folders(self, table: str, version: int, touched: list[int] | None) -> list[str]:
        """For each wanted bucket, the newest folder up to ``version``; buckets without rows have none."""
        left = set(range(self.buckets)) if touched is None else set(touched)
        out = []
        for v in reversed([x for x in self.committed_versions(table) if x <= version]):
            mine = left & set(self.commit_note(table, v)["touched"])
            if mine:
                there = set(self.children(self._folder(table, v)))
                out += [f"{self._folder(table, v)}/_bucket={b}" for b in sorted(mine) if f"_bucket={b}" in there]
            left -= mine
            if not left:
                break
        return out

    def read_version(self, table: str, version: int) -> DataFrame:
        return self._load(table, self._bucket_folders(table, version, None))

    def read(self, table: str) -> DataFrame:
        return self.read_buckets(table, None)

    def read_buckets(self, table: str, touched: list[int] | None) -> DataFrame:
        v = self.latest_version(table)
        return self._load(table, self._bucket_folders(table, v, touched) if v is not None else [])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(BUCKET_KEY), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of ``rows``: at most as many as there are."""
        return sorted(r[0] for r in rows.select(self._bucket().alias("b")).distinct().collect())

    def commit(self, table: str, df: DataFrame, touched: list[int] | None = None, owner: str | None = None) -> DataFrame:
        """Write the next version, ``df`` being all rows of the touched buckets (without ``touched``: of the table).

        Returns the version's own rows with ``_action``.
        """
        v = max(self._numbers(table), default=0) + 1  # beyond every folder there is, finished or not
        self.write_note(f"commits/{table}", str(v), {"touched": list(range(self.buckets)) if touched is None else touched, "owner": owner})
        spec = SPECS[table]
        for name, kind in (("_action", "string"), ("_before", spec.schema)):
            if name not in df.columns:
                df = df.withColumn(name, F.lit(None).cast(kind))
        rows = df.select(*spec.target_columns, "_action", "_before", self._bucket().alias("_bucket"))
        # Rebalancing brings a bucket's rows together, but splits a bucket that has far more than others.
        rows.hint("rebalance", "_bucket").write.mode("errorifexists").partitionBy("_bucket").parquet(self._folder(table, v))
        return self.committed(table, v)

    def committed(self, table: str, version: int) -> DataFrame:
        """The rows a version wrote, with ``_action`` and ``_before``."""
        folders = [f"{self._folder(table, version)}/{n}" for n in self.children(self._folder(table, version)) if n.startswith("_bucket=")]
        return self._load(table, folders, ("_action", "_before"))

    def seed(self, tables: dict[str, DataFrame]) -> None:
        for name, df in tables.items():
            self.commit(name, conform(df, SPECS[name]))

    # -- rows that were given, and why some weren't loaded ---------------------------------------------------------
    def write_given(self, table: str, flagged: DataFrame, owner: str) -> DataFrame:
        """Loadable and other rows in one write, by ``_reason``; returns them as read back."""
        path = f"{self.root}/_given/{table}/load={owner}-{len(self.children(f'{self.root}/_given/{table}'))}"
        flagged.withColumn("_part", F.coalesce("_reason", F.lit("ok"))).write.partitionBy("_part").parquet(path)
        held = T.StructType([*flagged.schema.fields, T.StructField("_part", T.StringType())])
        return self.spark.read.schema(held).parquet(path).drop("_part")

    def rejects(self, table: str) -> DataFrame:
        """``load, reason, given``: the rows of all loads of a table that weren't loaded, as JSON text of their cells."""
        path = f"{self.root}/_given/{table}"
        if not self.children(path):
            return self.spark.createDataFrame([], "load string, reason string, given string")
        rows = self.spark.read.schema("_reason string, _given string, load string, _part string").parquet(path)
        return rows.where("_part <> 'ok'").select("load", F.col("_reason").alias("reason"), F.col("_given").alias("given"))

    # -- notes: small named records (commits, applied files, failed uploads) ----------------------------------------
    def note(self, kind: str, name: str) -> dict | None:
        path = self._Path(f"{self.root}/_notes/{kind}/{name}")
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return json.loads(self._io.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write_note(self, kind: str, name: str, record: dict) -> None:
        """Written aside, then moved into place: a reader sees a whole note or none."""
        path = self._Path(f"{self.root}/_notes/{kind}/{name}")
        aside = self._Path(f"{self.root}/_notes/.{kind.replace('/', '-')}-{name}")
        stream = self._fs.create(aside, True)
        try:
            stream.write(bytearray(json.dumps(record).encode()))
        finally:
            stream.close()
        self._fs.mkdirs(path.getParent())
        self._fs.delete(path, False)
        if not self._fs.rename(aside, path):
            raise OSError(f"note {path} could not be written")

    def notes(self, kind: str) -> list[str]:
        return self.children(f"{self.root}/_notes/{kind}")

    def publish(self, df: DataFrame, path: str) -> None:
        """Write ``df`` aside and move the finished folder to ``path``: followers see it whole, or not at all."""
        if self.exists(path):
            return
        aside = f"{self.root}/_publish/{path.rsplit('/', 1)[1]}"
        df.write.mode("overwrite").parquet(aside)
        target = self._Path(path)
        self._fs.mkdirs(target.getParent())
        if not self._fs.rename(self._Path(aside), target):
            raise OSError(f"{path} could not be published")

    def counts(self) -> DataFrame:
        """``(table_name, n)`` for every table in the store."""
        parts = []
        for name in SPECS:
            parts.append(self.read(name).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
                         .select(F.lit(name).alias("table_name"), "n"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
