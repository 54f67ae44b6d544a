"""Session helpers."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "rosterline") -> SparkSession:
    """Session for tests and the bench.  On a cluster, the cluster's own defaults are used instead."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and committed tables.

    A cluster names it in ``spark.checkpoint.dir``; we only create one ourselves when nothing is configured and Spark
    runs in local mode (tests, the bench).  On a cluster without the setting we refuse instead of guessing a
    machine-local folder that other executors cannot see.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="rosterline-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (for committed state, exports, stream drops)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def hashed(df: DataFrame) -> DataFrame:
    """The far smaller side of a join whose other side is too wide to be sorted: dealt out by key and hashed in each task,
    so its keys must not repeat much."""
    return df.hint("shuffle_hash")


def merged(df: DataFrame) -> DataFrame:
    """A join side that grows with the input: the join sorts and merges, it isn't broadcast.

    Spark broadcasts by the size of files, of which it takes a selected column for its share of the schema; ids held in
    compressed files of wide tables are tens of times that in the driver's memory, which holds every broadcast table.
    """
    return df.hint("merge")


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """A table without rows, made without Python workers; its columns are real ones, no literals."""
    return spark.range(0).select(F.from_json(F.col("id").cast("string"), schema).alias("_r")).select("_r.*")


@contextlib.contextmanager
def small_methods(spark: SparkSession):
    """Queries run inside without generated methods that the JVM wouldn't compile.

    The JVM interprets methods of more than 8,000 bytes of code, such as a whole stage over a sheet's many text columns gives;
    below this limit Spark runs such a stage step by step, in methods that are compiled.
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "8000")
    try:
        yield
    finally:
        spark.conf.set(limit, before)


def cut(df):
    """Compute ``df`` once into Parquet in the shared checkpoint folder and continue from there.

    Used where one intermediate result feeds several outputs (a resolved sheet feeds three datasets) and at every state
    commit: later plans read the files instead of re-running the lineage, and a lost executor costs a re-read, not a
    recomputation from the sources; and they read only the columns they use.  Never a machine-local folder.
    """
    path = scratch_path(df.sparkSession, "cut")
    with small_methods(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
