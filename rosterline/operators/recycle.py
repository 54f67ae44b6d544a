"""Deleting people with everything that depends on them, and bringing them back.

A delete walks the parent graph of the specs, children first, and commits each table without the rows of the doomed
employees.  Their full images go to the recycle bin under one deletion id before the tables change, so that a delete that
stops half-way can be run again under the same id: it bins what is still there and keeps what it has binned.

A restore takes a deletion's images, or of several deletions each row's latest one, and upserts them, the master first.
Images whose key lives again in the meantime are left alone unless ``overwrite``.  Only touched buckets are rewritten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.operators.upsert import conform, merge
from rosterline.session import merged as by_merge
from rosterline.sources.snapshots import SnapshotStore
from rosterline.specs import LOAD_ORDER, MASTER, DatasetSpec

BIN = "deletion_id string, entity_type string, entity_id string, old_data string, deleted_at timestamp, is_restored boolean, restored_at timestamp"


def _folder(store: SnapshotStore, deletion_id: str, table: str, state: str) -> str:
    return f"{store.root}/recycle_bin/{state}/{deletion_id}-{table}"


def _identity(spec: DatasetSpec) -> Column:
    """Rows without a whole key have none: they are told apart by their image."""
    whole = F.lit(True)
    for k in spec.key:
        whole = whole & F.col(k).isNotNull()
    text = F.concat_ws("|", *(F.col(k).cast("string") for k in spec.key))
    return F.when(whole, text).otherwise(F.concat(F.lit("\u0000"), F.to_json(F.struct(*spec.target_columns))))


def delete_people(store: SnapshotStore, chosen: Column, deletion_id: str, now: Column) -> None:
    """Deletes the employees that ``chosen`` holds for, and their rows in all dependent tables."""
    doomed = store.read(MASTER).where(chosen).select("employee_id")
    if store.note("deletions", deletion_id) is None:
        # who goes is settled before the first table changes, so that a repeated delete means the same people
        store.publish(doomed.distinct(), f"{store.root}/recycle_bin/doomed/{deletion_id}")
        store.write_note("deletions", deletion_id, {})
    doomed = store.spark.read.schema("employee_id string").parquet(f"{store.root}/recycle_bin/doomed/{deletion_id}")
    touched = store.touched(doomed)
    for spec in reversed(LOAD_ORDER):
        rows = store.read_buckets(spec.name, touched)
        goes = rows.join(by_merge(doomed), "employee_id", "left_semi")
        images = goes.select(F.lit(deletion_id).alias("deletion_id"), F.lit(spec.name).alias("entity_type"), _identity(spec).alias("entity_id"),
                             F.to_json(F.struct(*spec.target_columns)).alias("old_data"), now.alias("deleted_at"))
        store.publish(images, _folder(store, deletion_id, spec.name, "deleted"))
        if touched and not goes.isEmpty():
            store.commit(spec.name, rows.join(by_merge(doomed), "employee_id", "left_anti"), touched, deletion_id)


def recycle_bin(store: SnapshotStore, table: str | None = None) -> DataFrame:
    """All binned rows, with whether and when they were restored."""
    parts = []
    for spec in LOAD_ORDER:
        if table in (None, spec.name):
            for deletion_id in store.notes("deletions"):
                path = _folder(store, deletion_id, spec.name, "deleted")
                back = store.note("restored", f"{deletion_id}-{spec.name}")
                if store.exists(path):
                    rows = store.spark.read.schema(BIN).parquet(path)
                    at = F.lit(back["at"] if back else None).cast("timestamp")
                    parts.append(rows.withColumn("is_restored", F.lit(back is not None)).withColumn("restored_at", at))
    out = store.spark.createDataFrame([], BIN)
    for p in parts:
        out = out.unionByName(p)
    return out


def restore_people(store: SnapshotStore, deletions: list[str], at: str, overwrite: bool = False) -> None:
    """Brings back the rows of ``deletions``: master first, of several images of a row the latest; ``at``: time as text."""
    for spec in LOAD_ORDER:
        bin_rows = recycle_bin(store, spec.name).where(F.col("deletion_id").isin(deletions) & ~F.col("is_restored"))
        latest = bin_rows.groupBy("entity_id").agg(F.max_by("old_data", F.struct("deleted_at", "deletion_id")).alias("old_data"), F.count(F.lit(1)).alias("n"))
        whole = ~F.col("entity_id").startswith("\u0000")
        image = F.from_json("old_data", spec.schema).alias("_r")
        rows = latest.where(whole).select(image).select("_r.*")
        # rows without a whole key never meet another one: each deleted one comes back
        loose = bin_rows.where(~whole).select(image).select("_r.*")
        touched, owner = store.touched(rows.unionByName(loose)), "restore-" + "-".join(deletions)
        done = any(store.commit_note(spec.name, v)["owner"] == owner for v in store.committed_versions(spec.name))
        if touched and not done:  # done: a restore that stopped before its note
            state = store.read_buckets(spec.name, touched)
            if not overwrite:
                rows = rows.join(by_merge(state.select(*spec.key)), list(spec.key), "left_anti")
            merged = merge(state, rows, spec, order="_none").drop("_before")
            back = conform(loose, spec).withColumn("_action", F.lit("insert"))
            store.commit(spec.name, merged.unionByName(back), touched, owner)
        for d in deletions:
            if store.exists(_folder(store, d, spec.name, "deleted")):
                store.write_note("restored", f"{d}-{spec.name}", {"at": at})
