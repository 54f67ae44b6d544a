"""Keyed upsert of a dataset into a state table.

``INSERT … ON CONFLICT (key) DO UPDATE`` becomes: reduce the incoming rows to one per key (the latest wins), full outer
join with the state on the key, and pick per column.  Supplied non-key columns take the incoming value (a null
overwrites), columns not supplied keep the state's value, and on insert they take the table default.  With no non-key
column supplied the conflict action is ``DO NOTHING``.  A null in a key column never equals anything, as in a unique
constraint, so such state rows pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.operators.cleaning import classify
from rosterline.operators.dedup import last_wins
from rosterline.operators.headers import project_to_target
from rosterline.specs import NOW, DatasetSpec


def conform(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """All columns of the spec's schema in order (absent ones null), typed."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in spec.schema.fields
    ])


def project_incoming(dataset: DataFrame, spec: DatasetSpec) -> DataFrame | None:
    """Transform dataset → target-named text columns with ``_ord`` and ``_copies``; ``None`` when a key column is absent
    altogether (the dataset is skipped)."""
    proj = project_to_target(dataset, spec, extra=("_ord", "_copies"))
    return proj if all(k in proj.columns for k in spec.key) else None


def prepare_incoming(dataset: DataFrame, spec: DatasetSpec, load_date: Column, parents: DataFrame | None = None) -> DataFrame | None:
    """Typed rows ready to merge: those that ``classify`` has nothing against."""
    proj = project_incoming(dataset, spec)
    return None if proj is None else accepted(classify(proj, spec, load_date, parents))


def accepted(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col("_reason").isNull()).drop("_reason", "_given", "_copies")


def merge(state: DataFrame, incoming: DataFrame, spec: DatasetSpec, order: str = "_ord", now: Column | None = None) -> DataFrame:
    """The state after the upsert, with ``_action`` ∈ insert / update / ignore / keep per row, and ``_before``: the old
    row where the upsert changed it.  ``now``: the time of the load, for columns that default to it."""
    key = list(spec.key)
    supplied = [c for c in incoming.columns if c != order]
    if order in incoming.columns:
        inc = last_wins(incoming, key, order).drop(order)
    else:
        inc = incoming.dropDuplicates(key)
    non_key = [c for c in supplied if c not in key]
    do_nothing = not non_key
    defaults = dict(spec.defaults)

    state_has_key = all(k in state.columns for k in key)
    s = conform(state, spec)
    s = s.select(*[F.col(c).alias(f"_s_{c}") for c in s.columns], F.lit(True).alias("_s"))
    i = inc.select(*[F.col(c).alias(f"_i_{c}") for c in supplied], F.lit(True).alias("_i"))
    if state_has_key:
        cond: Column | None = None
        for k in key:
            c = F.col(f"_s_{k}") == F.col(f"_i_{k}")
            cond = c if cond is None else cond & c
        j = s.join(i, cond, "full_outer")
    else:
        # A key column the state does not have is null in every state row: nothing can conflict.
        j = s.unionByName(i, allowMissingColumns=True)

    in_s = F.col("_s").isNotNull()
    in_i = F.col("_i").isNotNull()
    cols = []
    for f in spec.schema.fields:
        c = f.name
        sc = F.col(f"_s_{c}")
        text = defaults.get(c, "NULL")
        default = (now if now is not None else F.current_timestamp()) if text == NOW else F.expr(text).cast(f.dataType)
        if c in key:
            v = F.when(in_s, sc).otherwise(F.col(f"_i_{c}"))
        elif c in supplied:
            ic = F.col(f"_i_{c}").cast(f.dataType)
            v = F.when(in_s, sc).otherwise(ic) if do_nothing else F.when(in_i, ic).otherwise(sc)
        else:
            v = F.when(in_s, sc).otherwise(default)
        cols.append(v.alias(c))
    action = (
        F.when(in_s & in_i, F.lit("ignore" if do_nothing else "update"))
        .when(in_i, F.lit("insert"))
        .otherwise(F.lit("keep"))
    )
    names = spec.target_columns
    j = j.select(*cols, action.alias("_action"), F.struct(*(F.col(f"_s_{c}").alias(c) for c in names)).alias("_old"))
    changed = (F.col("_action") == "update") & ~F.struct(*names).eqNullSafe(F.col("_old"))
    return j.select(*names, "_action", F.when(changed, F.col("_old")).alias("_before"))


def append_rows(state: DataFrame, incoming: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Plain ``INSERT`` without a conflict key."""
    return conform(state, spec).unionByName(conform(incoming, spec))


def upsert_stats(merged: DataFrame, given: DataFrame, table: str) -> DataFrame:
    """One row: rows given, distinct keys, inserted, updated, ignored, rows affected and collapsed duplicates."""
    tagged = merged.select(F.col("_action").alias("_a")).unionByName(given.select(F.lit("given").alias("_a")))
    out = tagged.agg(*[F.count_if(F.col("_a") == a).alias(a) for a in ("insert", "update", "ignore", "given")])
    out = out.withColumnsRenamed({"insert": "inserted", "update": "updated", "ignore": "ignored"})
    return out.select(
        F.lit(table).alias("table_name"),
        F.col("given").cast("bigint").alias("given"),
        (F.col("inserted") + F.col("updated") + F.col("ignored")).cast("bigint").alias("distinct_keys"),
        F.col("inserted").cast("bigint").alias("inserted"),
        F.col("updated").cast("bigint").alias("updated"),
        F.col("ignored").cast("bigint").alias("ignored"),
        (F.col("inserted") + F.col("updated")).cast("bigint").alias("rows_affected"),
        (F.col("given") - F.col("inserted") - F.col("updated") - F.col("ignored")).cast("bigint").alias("collapsed"),
    )
