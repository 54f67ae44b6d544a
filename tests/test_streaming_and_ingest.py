"""Drop-folder stream (exactly-once per upload id) and CSV workbook ingest."""

from __future__ import annotations

import csv
import os
import random
from datetime import datetime

import pytest
from test_golden_sheets import _conformed

from pyspark.sql import functions as F

from rosterline.operators import recycle
from rosterline.operators.audit import change_log
from rosterline.plans.pipeline import Clock, upload
from rosterline.sources.sheets import read_csv_sheet
from rosterline.sources.snapshots import SnapshotStore
from rosterline.specs import SPECS
from rosterline.streaming.drop_folder import drop_upload, quarantine, read_change_feed, start_stream


def test_stream_applies_each_upload_once(spark, tmp_folder):
    root = tmp_folder
    raw, ass = _conformed(spark)
    store = SnapshotStore(spark, f"{root}/state")
    drop_upload(raw, ass, root, "u1")
    start_stream(spark, store, root)
    assert store.note("applied", "u1")["files"] and quarantine(store).isEmpty()
    assert store.read("employees").count() == 12
    versions = {t: store.latest_version(t) for t in ("employees", "riwayat_pekerjaan")}
    # A replay (new checkpoint: the same files are seen again) finds the upload applied and changes nothing.
    start_stream(spark, store, root, checkpoint="replay")
    assert {t: store.latest_version(t) for t in versions} == versions
    feed = read_change_feed(spark, root)
    assert feed.where("entity_type = 'employees' AND action_type = 'INSERT' AND upload_id = 'u1'").count() == 12


def test_split_failed_and_foreign_uploads(spark, tmp_folder):
    root = tmp_folder
    raw, ass = _conformed(spark)
    store = SnapshotStore(spark, f"{root}/state")
    # an upload whose roster has no name at all fails, and so does one whose sheets can't be found; the stream goes on
    drop_upload(raw.where("row_id = 1").withColumns({"nama": F.lit(None).cast("string"), "nik": F.lit(None).cast("string")}), ass.limit(0), root, "u0")
    drop_upload(raw, None, root, "u00")
    start_stream(spark, store, root)
    assert not store.notes("applied") and {r["upload_id"]: r["attempts"] for r in quarantine(store).collect()} == {"u0": 1, "u00": 1}
    # the second half of an upload comes later: nobody is lost; failed ones are tried again, but not for ever
    drop_upload(raw.where("row_id <= 5"), ass, root, "u1")
    start_stream(spark, store, root)
    drop_upload(raw.where("row_id > 5"), ass.limit(0), root, "u1", piece="2")
    start_stream(spark, store, root)
    assert store.read("employees").count() == 12
    assert {r["upload_id"]: r["attempts"] for r in quarantine(store).collect()} == {"u0": 3, "u00": 3}
    # new files give a failed upload another chance
    drop_upload(raw, ass, root, "u0", piece="2")
    start_stream(spark, store, root)
    assert [r["upload_id"] for r in quarantine(store).collect()] == ["u00"]


def test_one_word_names_of_two_uploads_are_two_people(spark, tmp_folder):
    store = SnapshotStore(spark, f"{tmp_folder}/state")
    raw, ass = _conformed(spark)
    one = raw.where("nama = 'Joko'")
    upload(spark, store, one, ass.limit(0), "u1")
    upload(spark, store, one.withColumn("nik", F.lit("EMP777")), ass.limit(0), "u2")
    assert store.read("employees").where("fullname = 'Joko'").count() == 2
    upload(spark, store, one, ass.limit(0), "u3")  # the same person again, by number
    assert store.read("employees").where("fullname = 'Joko'").count() == 2


def test_change_log_pairs_rows_without_a_whole_key_by_number(spark):
    t = spark.createDataFrame([("e", None, 1), ("e", None, 1), ("e", None, 2), ("f", "k", 1)], "a string, b string, c int")
    assert change_log(t, t, ["a", "b"], "t").count() == 0
    log = change_log(t, t.where("c = 1"), ["a", "b"], "t").collect()
    assert [(r["a"], r["action_type"]) for r in log] == [("e", "DELETE")]


def test_upload_of_one_person_rewrites_one_bucket(spark, tmp_folder):
    raw, ass = _conformed(spark)
    store = SnapshotStore(spark, f"{tmp_folder}/state", buckets=16)
    people = spark.range(400).selectExpr("concat('e', id) AS employee_id", "concat('Person ', id) AS fullname")
    store.seed({"employees": people})
    assert upload(spark, store, raw.where("nik = 'EMP006'"), ass.limit(0), "u").success
    files = store.committed("employees", 2).inputFiles()
    assert len({f.split("_bucket=")[1].split("/")[0] for f in files}) == 1 and len(files) == 1
    assert len(store.read("employees").inputFiles()) >= 16 and store.read("employees").count() == 401
    assert store.read_version("employees", 1).count() == 400
    assert store.buckets == SnapshotStore(spark, f"{tmp_folder}/state", buckets=3).buckets  # a store keeps its buckets


def test_buckets_emptied_by_a_delete_stay_empty(spark, tmp_folder):
    raw, ass = _conformed(spark)
    store = SnapshotStore(spark, f"{tmp_folder}/state", buckets=64)
    upload(spark, store, raw, ass, "u")
    before = {n: sorted(map(str, store.read(n).collect())) for n in SPECS}
    now = F.lit("2026-01-01 00:00:00").cast("timestamp")
    for _ in range(2):  # a delete that runs again deletes and bins nothing twice
        recycle.delete_people(store, F.col("fullname").like("Budi%"), "d1", now)
    gone = {n: store.read(n).count() for n in SPECS}
    assert gone["employees"] == 11 and gone["riwayat_pekerjaan"] == len(before["riwayat_pekerjaan"]) - 2
    assert recycle.recycle_bin(store).groupBy("entity_type").count().where("entity_type = 'riwayat_pekerjaan'").first()["count"] == 2
    # the person comes back by another upload, is changed, and deleted again: the latest image is restored
    upload(spark, store, raw.withColumn("nama", F.concat("nama", F.lit(" Junior"))).where("nik = 'EMP001'"), ass.limit(0), "u")
    changed = store.read("employees").where("fullname LIKE 'Budi%'").first()
    recycle.delete_people(store, F.col("fullname").like("Budi%"), "d2", F.lit("2026-01-02 00:00:00").cast("timestamp"))
    recycle.restore_people(store, ["d1", "d2"], "2026-01-03 00:00:00")
    names = {r["fullname"] for r in store.read("employees").collect()}
    assert changed["fullname"] in names and recycle.recycle_bin(store).where("NOT is_restored").isEmpty()
    versions = {n: store.latest_version(n) for n in SPECS}
    recycle.restore_people(store, ["d1", "d2"], "2026-01-03 00:00:00")  # nothing is left to restore
    assert {n: store.latest_version(n) for n in SPECS} == versions
    recycle.delete_people(store, F.lit(True), "all", now)
    assert all(store.read(n).isEmpty() for n in SPECS)
    recycle.restore_people(store, ["all"], "2026-01-04 00:00:00")
    assert store.read("riwayat_assesment").count() == len(before["riwayat_assesment"])


def test_rejects_and_accounting(spark, tmp_folder):
    raw, ass = _conformed(spark)
    odd = raw.withColumn("tanggal_masuk_kerja", F.when(F.col("row_id") == 5, F.lit("soon")).when(F.col("row_id") != 6, F.col("tanggal_masuk_kerja")))
    odd = odd.withColumn("nama", F.when(F.col("nik") == "EMP008", F.lit(None)).otherwise(F.col("nama")))
    store = SnapshotStore(spark, f"{tmp_folder}/state")
    done = upload(spark, store, odd, ass, "u", clock=Clock(datetime(2020, 5, 6))).results
    jobs = {r["reason"]: r["given"] for r in store.rejects("riwayat_pekerjaan").collect()}
    assert set(jobs) == {"incomplete", "rejected", "orphaned"} and '"soon"' in jobs["rejected"]
    for name, r in done.items():
        assert r.given == r.rows_upserted + r.ignored + r.collapsed + r.empty + r.incomplete + r.rejected + r.orphaned, name
        assert store.rejects(name).count() == r.empty + r.incomplete + r.rejected + r.orphaned
    assert done["riwayat_pekerjaan"].before_dedup - done["riwayat_pekerjaan"].given == 1  # rows 1 and 10
    stamps = store.read("employees").select(F.date_format("created_at", "yyyy-MM-dd").alias("d")).distinct().collect()
    assert [r["d"] for r in stamps] == ["2020-05-06"]


@pytest.mark.parametrize("split", [32, 100, 1 << 20])
def test_csv_records_over_splits(spark, tmp_folder, split):
    """Quoted cells with separators, quotes and line breaks, cut by splits anywhere, equal Python's csv reader."""
    rnd = random.Random(split)
    want, header = [], ["NIK/NIP", "NAMA\n(sesuai KTP)", "odd;name"]
    for k in range(3):
        rows = [[f"{k}-{i}", "".join(rnd.choice(["a", ";", '"', "\n", "b c", "é"]) for _ in range(rnd.randint(0, 9))) + "x", rnd.choice(["1", "x\ny\nz" * 9])] for i in range(25)]
        with open(os.path.join(tmp_folder, f"part-{k}.csv"), "w", encoding="utf-8", newline="") as f:
            out = csv.writer(f, delimiter=";", lineterminator="\n")
            out.writerow(header)
            out.writerows(rows)
        want += rows
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        got = read_csv_sheet(spark, [tmp_folder]).orderBy("row_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [list(r)[:-1] for r in got] == want and [r["row_id"] for r in got] == list(range(75)) and got[0].__fields__[:-1] == header


def test_read_workbook_csv(spark, tmp_folder):
    from rosterline.operators.headers import conform_headers
    from rosterline.sources.sheets import read_workbook
    from rosterline.specs import ROSTER_COLUMNS

    folder = os.path.join(tmp_folder, "upload")
    os.makedirs(folder)
    with open(os.path.join(folder, "Raw Data.csv"), "w", encoding="utf-8") as f:
        f.write('no;NIK/NIP;NAMA;"TANGGAL LAHIR\n(DD/MM/YY)";JENIS KELAMIN\n')
        f.write("1; EMP001 ;Budi Test;17/05/90;L\n")
        f.write("2;;Sari Test;nan; \n")
    with open(os.path.join(folder, "assessment.csv"), "w", encoding="utf-8") as f:
        f.write("no;NIK/NIP;NAMA\n1;EMP001;Budi Test\n")
    sheets = read_workbook(spark, folder, fmt="csv", row_id_col="no")
    raw = conform_headers(sheets["raw_data"], ROSTER_COLUMNS, "roster")
    rows = sorted(raw.collect(), key=lambda r: r["row_id"])
    assert set(raw.columns) == {"row_id", "nik", "nama", "tanggal_lahir", "jenis_kelamin"}
    assert rows[0]["nik"] == "EMP001" and rows[0]["tanggal_lahir"] == "17/05/90"
    assert rows[1]["nik"] is None and rows[1]["tanggal_lahir"] is None and rows[1]["jenis_kelamin"] is None
    assert sheets["assesment"].count() == 1
