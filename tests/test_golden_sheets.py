"""End-to-end upload of small hand-written sheets built from the test guide's edge cases.

Roster: 11 rows, 9 people (EMP001 three times, rows 1 and 10 identical; two people without a number; a blank job
title; a resign date; an unknown gender word; one genuine one-word name).  Assessment: 7 rows, 6 people (one
identical duplicate; one new number; two people without a number).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterline.plans.pipeline import upload
from rosterline.sources.sheets import clean_cells
from rosterline.sources.snapshots import SnapshotStore

ROSTER_COLS = ["row_id", "TAHUN", "NIK/NIP", "NAMA", "JENIS KELAMIN", "TANGGAL LAHIR\n(DD/MM/YYYY)", "SUBHOLDING",
               "SUBCO", "JOB TITLE", "TANGGAL MASUK KERJA", "TANGGAL RESIGN/MUTASI", "TINGKAT PENDIDIKAN",
               "UNIVERSITAS", "JURUSAN"]
ROSTER = [
    (1, "2024", "EMP001", "Budi Santoso Test", "L", "17/05/1990", "SH1", "CO1", "Junior", "2020-01-01", None, "S1", "UI", "Teknik"),
    (2, "2025", "EMP001", "Budi Santoso Test", "L", None, "SH1", "CO1", "Senior", "2025-01-01", None, "S1", "UI", "Teknik"),
    (3, "2025", "", "Siti Aminah Budi Test", "P", "01/02/1991", "SH1", "CO2", "Staff", "2021-03-01", None, "S1", "UGM", "Ekonomi"),
    (4, "2025", " ", "Guntur Test", "L", None, "SH2", "CO3", "Staff", "2022-01-01", None, None, None, None),
    (5, "2025", "EMP003", "Dewi Test", "PEREMPUAN", None, "SH2", "CO3", "Analyst", "2019-07-01", None, "S2", "ITB", "Informatika"),
    (6, "2025", "EMP005", "Rina Test", "P", None, "SH1", "CO1", "Officer", "2018-01-01", None, "S1", "UNPAD", "Hukum"),
    (7, "2025", "EMP006", "Hendra Gunawan Test", "L", None, "SH1", "CO2", "Manager", "2015-01-01", "2025-06-30", "S1", "UI", "Manajemen"),
    (8, "2025", "EMP007", "Agus Wijaya Test", "L", None, "SH2", "CO3", "   ", "2016-01-01", None, "D3", "Polban", "Mesin"),
    (9, "2025", "EMP008", "Nur Fadilah Test", "WANITA", None, "SH2", "CO4", "Staff", "2017-01-01", None, "S1", "UNAIR", "Farmasi"),
    (10, "2024", "EMP001", "Budi Santoso Test", "L", "17/05/1990", "SH1", "CO1", "Junior", "2020-01-01", None, "S1", "UI", "Teknik"),
    (11, "2025", "EMP009", "Joko", "L", None, "SH1", "CO1", "Staff", "2023-01-01", None, "SMA", "SMAN 1", "IPA"),
]
ASSESSMENT_COLS = ["row_id", "NIK/NIP", "NAMA", "Asessment Year", "OVERALL_SKOR", "TALENT CLASS", "road_map_2023",
                   "road_map_2024"]
ASSESSMENT = [
    (1, "EMP001", "Budi Santoso Test", "2025", "80", "A", "Lead", "Manager"),
    (2, "EMP003", "Dewi Test", "2025", "75", "B", "Senior Analyst", "Lead"),
    (3, "EMP005", "Rina Test", "2025", "70", "B", "Senior Officer", "Supervisor"),
    (4, "EMP_NEW001", "Putri Handayani Test", "2025", "85", "A", "Staff", "Senior Staff"),
    (5, None, "Dimas Prasetyo Nugraha Test", "2025", "65", "C", "Staff", "Staff II"),
    (6, "", "Sari Test", "2025", "60", "C", "Junior", "Staff"),
    (7, "EMP001", "Budi Santoso Test", "2025", "80", "A", "Lead", "Manager"),
]


def _conformed(spark):
    from rosterline.plans.pipeline import conform_sheets

    raw = clean_cells(spark.createDataFrame(ROSTER, ROSTER_COLS))
    ass = clean_cells(spark.createDataFrame(ASSESSMENT, ASSESSMENT_COLS))
    return conform_sheets(raw, ass)


def _run(spark, folder):
    raw, ass = _conformed(spark)
    store = SnapshotStore(spark, f"{folder}/state")
    report = upload(spark, store, raw, ass)
    return store, report


def test_guide_counts_and_contents(spark, tmp_folder):
    store, report = _run(spark, tmp_folder)
    emp = store.read("employees")
    names = {r["fullname"]: r for r in emp.collect()}
    assert emp.count() == 12  # 9 roster people + Putri, Dimas, Sari
    assert store.read("riwayat_pendidikan").count() == 8  # everyone in the roster but Guntur
    assert store.read("riwayat_assesment").count() == 6  # the identical duplicate collapses
    assert store.read("individual_career_roadmap").count() >= 10
    assert names["Nur Fadilah Test"]["gender"] == "Male"  # WANITA is not a known value
    assert names["Siti Aminah Budi Test"]["gender"] == "Female"
    assert names["Dewi Test"]["gender"] == "Female"
    # Assessment-only people take the table default on insert.
    assert names["Putri Handayani Test"]["gender"] == "Male"
    assert str(names["Budi Santoso Test"]["birth_date"]) == "1990-05-17"

    ids = {n: r["employee_id"] for n, r in names.items()}
    no_assessment = (
        emp.join(store.read("riwayat_assesment"), "employee_id", "left_anti").select("fullname").collect()
    )
    assert {r[0] for r in no_assessment} == {
        "Hendra Gunawan Test", "Agus Wijaya Test", "Nur Fadilah Test", "Siti Aminah Budi Test", "Guntur Test", "Joko",
    }
    jobs = store.read("riwayat_pekerjaan")
    agus = jobs.where(F.col("employee_id") == ids["Agus Wijaya Test"]).collect()
    assert [r["jabatan"] for r in agus] == ["Unknown"]
    budi = sorted(r["jabatan"] for r in jobs.where(F.col("employee_id") == ids["Budi Santoso Test"]).collect())
    assert budi == ["Junior", "Senior"]  # rows 1 and 10 are one job
    assert all(r["status"] == "active" for r in jobs.collect())
    # People without a number get unk- keys in first-seen order, roster before assessment.
    unk = {r["employee_id"]: r["employee_no_subholding"] for r in jobs.where(F.col("employee_no_subholding").like("unk-%")).collect()}
    assert unk[ids["Siti Aminah Budi Test"]] == "unk-5001"
    assert unk[ids["Guntur Test"]] == "unk-5002"
    # Assessment-only people: their job rows are skipped (the sheet has no job title, a key column), so read the keys
    # off the filled assessment.
    from rosterline.plans.pipeline import phase1
    from rosterline.sources.snapshots import LazyState

    raw, ass = _conformed(spark)
    filled = {r["nama"]: r["nik"] for r in phase1(raw, ass, LazyState(spark), 5001).assessment_filled.collect()}
    assert filled["Dimas Prasetyo Nugraha Test"] == "unk-5003"
    assert filled["Sari Test"] == "unk-5004"
    # No duplicate full names.
    assert emp.groupBy("fullname").count().where("count > 1").count() == 0
    assert report.success and report.results["employees"].rows_upserted == 12


def test_golden_record_takes_latest_year(spark):
    from rosterline.operators.datasets import employees_from_roster
    from rosterline.operators.resolve import resolve
    from rosterline.sources.snapshots import LazyState

    raw, _ = _conformed(spark)
    state = LazyState(spark)
    r = resolve(raw, state.read("employees"), state.read("riwayat_pekerjaan"), "t", 0)
    emp = employees_from_roster(r).where(F.col("nik") == "EMP001").collect()
    assert len(emp) == 1
    assert emp[0]["job_title"] == "Senior"
    # First non-null per column: the 2025 row has no birth date, so it comes from 2024.
    assert emp[0]["tanggal_lahir"] == "17/05/1990"


def test_cross_sheet_same_person(spark, tmp_folder):
    store, _ = _run(spark, tmp_folder)
    emp = store.read("employees").where(F.col("fullname") == "Rina Test").collect()
    assert len(emp) == 1
    rid = emp[0]["employee_id"]
    assert store.read("riwayat_assesment").where(F.col("employee_id") == rid).count() == 1
    assert store.read("riwayat_pekerjaan").where(F.col("employee_id") == rid).count() == 1


def test_reupload_changes_nothing(spark, tmp_folder):
    from rosterline.operators.audit import change_log
    from rosterline.specs import SPECS

    raw, ass = _conformed(spark)
    store = SnapshotStore(spark, f"{tmp_folder}/state")
    upload(spark, store, raw, ass)
    first = {n: store.latest_version(n) for n in SPECS}
    upload(spark, store, raw, ass)
    for name, spec in SPECS.items():
        log = change_log(store.read_version(name, first[name]), store.read(name), list(spec.key), name)
        assert log.count() == 0, name


def test_options_status_and_fallback_key(spark):
    import pytest

    from rosterline.plans.pipeline import conform_sheets, phase1
    from rosterline.sources.snapshots import LazyState

    raw, ass = _conformed(spark)
    p1 = phase1(raw, ass, LazyState(spark), 5001, status_from_end_date=True, fallback_key=("name", "nik"))
    status = {r["nik"]: r["status"] for r in p1.datasets["riwayat_pekerjaan"]().collect()}
    assert status["EMP006"] == "inactive" and status["EMP001"] == "active"
    # A roster without an employee-number column is refused (required column).
    with pytest.raises(ValueError):
        conform_sheets(clean_cells(spark.createDataFrame([(1, "x")], "row_id long, NAMA string")), ass)
