"""Who is who in an upload: ties by number and name, filled names and numbers, and uploads that are sent again."""

from __future__ import annotations

import random
from collections import defaultdict

from pyspark.sql import functions as F

from rosterline.operators.audit import change_log
from rosterline.operators.components import components
from rosterline.operators.resolve import attach, cell_pairs, fill_pairs, identify
from rosterline.plans.pipeline import upload
from rosterline.sources.snapshots import SnapshotStore
from rosterline.specs import SPECS

EMP = "employee_id string, fullname string"
JOB = "employee_id string, employee_no_subholding string"
SHEET = "row_id long, nik string, nama string"


def _people(spark, roster, assessment=(), emp=(), jobs=(), **kw):
    emp, jobs = spark.createDataFrame(list(emp), EMP), spark.createDataFrame(list(jobs), JOB)
    sheets = [spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], SHEET) for rows in (roster, assessment)]
    ids = identify(fill_pairs(cell_pairs(list(enumerate(sheets))), emp, jobs, 5001), emp, jobs, "s", **kw)
    out = [attach(df, ids, k, "s").orderBy("row_id").collect() for k, df in enumerate(sheets)]
    return out[0] + out[1]


def test_rows_of_one_number_are_one_person(spark):
    rows = _people(spark, [("K1", "Ana Maria"), ("K1", "Ana M"), ("K1", None), ("K2", "Ana M"), ("K3", "Joko"), ("K4", "Joko")])
    ids = [r["employee_id"] for r in rows]
    assert len(set(ids[:4])) == 1 and len(set(ids[4:])) == 1 and ids[0] != ids[4]
    assert [r["match_kind"] for r in rows] == ["new"] * 6


def test_numbers_apart_with_the_option(spark):
    ids = [r["employee_id"] for r in _people(spark, [("K1", "Ana Maria"), ("K1", "Ana M"), ("K2", "Ana M")], tie_names=False)]
    assert ids[0] == ids[1] != ids[2]


def test_known_employees(spark):
    emp = [("e1", "Ana Maria"), ("e2", "Ana Maria"), ("e3", "Joko"), ("e4", "Rina Test")]
    jobs = [("e1", "K1"), ("e2", " K2 "), ("e3", "K3")]
    rows = _people(spark, [("K1", "Ana Maria"), ("K2", "Ana Maria"), ("K9", "ana maria"), ("K9", "Someone Else"), ("K8", "Joko"), ("K3", "Joko"),
                           ("K7", "Rina Test"), ("K2", "Other Name"), ("K6", "Other Name")], emp=emp, jobs=jobs)
    got = [(r["employee_id"], r["match_kind"]) for r in rows]
    assert got[:4] == [("e1", "key"), ("e2", "key"), ("e1", "name"), ("e1", "name")]  # K9 is tied to a known name
    assert got[4][1] == "new" and got[4][0] != "e3"  # a one-word name doesn't reach a known number
    assert got[5] == ("e3", "key") and got[6] == ("e4", "name") and got[7] == ("e2", "key") and got[8] == ("e2", "name")


def test_fills_across_sheets(spark):
    rows = _people(spark, [("K1", None), ("K2", None), ("K2", "Budi"), (None, "Sari Test"), (" ", "Dewi Test"), (None, None), ("K5", None)],
                   [("K1", "Ana Maria"), ("K2", "Budi Other"), ("K4", "Dewi Test"), (None, "Sari Test")])
    assert [r["nama"] for r in rows] == ["Ana Maria", None, "Budi", "Sari Test", "Dewi Test", None, None, "Ana Maria", "Budi Other", "Dewi Test", "Sari Test"]
    assert rows[3]["nik"] == rows[10]["nik"] == "unk-5001" and rows[4]["nik"] == "K4"
    assert rows[5]["nik"].startswith("unk-x") and len({r["employee_id"] for r in rows}) == 6
    assert rows[0]["employee_id"] == rows[7]["employee_id"] and rows[1]["employee_id"] == rows[2]["employee_id"] == rows[8]["employee_id"]


def test_components_equal_union_find(spark):
    rnd = random.Random(3)
    for n, m in ((1, 0), (40, 25), (200, 150), (60, 300)):
        links = [(f"n{rnd.randrange(n):03d}", f"n{rnd.randrange(n):03d}") for _ in range(m)] + [(f"p{k:02d}", f"p{k + 1:02d}") for k in range(30)]
        near = defaultdict(set)
        for u, v in links:
            near[u].add(v)
            near[v].add(u)
        want = {}
        for start in sorted(near):
            todo = [start]
            while todo:
                x = todo.pop()
                if x not in want:
                    want[x] = start
                    todo += near[x]
        got = {r["node"]: r["component"] for r in components(spark.createDataFrame([*links, (None, "x")], "u string, v string")).collect()}
        assert got == {k: v for k, v in want.items() if len(near[k] - {k}) > 0}


def test_any_upload_sent_twice_changes_nothing(spark, tmp_folder):
    """Random sheets with shared numbers and names, second names, empty cells and rows that are rejected."""
    rnd = random.Random(11)
    for case in range(2):
        names = [f"{rnd.choice(['Ana', 'Budi', 'Sari'])} {rnd.choice('ABCD')}" for _ in range(6)] + ["Joko", "Rina"]
        pick = lambda items, gap: None if rnd.random() < gap else rnd.choice(items)  # noqa: E731, B023
        people = [(f"K{k}", pick(names, 0.1)) for k in range(12)]
        raw = [(k, str(rnd.randint(2020, 2024)), *rnd.choice(people), "SH", "CO", pick(["Staff", "Lead"], 0.2), pick(["2020-01-01", "2021-05-01"], 0.3),
                "S1", "UI", pick(["Hukum", "Mesin"], 0.3)) for k in range(60)]
        ass = [(k, *rnd.choice(people), str(rnd.randint(2021, 2023)), str(k), "Staff", "SH", "CO") for k in range(20)]
        raw = spark.createDataFrame(raw, "row_id long, tahun string, nik string, nama string, subholding string, subco string, job_title string, "
                                         "tanggal_masuk_kerja string, tingkat_pendidikan string, universitas string, jurusan string")
        ass = spark.createDataFrame(ass, "row_id long, nik string, nama string, asessment_year string, overall_skor string, job_title string, sub_holding string, sub_company string")
        store = SnapshotStore(spark, f"{tmp_folder}/state{case}")
        upload(spark, store, raw, ass, "u")
        first = {n: store.latest_version(n) for n in SPECS}
        upload(spark, store, raw, ass, "u")
        for name, spec in SPECS.items():
            log = change_log(store.read_version(name, first[name]), store.read(name), list(spec.key), name)
            assert log.where(F.lit(True)).count() == 0, (case, name, log.collect())
