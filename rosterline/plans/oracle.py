"""Reference SQL for every registered query, in the dialect DuckDB runs.

Each query is the same semantics written independently as plain SQL over the generated tables: the derived fixtures
are CTEs (the very fixture texts), every later step is one more CTE, and a query text carries only the CTEs it needs.
Window functions stand in for the order-dependent steps the Spark side does with arg-min aggregates.
"""

from __future__ import annotations

import re

from rosterline.sources.fixtures import duckdb_fixture
from rosterline.specs import ROADMAP_YEARS, STRIP_CHARS

SALT = "rosterline"
LOADED = "2026-01-01 00:00:00"  # the time of every load
STRIP = "(" + " || ".join(f"chr({ord(c)})" for c in STRIP_CHARS) + ")"

RAW_TEXT_COLS = ["tahun", "nik", "nama", "jenis_kelamin", "tanggal_lahir", "subholding", "subco", "job_title",
                 "tanggal_masuk_kerja", "tanggal_resign", "tingkat_pendidikan", "universitas", "jurusan"]
ROADMAP_COLS = [f"road_map_{y}" for y in ROADMAP_YEARS]
ASS_TEXT_COLS = ["nik", "nama", "sub_holding", "sub_company", "job_title", "asessment_year", "overall_skor"] + ROADMAP_COLS
JOB_COLS = ["employee_id", "employee_no_subholding", "subholding_code", "company_code", "divisi", "department",
            "level_jabatan", "jabatan", "functions", "golongan", "kelompok_jabatan", "tanggal_mulai", "tanggal_selesai",
            "status"]
JOB_KEY = ["employee_id", "subholding_code", "company_code", "jabatan", "tanggal_mulai"]
EDU_COLS = ["employee_id", "tingkat_pendidikan", "universitas", "jurusan", "tanggal_masuk", "tanggal_keluar"]
EDU_KEY = ["employee_id", "tingkat_pendidikan", "universitas", "jurusan"]
EMP_COLS = ["employee_id", "fullname", "birth_date", "gender", "agama"]
DATE_COLS = {"tanggal_mulai", "tanggal_selesai", "tanggal_masuk", "tanggal_keluar", "birth_date"}


def tr(x: str) -> str:
    return f"trim({x}, {STRIP})"


def clean(x: str) -> str:
    return f"CASE WHEN {tr(x)} IN ('nan', 'NaN', '') THEN NULL ELSE {tr(x)} END"


def missing(x: str) -> str:
    return f"({x} IS NULL OR {tr(x)} = '')"


def gender(x: str) -> str:
    g = f"upper({tr(x)})"
    return (f"CASE WHEN {g} IN ('LAKI-LAKI', 'L', 'M') THEN 'Male' WHEN {g} IN ('PEREMPUAN', 'P', 'F') THEN 'Female' "
            f"ELSE 'Male' END")


def job_title(x: str) -> str:
    return f"CASE WHEN {missing(x)} THEN 'Unknown' ELSE {x} END"


def uuid(text: str) -> str:
    h = f"md5({text})"
    return (f"substr({h},1,8) || '-' || substr({h},9,4) || '-3' || substr({h},14,3) || '-8' || substr({h},18,3) "
            f"|| '-' || substr({h},21,12)")


def pdate(x: str, past: bool = False) -> str:
    yy = f"CAST(try_strptime({x}, '%d/%m/%y') AS DATE)"
    return (
        f"coalesce(CAST(try_strptime({x}, '%Y-%m-%d') AS DATE), CAST(try_strptime({x}, '%Y-%m-%d %H:%M:%S') AS DATE), "
        f"CASE WHEN regexp_full_match({x}, '[0-9]+/[0-9]+/[0-9]{{4}}') THEN CAST(try_strptime({x}, '%d/%m/%Y') AS DATE) END, "
        + (f"CASE WHEN {yy} > DATE '{LOADED[:10]}' THEN CAST({yy} - INTERVAL 100 YEAR AS DATE) ELSE {yy} END)" if past else f"{yy})")
    )


def tokens(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN 0 ELSE len(string_split_regex({x}, '\\s+')) END"


def number(x: str) -> str:
    return f"CASE WHEN isnan(TRY_CAST({x} AS DOUBLE)) THEN NULL ELSE TRY_CAST({x} AS DOUBLE) END"


def first_by(c: str, order: str) -> str:
    return f"(list({c} ORDER BY {order}) FILTER (WHERE {c} IS NOT NULL))[1] AS {c}"


def cnt(expr: str = "*") -> str:
    return f"CAST(count({expr}) AS BIGINT)"


# ---------------------------------------------------------------------------------------------------------------------
# CTE library
# ---------------------------------------------------------------------------------------------------------------------

CTES: list[tuple[str, str]] = []


def cte(name: str, sql: str) -> None:
    CTES.append((name, sql))


for _f in ("raw_data", "assesment", "db_employees", "db_jobs", "db_education"):
    cte(_f, duckdb_fixture(_f))

cte("raw_c", "SELECT row_id, " + ", ".join(f"{clean(c)} AS {c}" for c in RAW_TEXT_COLS) + " FROM raw_data")
cte("ass_c", "SELECT row_id, " + ", ".join(f"{clean(c)} AS {c}" for c in ASS_TEXT_COLS) + " FROM assesment")
cte("raw_g", "SELECT row_id, " + ", ".join(
    (f"{gender(c)} AS {c}" if c == "jenis_kelamin" else c) for c in RAW_TEXT_COLS) + " FROM raw_c")
cte("db_emp_c", "SELECT employee_id, fullname, CAST(NULL AS DATE) AS birth_date, CAST(NULL AS VARCHAR) AS gender, "
                "CAST(NULL AS VARCHAR) AS agama FROM db_employees")
cte("db_jobs_c", "SELECT " + ", ".join(
    c if c in ("employee_id", "employee_no_subholding") else
    (f"CAST(NULL AS DATE) AS {c}" if c in DATE_COLS else f"CAST(NULL AS VARCHAR) AS {c}") for c in JOB_COLS) + " FROM db_jobs")
cte("db_edu_c", "SELECT employee_id, tingkat_pendidikan, universitas, jurusan, CAST(NULL AS DATE) AS tanggal_masuk, "
                "CAST(NULL AS DATE) AS tanggal_keluar FROM db_education")
cte("empty_emp", "SELECT * FROM db_emp_c WHERE false")
cte("empty_jobs", "SELECT * FROM db_jobs_c WHERE false")
cte("empty_edu", "SELECT * FROM db_edu_c WHERE false")

def _numbers(emp: str, jobs: str) -> str:
    """k, eid: the state's employee of every number (the smallest id of several)."""
    return f"""
  SELECT {tr('employee_no_subholding')} AS k, min(employee_id) AS eid FROM {jobs}
  WHERE employee_no_subholding IS NOT NULL AND employee_no_subholding <> '' AND employee_id IS NOT NULL
    AND employee_id IN (SELECT employee_id FROM {emp})
  GROUP BY 1"""


def _fullnames(emp: str) -> str:
    """n, eid: the state's employee of every name."""
    return f"""
  SELECT lower({tr('fullname')}) AS n, min(employee_id) AS eid FROM {emp}
  WHERE fullname IS NOT NULL AND fullname <> '' AND employee_id IS NOT NULL GROUP BY 1"""


def identities(p: str, emp: str, jobs: str, salt: str) -> None:
    """``{p}ids``: nik, nama, employee_id, match_kind of the upload's distinct pairs, rows tied by number or name being one person."""
    cte(f"{p}pairs", f"SELECT nik, nama FROM {p}raw_f WHERE NOT alone UNION SELECT nik, nama FROM {p}ass_f WHERE NOT alone")
    cte(f"{p}look", f"""
SELECT r.nik, r.nama, km.eid AS ek, nm.eid AS en, {tokens('r.nama')} >= 2 AS several,
  CASE WHEN nm.eid IS NULL THEN CASE WHEN {tokens('r.nama')} >= 2 THEN lower(r.nama) ELSE r.nama END END AS node
FROM {p}pairs r LEFT JOIN ({_numbers(emp, jobs)}) km ON km.k = r.nik
LEFT JOIN ({_fullnames(emp)}) nm ON {tokens('r.nama')} >= 2 AND nm.n = lower(r.nama)""")
    cte(f"{p}links", f"""
SELECT DISTINCT a.node AS u, b.node AS v FROM {p}look a JOIN {p}look b ON a.nik = b.nik
WHERE a.ek IS NULL AND a.node <> b.node""")
    cte(f"{p}reach", f"SELECT u AS a, v AS b FROM {p}links UNION SELECT r.a, l.v FROM {p}reach r JOIN {p}links l ON r.b = l.u")
    cte(f"{p}person", f"""
SELECT node, coalesce(least(node, min(b)), node) AS person FROM (SELECT DISTINCT node FROM {p}look WHERE node IS NOT NULL) n
LEFT JOIN {p}reach r ON r.a = n.node GROUP BY node""")
    cte(f"{p}num", f"""
SELECT l.nik, min(q.person) AS person, min(l.en) AS own FROM {p}look l LEFT JOIN {p}person q ON q.node = l.node
WHERE l.ek IS NULL GROUP BY l.nik""")
    cte(f"{p}shared", f"""
SELECT person, min(eid) AS eid FROM (
  SELECT person, own AS eid FROM {p}num
  UNION ALL SELECT q.person, l.ek FROM {p}look l JOIN {p}person q ON q.node = l.node WHERE l.ek IS NOT NULL AND l.several)
WHERE person IS NOT NULL AND eid IS NOT NULL GROUP BY person""")
    cte(f"{p}ids", f"""
SELECT l.nik, l.nama, coalesce(l.ek, s.eid, n.own,
    CASE WHEN n.person IS NOT NULL THEN {uuid(f"concat_ws('|', '{salt}', 'name', n.person)")}
         ELSE {uuid(f"concat_ws('|', '{salt}', 'key', l.nik)")} END) AS employee_id,
  CASE WHEN l.ek IS NOT NULL THEN 'key' WHEN coalesce(s.eid, n.own) IS NOT NULL THEN 'name' ELSE 'new' END AS match_kind
FROM {p}look l LEFT JOIN {p}num n ON l.ek IS NULL AND n.nik = l.nik LEFT JOIN {p}shared s ON s.person = n.person""")


def _resolution(p: str, src: str, sheet: int, salt: str, state: tuple[str, str] | None = None) -> str:
    """The sheet's rows with their identity; with ``state``, with what a later state says about their number and name first."""
    own = uuid(f"concat_ws('|', '{salt}', 'row', '{sheet}', CAST(r.row_id AS VARCHAR))")
    columns = "r.* EXCLUDE (alone)"
    if state is None:
        return f"""
SELECT {columns}, CASE WHEN r.alone THEN {own} ELSE i.employee_id END AS employee_id, coalesce(i.match_kind, 'new') AS match_kind
FROM {src} r LEFT JOIN {p}ids i ON NOT r.alone AND i.nik = r.nik AND i.nama IS NOT DISTINCT FROM r.nama"""
    return f"""
SELECT {columns}, CASE WHEN r.alone THEN {own} ELSE coalesce(km.eid, nm.eid, i.employee_id) END AS employee_id,
  CASE WHEN km.eid IS NOT NULL THEN 'key' WHEN nm.eid IS NOT NULL THEN 'name' ELSE 'new' END AS match_kind
FROM {src} r LEFT JOIN {p}ids i ON NOT r.alone AND i.nik = r.nik AND i.nama IS NOT DISTINCT FROM r.nama
LEFT JOIN ({_numbers(*state)}) km ON NOT r.alone AND km.k = r.nik
LEFT JOIN ({_fullnames(state[0])}) nm ON km.eid IS NULL AND {tokens('r.nama')} >= 2 AND nm.n = lower(r.nama)"""


def _merge_select(spec_cols: list[str], key: list[str], supplied: list[str], defaults: dict[str, str],
                  do_nothing: bool = False) -> str:
    out = []
    for c in spec_cols:
        if c in key:
            out.append(f"CASE WHEN s._in THEN s.{c} ELSE i.{c} END AS {c}")
        elif c in supplied:
            out.append(f"CASE WHEN s._in THEN s.{c} ELSE i.{c} END AS {c}" if do_nothing
                       else f"CASE WHEN i._in THEN i.{c} ELSE s.{c} END AS {c}")
        else:
            out.append(f"CASE WHEN s._in THEN s.{c} ELSE {defaults.get(c, 'NULL')} END AS {c}")
    return ", ".join(out)


def _key_on(key: list[str]) -> str:
    return " AND ".join(f"s.{k} = i.{k}" for k in key)


def chain(p: str, emp: str, jobs: str, edu: str, counter: str, raw: str = "raw_g", salt: str = SALT, ass: str = "ass_c") -> None:
    """Phase 1 → load → phase 2 → load, prefixed ``p``, of two sheets against the given state tables."""
    cte(f"{p}miss_rows", f"""
SELECT nama, 0 AS sheet, row_id FROM {raw} WHERE {missing('nik')} AND nama IS NOT NULL
UNION ALL
SELECT nama, 1 AS sheet, row_id FROM {ass} WHERE {missing('nik')} AND nama IS NOT NULL""")
    cte(f"{p}missing_names", f"""
SELECT nama, sheet AS first_sheet, row_id AS first_row_id FROM (
  SELECT *, row_number() OVER (PARTITION BY nama ORDER BY sheet, row_id) AS rn FROM {p}miss_rows) WHERE rn = 1""")
    # Numbers that only the assessment has a name for.
    cte(f"{p}other_names", f"""
SELECT nik, (list(nama ORDER BY row_id))[1] AS nama FROM {ass}
WHERE NOT {missing('nik')} AND nama IS NOT NULL AND nik NOT IN (SELECT nik FROM {raw} WHERE NOT {missing('nik')} AND nama IS NOT NULL)
GROUP BY nik""")
    cte(f"{p}existing", f"""
SELECT lower(e.fullname) AS name_key,
  coalesce(min(j.employee_no_subholding) FILTER (WHERE NOT starts_with(j.employee_no_subholding, 'unk-')),
           min(j.employee_no_subholding) FILTER (WHERE starts_with(j.employee_no_subholding, 'unk-'))) AS existing_key
FROM {emp} e JOIN {jobs} j ON e.employee_id = j.employee_id
WHERE j.employee_no_subholding IS NOT NULL AND j.employee_no_subholding <> ''
  AND lower(e.fullname) IN (SELECT lower({tr('nama')}) FROM {p}missing_names)
GROUP BY 1""")
    cte(f"{p}known", f"""
SELECT name_key, coalesce(min(k) FILTER (WHERE NOT starts_with(k, 'unk-')), min(k) FILTER (WHERE starts_with(k, 'unk-'))) AS existing_key FROM (
  SELECT lower(e.fullname) AS name_key, j.employee_no_subholding AS k FROM {emp} e JOIN {jobs} j ON e.employee_id = j.employee_id
  WHERE j.employee_no_subholding IS NOT NULL AND j.employee_no_subholding <> ''
  UNION ALL SELECT lower(nama), nik FROM {raw} WHERE NOT {missing('nik')} AND nama IS NOT NULL
  UNION ALL SELECT lower(nama), nik FROM {ass} WHERE NOT {missing('nik')} AND nama IS NOT NULL)
WHERE name_key IN (SELECT lower(nama) FROM {p}missing_names) GROUP BY 1""")
    cte(f"{p}assigned", f"""
SELECT m.nama, x.existing_key AS key FROM {p}missing_names m JOIN {p}known x ON lower({tr('m.nama')}) = x.name_key
UNION ALL
SELECT m.nama, 'unk-' || CAST({counter} + row_number() OVER (ORDER BY m.first_sheet, m.first_row_id) - 1 AS VARCHAR) AS key
FROM {p}missing_names m WHERE NOT EXISTS (SELECT 1 FROM {p}known x WHERE x.name_key = lower({tr('m.nama')}))""")
    for name, src, sheet, cols in (("raw_f", raw, 0, RAW_TEXT_COLS), ("ass_f", ass, 1, ASS_TEXT_COLS)):
        sel = []
        for c in cols:
            if c == "nik":
                sel.append(
                    f"CASE WHEN {missing('r.nik')} THEN (CASE WHEN r.nama IS NULL THEN 'unk-x' || "
                    f"md5(concat_ws('|', '{salt}', '{sheet}', CAST(r.row_id AS VARCHAR))) "
                    f"ELSE a.key END) ELSE r.nik END AS nik")
            elif c == "nama":
                sel.append("coalesce(r.nama, o.nama) AS nama")
            else:
                sel.append(f"r.{c}")
        cte(f"{p}{name}", f"""
SELECT r.row_id, {', '.join(sel)}, {missing('r.nik')} AND r.nama IS NULL AS alone FROM {src} r
LEFT JOIN {p}assigned a ON r.nama = a.nama LEFT JOIN {p}other_names o ON o.nik = r.nik""")
    identities(p, emp, jobs, salt)
    cte(f"{p}raw_r", _resolution(p, f"{p}raw_f", 0, salt))

    # Phase-1 datasets.
    cte(f"{p}p1_employees", f"""
SELECT employee_id, {', '.join(first_by(c, 'y DESC NULLS LAST, row_id') for c in
                                ['nik', 'nama', 'tanggal_lahir', 'jenis_kelamin', 'subholding', 'subco', 'job_title'])}
FROM (SELECT employee_id, nik, nama, tanggal_lahir, jenis_kelamin, subholding, subco, {job_title('job_title')} AS job_title,
             {number('tahun')} AS y, row_id FROM {p}raw_r)
GROUP BY employee_id""")
    cte(f"{p}p1_education", f"""
SELECT employee_id, tingkat_pendidikan, universitas, jurusan, min(row_id) AS _ord FROM {p}raw_r
WHERE NOT (tingkat_pendidikan IS NULL AND universitas IS NULL AND jurusan IS NULL)
GROUP BY employee_id, tingkat_pendidikan, universitas, jurusan""")
    cte(f"{p}job_src", f"""
SELECT row_id, employee_id, nama, nik, subholding, subco, {job_title('job_title')} AS job_title, tanggal_masuk_kerja,
       tanggal_resign FROM {p}raw_r""")
    cte(f"{p}p1_jobs", f"""
SELECT employee_id, nik, subholding, subco, job_title, tanggal_masuk_kerja, tanggal_resign, 'active' AS status, row_id AS _ord
FROM (SELECT *, row_number() OVER (PARTITION BY employee_id, subholding, subco, job_title, tanggal_masuk_kerja
                                   ORDER BY row_id) AS rn FROM {p}job_src) WHERE rn = 1""")

    # Phase-1 load: employees, then jobs and education (only rows whose employee exists).
    cte(f"{p}p1_emp_t", f"""
SELECT employee_id, nama AS fullname, {pdate('tanggal_lahir', past=True)} AS birth_date, jenis_kelamin AS gender
FROM {p}p1_employees
WHERE employee_id IS NOT NULL AND nama IS NOT NULL
  AND NOT (tanggal_lahir IS NOT NULL AND {pdate('tanggal_lahir', past=True)} IS NULL)""")
    cte(f"{p}st1_emp", f"""
SELECT {_merge_select(EMP_COLS, ['employee_id'], ['fullname', 'birth_date', 'gender'], {'gender': "'Male'"})}
FROM (SELECT *, TRUE AS _in FROM {emp}) s FULL OUTER JOIN (SELECT *, TRUE AS _in FROM {p}p1_emp_t) i
  ON s.employee_id = i.employee_id""")
    cte(f"{p}p1_jobs_tv", f"""
SELECT employee_id, nik AS employee_no_subholding, subholding AS subholding_code, subco AS company_code,
       job_title AS jabatan, {pdate('tanggal_masuk_kerja')} AS tanggal_mulai, {pdate('tanggal_resign')} AS tanggal_selesai,
       status, _ord
FROM {p}p1_jobs
WHERE employee_id IS NOT NULL AND subholding IS NOT NULL AND subco IS NOT NULL AND job_title IS NOT NULL
  AND tanggal_masuk_kerja IS NOT NULL
  AND {pdate('tanggal_masuk_kerja')} IS NOT NULL
  AND NOT (tanggal_resign IS NOT NULL AND {pdate('tanggal_resign')} IS NULL)""")
    cte(f"{p}p1_jobs_t", f"SELECT * FROM {p}p1_jobs_tv WHERE employee_id IN (SELECT employee_id FROM {p}st1_emp)")
    cte(f"{p}p1_jobs_w", f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(JOB_KEY)} ORDER BY _ord DESC) AS rn
FROM {p}p1_jobs_t) WHERE rn = 1""")
    cte(f"{p}st1_jobs", f"""
SELECT {_merge_select(JOB_COLS, JOB_KEY, ['employee_no_subholding', 'tanggal_selesai', 'status'], {})}
FROM (SELECT *, TRUE AS _in FROM {jobs}) s FULL OUTER JOIN (SELECT *, TRUE AS _in FROM {p}p1_jobs_w) i ON {_key_on(JOB_KEY)}""")
    cte(f"{p}p1_edu_tv", f"""
SELECT employee_id, tingkat_pendidikan, universitas, jurusan, _ord FROM {p}p1_education
WHERE employee_id IS NOT NULL AND tingkat_pendidikan IS NOT NULL AND universitas IS NOT NULL AND jurusan IS NOT NULL""")
    cte(f"{p}p1_edu_t", f"SELECT * FROM {p}p1_edu_tv WHERE employee_id IN (SELECT employee_id FROM {p}st1_emp)")
    cte(f"{p}st1_edu", f"""
SELECT {_merge_select(EDU_COLS, EDU_KEY, [], {}, do_nothing=True)}
FROM (SELECT *, TRUE AS _in FROM {edu}) s FULL OUTER JOIN (SELECT *, TRUE AS _in, CAST(NULL AS DATE) AS tanggal_masuk,
      CAST(NULL AS DATE) AS tanggal_keluar FROM {p}p1_edu_t) i ON {_key_on(EDU_KEY)}""")

    # Phase 2 against the refreshed state.
    cte(f"{p}ass_r", _resolution(p, f"{p}ass_f", 1, salt, (f"{p}st1_emp", f"{p}st1_jobs")))
    cte(f"{p}p2_employees", f"""
SELECT employee_id, {', '.join(first_by(c, 'row_id') for c in ['nik', 'nama', 'subholding', 'subco'])}
FROM (SELECT *, sub_holding AS subholding, sub_company AS subco FROM {p}ass_r)
WHERE employee_id NOT IN (SELECT employee_id FROM {p}st1_emp) GROUP BY employee_id""")
    cte(f"{p}p2_jobs", f"""
SELECT employee_id, nik, subholding, subco, job_title, tanggal_masuk_kerja, 'active' AS status, row_id AS _ord FROM (
  SELECT *, row_number() OVER (PARTITION BY employee_id, subholding, subco, job_title, tanggal_masuk_kerja ORDER BY row_id) AS rn FROM (
    SELECT employee_id, nama, nik, sub_holding AS subholding, sub_company AS subco, {job_title('job_title')} AS job_title,
           CASE WHEN regexp_extract(asessment_year, '(\\d{{4}})', 1) = '' THEN NULL
                ELSE regexp_extract(asessment_year, '(\\d{{4}})', 1) || '-01-01' END AS tanggal_masuk_kerja,
           row_id FROM {p}ass_r WHERE employee_id NOT IN (SELECT employee_id FROM {p}st1_jobs)))
WHERE rn = 1""")
    cte(f"{p}p2_assess", f"""
SELECT employee_id, asessment_year, overall_skor, min(row_id) AS _ord FROM {p}ass_r
GROUP BY employee_id, nama, nik, asessment_year, overall_skor""")
    cols = ", ".join(ROADMAP_COLS)
    cte(f"{p}p2_roadmap", f"""
SELECT employee_id, planned_position, CAST(regexp_extract(_col, '(\\d{{4}})', 1) AS INTEGER) AS year,
       min(row_id) AS _ord
FROM (UNPIVOT (SELECT employee_id, row_id, {cols} FROM {p}ass_r) ON {cols} INTO NAME _col VALUE planned_position)
WHERE planned_position IS NOT NULL AND {tr('planned_position')} <> ''
GROUP BY employee_id, planned_position, year""")

    # Phase-2 load: new employees (gender takes the table default on insert), assessments, roadmap.
    cte(f"{p}p2_emp_t", f"SELECT employee_id, nama AS fullname FROM {p}p2_employees WHERE employee_id IS NOT NULL AND nama IS NOT NULL")
    cte(f"{p}st2_emp", f"""
SELECT {_merge_select(EMP_COLS, ['employee_id'], ['fullname'], {'gender': "'Male'"})}
FROM (SELECT *, TRUE AS _in FROM {p}st1_emp) s FULL OUTER JOIN (SELECT *, TRUE AS _in FROM {p}p2_emp_t) i
  ON s.employee_id = i.employee_id""")
    cte(f"{p}p2_jobs_tv", f"""
SELECT employee_id, nik AS employee_no_subholding, subholding AS subholding_code, subco AS company_code,
       job_title AS jabatan, {pdate('tanggal_masuk_kerja')} AS tanggal_mulai, status, _ord
FROM {p}p2_jobs
WHERE employee_id IS NOT NULL AND subholding IS NOT NULL AND subco IS NOT NULL AND job_title IS NOT NULL
  AND {pdate('tanggal_masuk_kerja')} IS NOT NULL""")
    cte(f"{p}p2_jobs_t", f"SELECT * FROM {p}p2_jobs_tv WHERE employee_id IN (SELECT employee_id FROM {p}st2_emp)")
    cte(f"{p}p2_jobs_w", f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(JOB_KEY)} ORDER BY _ord DESC) AS rn
FROM {p}p2_jobs_t) WHERE rn = 1""")
    cte(f"{p}st2_jobs", f"""
SELECT {_merge_select(JOB_COLS, JOB_KEY, ['employee_no_subholding', 'status'], {})}
FROM (SELECT *, TRUE AS _in FROM {p}st1_jobs) s FULL OUTER JOIN (SELECT *, TRUE AS _in FROM {p}p2_jobs_w) i ON {_key_on(JOB_KEY)}""")
    cte(f"{p}st2_assess", f"""
SELECT employee_id, assesment_year, overal_score FROM (
  SELECT *, row_number() OVER (PARTITION BY employee_id, assesment_year ORDER BY _ord DESC) AS rn FROM (
    SELECT employee_id, TRY_CAST(asessment_year AS SMALLINT) AS assesment_year, overall_skor AS overal_score, _ord
    FROM {p}p2_assess
    WHERE employee_id IS NOT NULL AND asessment_year IS NOT NULL AND TRY_CAST(asessment_year AS SMALLINT) IS NOT NULL
      AND employee_id IN (SELECT employee_id FROM {p}st2_emp)))
WHERE rn = 1""")
    cte(f"{p}p2_road_t", f"""
SELECT employee_id, planned_position, CAST(year AS SMALLINT) AS year, _ord FROM {p}p2_roadmap
WHERE employee_id IN (SELECT employee_id FROM {p}st2_emp)""")
    cte(f"{p}st2_road", f"""
SELECT employee_id, planned_position, year FROM (
  SELECT *, row_number() OVER (PARTITION BY employee_id, year ORDER BY _ord DESC) AS rn FROM {p}p2_road_t) WHERE rn = 1""")


def _counter(jobs: str) -> str:
    return ("(SELECT CAST(coalesce(max(TRY_CAST(replace(employee_no_subholding, 'unk-', '') AS BIGINT)) + 1, 5001) AS BIGINT) "
            f"FROM {jobs} WHERE regexp_full_match(employee_no_subholding, '^unk-[0-9]+$'))")


COUNTER = _counter("db_jobs")
chain("", "db_emp_c", "db_jobs_c", "db_edu_c", COUNTER)
# another upload: the same names under other numbers
cte("raw_b", f"SELECT * REPLACE (CASE WHEN {missing('nik')} THEN nik ELSE 'B' || nik END AS nik) FROM raw_g")
chain("y_", "st2_emp", "st2_jobs", "st1_edu", _counter("st2_jobs"), "raw_b", "second")
# two uploads without an assessment, the second of other people
cte("no_ass", "SELECT * FROM ass_c WHERE false")
cte("raw_s", "SELECT * REPLACE ('B' || nik AS nik, nama || ' Second' AS nama) FROM raw_g")
chain("f_", "db_emp_c", "db_jobs_c", "db_edu_c", COUNTER, "raw_g", "a", "no_ass")
chain("g_", "f_st2_emp", "f_st2_jobs", "f_st1_edu", _counter("f_st2_jobs"), "raw_s", "b", "no_ass")
chain("x_", "empty_emp", "empty_jobs", "empty_edu", "5001")

_NAMES = [n for n, _ in CTES]


def build(final: str) -> str:
    """``WITH`` + the CTEs ``final`` needs (transitively), in definition order."""
    needed: set[str] = set()
    pending = [final]
    bodies = dict(CTES)
    while pending:
        text = pending.pop()
        for n in _NAMES:
            if n not in needed and re.search(rf"\b{re.escape(n)}\b", text):
                needed.add(n)
                pending.append(bodies[n])
    parts = [f"{n} AS ({body.strip()})" for n, body in CTES if n in needed]
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + final.strip()


# ---------------------------------------------------------------------------------------------------------------------
# Final queries
# ---------------------------------------------------------------------------------------------------------------------

TABLES = (("employees", "st2_emp"), ("riwayat_pekerjaan", "st2_jobs"), ("riwayat_pendidikan", "st1_edu"),
          ("riwayat_assesment", "st2_assess"), ("individual_career_roadmap", "st2_road"))
JOB_SUBSET = "employee_id, subholding, subco, job_title, tanggal_masuk_kerja"


def _upsert_stats(table: str, given: str, key_match: str, do_nothing: bool = False) -> str:
    upd = "0" if do_nothing else "count(*) FILTER (WHERE m)"
    ign = "count(*) FILTER (WHERE m)" if do_nothing else "0"
    return f"""
SELECT '{table}' AS table_name, CAST((SELECT count(*) FROM {given}) AS BIGINT) AS given,
  CAST(count(*) AS BIGINT) AS distinct_keys,
  CAST(count(*) FILTER (WHERE NOT m) AS BIGINT) AS inserted, CAST({upd} AS BIGINT) AS updated,
  CAST({ign} AS BIGINT) AS ignored,
  CAST(count(*) FILTER (WHERE NOT m) + {upd} AS BIGINT) AS rows_affected,
  CAST((SELECT count(*) FROM {given}) - count(*) AS BIGINT) AS collapsed
FROM ({key_match})"""


FINAL: dict[str, str] = {
    "ingest_clean": "SELECT * FROM raw_c",
    "header_match": "SELECT * FROM raw_c",
    "blank_default": f"SELECT row_id, {job_title('job_title')} AS job_title FROM raw_data",
    "gender_normalize": f"SELECT row_id, {gender('jenis_kelamin')} AS jenis_kelamin FROM raw_data",
    "target_projection": """
SELECT nama AS fullname, tanggal_lahir AS birth_date, jenis_kelamin AS gender FROM raw_c
WHERE NOT (nama IS NULL AND tanggal_lahir IS NULL AND jenis_kelamin IS NULL)""",
    "key_complete": """
SELECT employee_id, nik AS employee_no_subholding, subholding AS subholding_code, subco AS company_code,
       job_title AS jabatan, tanggal_masuk_kerja AS tanggal_mulai, tanggal_resign AS tanggal_selesai, status
FROM p1_jobs WHERE employee_id IS NOT NULL AND subholding IS NOT NULL AND subco IS NOT NULL AND job_title IS NOT NULL
  AND tanggal_masuk_kerja IS NOT NULL""",
    "date_coerce": f"""
SELECT row_id, {pdate('tanggal_lahir', past=True)} AS birth_date, {pdate('tanggal_masuk_kerja')} AS tanggal_mulai,
       {pdate('tanggal_resign')} AS tanggal_selesai FROM raw_c""",
    "pattern_filter": """
SELECT e.fullname, j.employee_no_subholding FROM db_employees e JOIN db_jobs j ON e.employee_id = j.employee_id
WHERE e.fullname ILIKE '%customer#%' AND j.employee_no_subholding LIKE 'unk-%'
  AND regexp_full_match(j.employee_no_subholding, '^unk-[0-9]+$')""",
    "golden_record": f"""
SELECT nik, {', '.join(first_by(c, 'y DESC NULLS LAST, row_id') for c in
                      ['nama', 'tanggal_lahir', 'jenis_kelamin', 'subholding', 'subco', 'job_title'])}
FROM (SELECT nik, nama, tanggal_lahir, jenis_kelamin, subholding, subco, {job_title('job_title')} AS job_title,
             {number('tahun')} AS y, row_id FROM raw_c)
WHERE nik IS NOT NULL GROUP BY nik""",
    "employees_from_roster": "SELECT * FROM p1_employees",
    "education_history": "SELECT employee_id, tingkat_pendidikan, universitas, jurusan FROM p1_education",
    "job_history": "SELECT * EXCLUDE (_ord) FROM p1_jobs",
    "duplicate_rows": f"""
SELECT row_id, employee_id, nama, nik, job_title FROM (
  SELECT *, row_number() OVER (PARTITION BY {JOB_SUBSET} ORDER BY row_id) AS rn FROM job_src) WHERE rn > 1""",
    "duplicate_names": f"""
SELECT fullname, {cnt()} AS n FROM st2_emp WHERE fullname IS NOT NULL GROUP BY fullname HAVING count(*) > 1""",
    "next_counter": f"SELECT {COUNTER} AS next_counter",
    "existing_key_lookup": "SELECT name_key, existing_key FROM existing",
    "state_lookup": """
SELECT DISTINCT e.employee_id, e.fullname, j.employee_no_subholding
FROM db_employees e LEFT JOIN db_jobs j ON e.employee_id = j.employee_id""",
    "missing_names": "SELECT nama, first_sheet, first_row_id FROM missing_names",
    "fill_missing_key": "SELECT 0 AS sheet, row_id, nama, nik FROM raw_f UNION ALL SELECT 1 AS sheet, row_id, nama, nik FROM ass_f",
    "entity_resolve": "SELECT row_id, nik, nama, employee_id, match_kind FROM raw_r",
    "match_stats": f"""
SELECT 0 AS sheet, match_kind, {cnt()} AS n FROM raw_r GROUP BY match_kind
UNION ALL SELECT 1 AS sheet, match_kind, {cnt()} AS n FROM ass_r GROUP BY match_kind""",
    "new_employees": "SELECT employee_id, nik, nama, subholding, subco FROM p2_employees",
    "job_history_supplement": "SELECT employee_id, nik, subholding, subco, job_title, tanggal_masuk_kerja, status FROM p2_jobs",
    "assessment_history": "SELECT employee_id, asessment_year, overall_skor FROM p2_assess",
    "career_roadmap": "SELECT employee_id, planned_position, year FROM p2_roadmap",
    "merge_phases": """
SELECT employee_id, nik, nama, tanggal_lahir, jenis_kelamin, subholding, subco, job_title FROM x_p1_employees
UNION ALL
SELECT employee_id, nik, nama, NULL, NULL, subholding, subco, NULL FROM x_p2_employees""",
    "upsert_state": "SELECT * FROM st1_emp",
    "insert_ignore": "SELECT * FROM st1_edu",
    "append_rows": "SELECT * FROM db_jobs_c UNION ALL SELECT " + ", ".join(
        c if c in ("employee_id", "employee_no_subholding", "subholding_code", "company_code", "jabatan", "tanggal_mulai",
                   "tanggal_selesai", "status") else f"CAST(NULL AS VARCHAR) AS {c}" for c in JOB_COLS) + " FROM p1_jobs_t",
    "default_fill": f"""
SELECT e.*, CASE WHEN d.employee_id IS NULL THEN '{LOADED}' END AS created_at, CASE WHEN d.employee_id IS NULL THEN '{LOADED}' END AS updated_at
FROM st2_emp e LEFT JOIN db_emp_c d ON d.employee_id = e.employee_id""",
    "upsert_stats": " UNION ALL ".join([
        _upsert_stats("employees", "p1_emp_t",
                      "SELECT i.employee_id, s.employee_id IS NOT NULL AS m FROM p1_emp_t i "
                      "LEFT JOIN db_emp_c s ON s.employee_id = i.employee_id"),
        _upsert_stats("riwayat_pekerjaan", "p1_jobs_t",
                      "SELECT i.employee_id, s.employee_id IS NOT NULL AS m FROM p1_jobs_w i LEFT JOIN db_jobs_c s ON "
                      + _key_on(JOB_KEY)),
        _upsert_stats("riwayat_pendidikan", "p1_edu_t",
                      "SELECT DISTINCT i.employee_id, i.tingkat_pendidikan, i.universitas, i.jurusan, "
                      "s.employee_id IS NOT NULL AS m FROM p1_edu_t i LEFT JOIN db_edu_c s ON " + _key_on(EDU_KEY),
                      do_nothing=True),
    ]),
    "cascade_delete": " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, CAST(count(*) FILTER (WHERE doomed) AS BIGINT) AS deleted, CAST(count(*) FILTER (WHERE NOT doomed) AS BIGINT) AS remaining,
  CAST(count(*) FILTER (WHERE doomed) AS BIGINT) AS binned
FROM (SELECT employee_id IN (SELECT employee_id FROM st2_emp WHERE fullname ILIKE '%customer#%7') AS doomed FROM {src})"""
        for t, src in TABLES
    ),
    "fk_filter": " UNION ALL ".join(
        f"""SELECT '{t}' AS dataset, CAST(count(*) FILTER (WHERE employee_id IN (SELECT employee_id FROM db_employees)) AS BIGINT) AS kept,
  CAST(count(*) FILTER (WHERE employee_id NOT IN (SELECT employee_id FROM db_employees)) AS BIGINT) AS orphaned FROM {src}"""
        for t, src in (("riwayat_pekerjaan", "p1_jobs_tv"), ("riwayat_pendidikan", "p1_edu_tv"))
    ),
    "incomplete_entities": " UNION ALL ".join(
        f"SELECT '{label}' AS check_name, employee_id, fullname FROM st2_emp "
        f"WHERE employee_id NOT IN (SELECT employee_id FROM {src})"
        for label, src in (("no_education", "st1_edu"), ("no_assessment", "st2_assess"), ("no_roadmap", "st2_road"))
    ),
    "table_counts": " UNION ALL ".join(
        [f"SELECT 'employees' AS tabel, {cnt()} AS n FROM st2_emp WHERE fullname ILIKE 'vendor %'"]
        + [f"SELECT '{t}' AS tabel, {cnt()} AS n FROM {src} "
           f"WHERE employee_id IN (SELECT employee_id FROM st2_emp WHERE fullname ILIKE 'vendor %')"
           for t, src in (("riwayat_pekerjaan", "st2_jobs"), ("riwayat_pendidikan", "st1_edu"),
                          ("riwayat_assesment", "st2_assess"), ("individual_career_roadmap", "st2_road"))]
    ),
    "check_unique": f"""
SELECT 'riwayat_assesment' AS table_name,
  concat_ws('|', coalesce(employee_id, '<null>'), coalesce(asessment_year, '<null>')) AS key_value, {cnt()} AS n
FROM p2_assess GROUP BY employee_id, asessment_year HAVING count(*) > 1
UNION ALL
SELECT 'individual_career_roadmap', concat_ws('|', coalesce(employee_id, '<null>'), coalesce(CAST(year AS VARCHAR), '<null>')),
  {cnt()} FROM p2_roadmap GROUP BY employee_id, year HAVING count(*) > 1
UNION ALL
SELECT 'riwayat_pekerjaan', concat_ws('|', {', '.join(f"coalesce({c}, '<null>')" for c in JOB_SUBSET.split(', '))}),
  {cnt()} FROM p1_jobs GROUP BY {JOB_SUBSET} HAVING count(*) > 1""",
    "check_fk": " UNION ALL ".join(
        f"""SELECT '{rel}' AS relation, {cnt()} AS checked,
  CAST(count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{ck})) AS BIGINT) AS orphans
FROM {child} c WHERE c.{ck} IS NOT NULL"""
        for rel, child, ck, parent, pk in (
            ("lineitem.l_orderkey->orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("orders.o_custkey->customer", "orders", "o_custkey", "customer", "c_custkey"),
            ("riwayat_pekerjaan.employee_id->employees", "db_jobs", "employee_id", "db_employees", "employee_id"),
        )
    ),
    "check_domain": f"""
SELECT 'raw_data' AS table_name, 'jenis_kelamin' AS column_name, jenis_kelamin AS value, {cnt()} AS n FROM raw_c
WHERE jenis_kelamin IS NOT NULL AND jenis_kelamin NOT IN ('Male', 'Female') GROUP BY jenis_kelamin
UNION ALL
SELECT 'employees', 'gender', gender, {cnt()} FROM st1_emp
WHERE gender IS NOT NULL AND gender NOT IN ('Male', 'Female') GROUP BY gender
UNION ALL
SELECT 'riwayat_pekerjaan', 'status', status, {cnt()} FROM st1_jobs
WHERE status IS NOT NULL AND status NOT IN ('active', 'inactive') GROUP BY status
UNION ALL
SELECT 'riwayat_pendidikan', 'tingkat_pendidikan', tingkat_pendidikan, {cnt()} FROM st1_edu
WHERE tingkat_pendidikan IS NOT NULL AND tingkat_pendidikan NOT IN ('S1', 'S2') GROUP BY tingkat_pendidikan""",
    "check_not_null": " UNION ALL ".join(
        f"SELECT 'raw_data' AS table_name, '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls FROM raw_c"
        for c in ("nik", "nama", "tanggal_masuk_kerja")
    ),
    "change_log": f"""
SELECT 'employees' AS entity_type, coalesce(a.employee_id, b.employee_id) AS employee_id,
  CASE WHEN b._in IS NULL THEN 'INSERT' WHEN a._in IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS action_type
FROM (SELECT *, TRUE AS _in FROM db_emp_c) b FULL OUTER JOIN (SELECT *, TRUE AS _in FROM st1_emp) a
  ON a.employee_id IS NOT DISTINCT FROM b.employee_id
WHERE b._in IS NULL OR a._in IS NULL OR {' OR '.join(f'a.{c} IS DISTINCT FROM b.{c}' for c in EMP_COLS)}""",
    "load_report": f"""
SELECT 'employees' AS dataset,
  CAST((SELECT count(*) FROM p1_emp_t) + (SELECT count(*) FROM p2_emp_t) AS BIGINT) AS rows_upserted, TRUE AS success
UNION ALL SELECT 'riwayat_pekerjaan', CAST((SELECT count(*) FROM p1_jobs_w) + (SELECT count(*) FROM p2_jobs_w) AS BIGINT), TRUE
UNION ALL SELECT 'riwayat_pendidikan',
  CAST((SELECT count(*) FROM (SELECT DISTINCT {', '.join('i.' + k for k in EDU_KEY)} FROM p1_edu_t i
        WHERE NOT EXISTS (SELECT 1 FROM db_edu_c s WHERE {_key_on(EDU_KEY)}))) AS BIGINT), TRUE
UNION ALL SELECT 'riwayat_assesment', CAST((SELECT count(*) FROM st2_assess) AS BIGINT),
  (SELECT count(*) FROM st2_assess) > 0
UNION ALL SELECT 'individual_career_roadmap', CAST((SELECT count(*) FROM st2_road) AS BIGINT), TRUE""",
    "pipeline_counts": f"""
SELECT 'employees' AS table_name, {cnt()} AS n FROM st2_emp
UNION ALL SELECT 'riwayat_pendidikan', {cnt()} FROM st1_edu
UNION ALL SELECT 'riwayat_pekerjaan', {cnt()} FROM st2_jobs
UNION ALL SELECT 'riwayat_assesment', {cnt()} FROM st2_assess
UNION ALL SELECT 'individual_career_roadmap', {cnt()} FROM st2_road""",
}

# A restored state is the state before the delete, a streamed upload ends where a direct one does, a second upload of the
# same sheets changes nothing, an export holds every row of the merged datasets.
_cells = lambda *cols: "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in cols) + ")"
FINAL["recycle_restore"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, employee_id, {_cells(*cols)} AS cells FROM {src}"
    for (t, src), cols in zip(TABLES, (
        ("fullname", "birth_date", "gender"),
        ("subholding_code", "company_code", "jabatan", "tanggal_mulai", "employee_no_subholding", "tanggal_selesai", "status"),
        ("tingkat_pendidikan", "universitas", "jurusan"), ("assesment_year", "overal_score"), ("year", "planned_position")))
)
FINAL["stream_upsert"] = "SELECT * FROM st2_emp"
FINAL["upload_files"] = FINAL["pipeline_counts"]
FINAL["stream_with_bad_upload"] = FINAL["pipeline_counts"] + " UNION ALL SELECT 'quarantine', CAST(2 AS BIGINT)"
FINAL["reload_noop"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST((SELECT count(*) FROM {a}) AS BIGINT) AS rows_first, "
    f"CAST((SELECT count(*) FROM {a}) AS BIGINT) AS rows_second, CAST(0 AS BIGINT) AS changed"
    for t, a in (("employees", "st2_emp"), ("riwayat_pendidikan", "st1_edu"), ("riwayat_pekerjaan", "st2_jobs"),
                 ("riwayat_assesment", "st2_assess"), ("individual_career_roadmap", "st2_road"))
)
FINAL["two_uploads"] = f"""
SELECT fullname, {cnt()} AS people FROM y_st2_emp WHERE {tokens('fullname')} = 1 GROUP BY fullname"""
FINAL["export_datasets"] = " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, CAST({' + '.join(f'(SELECT count(*) FROM x_{src})' for src in parts)} AS BIGINT) AS n"
    for t, parts in (("employees", ("p1_employees", "p2_employees")), ("riwayat_pendidikan", ("p1_education",)),
                     ("riwayat_pekerjaan", ("p1_jobs", "p2_jobs")), ("riwayat_assesment", ("p2_assess",)),
                     ("individual_career_roadmap", ("p2_roadmap",)))
)
FINAL["stream_change_feed"] = f"""
SELECT 'employees' AS entity_type, coalesce(a.employee_id, b.employee_id) AS entity_id,
  CASE WHEN b._in IS NULL THEN 'INSERT' WHEN a._in IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS action_type
FROM (SELECT *, TRUE AS _in FROM db_emp_c) b FULL OUTER JOIN (SELECT *, TRUE AS _in FROM st2_emp) a ON a.employee_id = b.employee_id
WHERE b._in IS NULL OR a._in IS NULL OR {' OR '.join(f'a.{c} IS DISTINCT FROM b.{c}' for c in EMP_COLS)}
UNION ALL SELECT 'riwayat_pekerjaan', concat_ws('|', {', '.join(f'CAST({k} AS VARCHAR)' for k in JOB_KEY)}), 'INSERT' FROM (SELECT {', '.join(JOB_KEY)} FROM p1_jobs_w UNION ALL SELECT {', '.join(JOB_KEY)} FROM p2_jobs_w)
UNION ALL SELECT DISTINCT 'riwayat_pendidikan', concat_ws('|', {', '.join('i.' + k for k in EDU_KEY)}), 'INSERT' FROM p1_edu_t i
  WHERE NOT EXISTS (SELECT 1 FROM db_edu_c s WHERE {_key_on(EDU_KEY)})
UNION ALL SELECT 'riwayat_assesment', concat_ws('|', employee_id, CAST(assesment_year AS VARCHAR)), 'INSERT' FROM st2_assess
UNION ALL SELECT 'individual_career_roadmap', concat_ws('|', employee_id, CAST(year AS VARCHAR)), 'INSERT' FROM st2_road"""

def _n(source: str) -> str:
    return f"(SELECT count(*) FROM {source})"


_WHOLE_JOB = ("WHERE employee_id IS NOT NULL AND subholding IS NOT NULL AND subco IS NOT NULL AND job_title IS NOT NULL "
              "AND tanggal_masuk_kerja IS NOT NULL")
_YEARS = "(SELECT employee_id, TRY_CAST(asessment_year AS SMALLINT) AS y FROM p2_assess WHERE asessment_year IS NOT NULL)"
# Rows that did not get in, by table: cells that don't fit the target's types, and dependents without their employee.
FINAL["load_rejects"] = " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, CAST({rejected} AS BIGINT) AS rejected, CAST({orphaned} AS BIGINT) AS orphaned"
    for t, rejected, orphaned in (
        ("employees", f"{_n('p1_employees')} - {_n('p1_emp_t')} + {_n('p2_employees')} - {_n('p2_emp_t')}", "0"),
        ("riwayat_pekerjaan",
         f"{_n('p1_jobs ' + _WHOLE_JOB)} - {_n('p1_jobs_tv')} + {_n('p2_jobs ' + _WHOLE_JOB)} - {_n('p2_jobs_tv')}",
         f"{_n('p1_jobs_tv')} - {_n('p1_jobs_t')} + {_n('p2_jobs_tv')} - {_n('p2_jobs_t')}"),
        ("riwayat_pendidikan", "0", f"{_n('p1_edu_tv')} - {_n('p1_edu_t')}"),
        ("riwayat_assesment", _n(_YEARS + " WHERE y IS NULL"),
         _n(_YEARS + " WHERE y IS NOT NULL AND employee_id NOT IN (SELECT employee_id FROM st2_emp)")),
        ("individual_career_roadmap", "0", f"{_n('p2_roadmap')} - {_n('p2_road_t')}"),
    )
)
# Where every given row went.
_PLACES = (
    ("employees", f"{_n('p1_employees')} + {_n('p2_employees')}", f"{_n('p1_emp_t')} + {_n('p2_emp_t')}", f"{_n('p1_emp_t')} + {_n('p2_emp_t')}", "0"),
    ("riwayat_pekerjaan", f"{_n('p1_jobs')} + {_n('p2_jobs')}", f"{_n('p1_jobs_t')} + {_n('p2_jobs_t')}", f"{_n('p1_jobs_w')} + {_n('p2_jobs_w')}",
     f"{_n('p1_jobs')} - {_n('p1_jobs ' + _WHOLE_JOB)} + {_n('p2_jobs')} - {_n('p2_jobs ' + _WHOLE_JOB)}"),
    ("riwayat_pendidikan", _n("p1_education"), _n("p1_edu_t"), f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(EDU_KEY)} FROM p1_edu_t))",
     f"{_n('p1_education')} - {_n('p1_edu_tv')}"),
    ("riwayat_assesment", _n("p2_assess"), _n(_YEARS + " WHERE y IS NOT NULL AND employee_id IN (SELECT employee_id FROM st2_emp)"), _n("st2_assess"),
     _n("p2_assess WHERE asessment_year IS NULL")),
    ("individual_career_roadmap", _n("p2_roadmap"), _n("p2_road_t"), _n("st2_road"), "0"),
)
FINAL["load_accounting"] = "SELECT *, CAST(incomplete + rejected + orphaned AS BIGINT) AS reject_rows, CAST(0 AS BIGINT) AS unaccounted FROM (" + " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, CAST({given} AS BIGINT) AS given, CAST({loaded} AS BIGINT) AS loaded, CAST({valid} - ({loaded}) AS BIGINT) AS collapsed, "
    f"CAST(0 AS BIGINT) AS empty, CAST({incomplete} AS BIGINT) AS incomplete"
    for t, given, valid, loaded, incomplete in _PLACES
) + ") JOIN (" + FINAL["load_rejects"] + ") USING (dataset)"


def _refused(t: str, src: str, emp: str, items: list[str], incomplete: str, rejected: str, given: str = "TRUE") -> str:
    return f"""
SELECT '{t}' AS dataset, CASE WHEN {incomplete} THEN 'incomplete' WHEN {rejected} THEN 'rejected' ELSE 'orphaned' END AS reason, employee_id, {_cells(*items) if items else "''"} AS item
FROM {src} WHERE ({incomplete}) OR ({rejected}) OR employee_id NOT IN (SELECT employee_id FROM {emp})"""


_JOB_ITEMS = ["subholding", "subco", "job_title", "tanggal_masuk_kerja"]
_any_null = lambda cols: " OR ".join(f"{c} IS NULL" for c in cols)
_bad_date = lambda c, past=False: f"({c} IS NOT NULL AND {pdate(c, past=past)} IS NULL)"
_NEVER = "employee_id IS NULL"
FINAL["reject_rows"] = " UNION ALL ".join([
    f"SELECT 'employees' AS dataset, 'rejected' AS reason, employee_id, '' AS item FROM p1_employees WHERE nama IS NULL OR {_bad_date('tanggal_lahir', True)}",
    "SELECT 'employees', 'rejected', employee_id, '' FROM p2_employees WHERE nama IS NULL",
    _refused("riwayat_pekerjaan", "p1_jobs", "st1_emp", _JOB_ITEMS, _any_null(_JOB_ITEMS), f"{_bad_date('tanggal_masuk_kerja')} OR {_bad_date('tanggal_resign')}"),
    _refused("riwayat_pekerjaan", "p2_jobs", "st2_emp", _JOB_ITEMS, _any_null(_JOB_ITEMS), _bad_date("tanggal_masuk_kerja")),
    _refused("riwayat_pendidikan", "p1_education", "st1_emp", EDU_KEY[1:], _any_null(EDU_KEY[1:]), _NEVER),
    _refused("riwayat_assesment", "p2_assess", "st2_emp", ["asessment_year"], "asessment_year IS NULL", "TRY_CAST(asessment_year AS SMALLINT) IS NULL"),
    _refused("individual_career_roadmap", "p2_roadmap", "st2_emp", ["year"], _NEVER, _NEVER),
])
FINAL["dedup_stats"] = " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, CAST({_n(sheet)} AS BIGINT) AS rows_in, CAST({_n(full)} AS BIGINT) AS non_empty, "
    f"CAST({_n(full)} - {_n(out)} AS BIGINT) AS dropped, CAST({_n(out)} AS BIGINT) AS rows_out"
    for t, sheet, full, out in (
        ("riwayat_pekerjaan", "raw_r", "raw_r", "p1_jobs"),
        ("riwayat_pendidikan", "raw_r", "raw_r WHERE NOT (tingkat_pendidikan IS NULL AND universitas IS NULL AND jurusan IS NULL)", "p1_education"),
        ("riwayat_assesment", "ass_c", "ass_r", "p2_assess"))
)
FINAL["gender_defaults"] = f"""
SELECT upper({tr('jenis_kelamin')}) AS value, {cnt()} AS n FROM raw_c
WHERE jenis_kelamin IS NULL OR upper({tr('jenis_kelamin')}) NOT IN ('LAKI-LAKI', 'PEREMPUAN', 'L', 'P', 'M', 'F') GROUP BY 1"""
FINAL["ingest_files"] = "SELECT row_number() OVER (ORDER BY row_id) - 1 AS row_id, " + ", ".join(
    f"replace({c}, 'Univ ', 'Univ \"of\"' || chr(10)) AS {c}" if c == "universitas" else c for c in RAW_TEXT_COLS) + " FROM raw_c"


def _feed(owner: str, p: str, emp: str, jobs: str, edu: str) -> str:
    """Numbers of an upload's changes against the tables before it."""
    changed = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in EMP_COLS)
    return f"""
SELECT '{owner}' AS upload_id, 'employees' AS entity_type, CASE WHEN b._in IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS action_type, a.employee_id AS entity_id
FROM {p}st2_emp a LEFT JOIN (SELECT *, TRUE AS _in FROM {emp}) b ON a.employee_id = b.employee_id WHERE b._in IS NULL OR {changed}
UNION ALL SELECT '{owner}', 'riwayat_pekerjaan', 'INSERT', concat_ws('|', {', '.join(f'CAST(i.{k} AS VARCHAR)' for k in JOB_KEY)}) FROM {p}p1_jobs_w i
  WHERE NOT EXISTS (SELECT 1 FROM {jobs} s WHERE {_key_on(JOB_KEY)})
UNION ALL SELECT DISTINCT '{owner}', 'riwayat_pendidikan', 'INSERT', concat_ws('|', {', '.join('i.' + k for k in EDU_KEY)}) FROM {p}p1_edu_t i
  WHERE NOT EXISTS (SELECT 1 FROM {edu} s WHERE {_key_on(EDU_KEY)})"""


FINAL["feed_after_failure"] = f"""
SELECT upload_id, entity_type, action_type, {cnt()} AS n, {cnt('DISTINCT entity_id')} AS entities FROM (
{_feed("a", "f_", "db_emp_c", "db_jobs_c", "db_edu_c")} UNION ALL {_feed("b", "g_", "f_st2_emp", "f_st2_jobs", "f_st1_edu")}) GROUP BY upload_id, entity_type, action_type"""
# A roster without names gives no valid master row, so nothing else is loaded.
FINAL["gate_closed"] = " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, '{status}' AS status, {cnt()} AS rows_in_table FROM {src}"
    for t, status, src in (("employees", "empty", "db_emp_c"), ("riwayat_pekerjaan", "skipped", "db_jobs_c"),
                           ("riwayat_pendidikan", "skipped", "db_edu_c"))
)
# The tables' rows after an upload, where several given rows share a key: the last one's values.
FINAL["final_tables"] = """
SELECT 'riwayat_pekerjaan' AS table_name, employee_id,
  concat_ws('|', subholding_code, company_code, jabatan, CAST(tanggal_mulai AS VARCHAR)) AS item,
  concat_ws('|', employee_no_subholding, CAST(tanggal_selesai AS VARCHAR), status) AS value FROM st2_jobs
UNION ALL SELECT 'riwayat_assesment', employee_id, CAST(assesment_year AS VARCHAR), overal_score FROM st2_assess
UNION ALL SELECT 'individual_career_roadmap', employee_id, CAST(year AS VARCHAR), planned_position FROM st2_road"""

#: Keys without a SQL text.
ROWS_ONLY: tuple[str, ...] = ()


def oracle_sql() -> dict[str, str]:
    return {k: build(v) for k, v in FINAL.items()}
