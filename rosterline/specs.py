"""Column and dataset specifications.

Everything in this module is configuration: the names the two input sheets use, the target tables, their keys and
column maps.  Operators take these as parameters, so another workbook layout only needs another spec.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------------------------------
# FIXED VALUES — header spellings of the two input sheets, target table names, conflict keys and column maps.  They must
# equal what the source workbook and the target tables use, so they are stated here as plain text, in their natural order.
# Each entry is (internal column name, workbook header).
# ---------------------------------------------------------------------------------------------------------------------

ROSTER_COLUMNS: tuple[tuple[str, str], ...] = (
    ("tahun", "TAHUN"),
    ("nik", "NIK/NIP"),
    ("nama", "NAMA"),
    ("tanggal_lahir", "TANGGAL LAHIR"),
    ("agama", "AGAMA"),
    ("jenis_kelamin", "JENIS KELAMIN"),
    ("subholding", "SUBHOLDING"),
    ("subco", "SUBCO"),
    ("divisi", "DIVISI"),
    ("department", "DEPARTMENT"),
    ("level", "LEVEL"),
    ("job_title", "JOB TITLE"),
    ("function", "FUNCTION"),
    ("gol", "GOL"),
    ("kj", "KJ"),
    ("tanggal_masuk_kerja", "TANGGAL MASUK KERJA"),
    ("tanggal_resign", "TANGGAL RESIGN/MUTASI"),
    ("tingkat_pendidikan", "TINGKAT PENDIDIKAN"),
    ("universitas", "UNIVERSITAS"),
    ("jurusan", "JURUSAN"),
    ("tanggal_masuk_pendidikan", "TANGGAL MASUK PENDIDIKAN"),
    ("tanggal_keluar_pendidikan", "TANGGAL KELUAR PENDIDIKAN"),
    ("tanggal_selesai_pendidikan", "TANGGAL SELESAI PENDIDIKAN"),
)

ROADMAP_YEARS: tuple[int, ...] = (2023, 2024, 2025, 2026, 2027, 2028, 2029, 2030, 2031, 2032)

ASSESSMENT_COLUMNS: tuple[tuple[str, str], ...] = (
    ("nik", "NIK/NIP"),
    ("nama", "NAMA"),
    ("sub_holding", "SUB HOLDING"),
    ("sub_company", "SUB COMPANY"),
    ("job_title", "JOB TITLE"),
    ("asessment_year", "Asessment Year"),
    ("remarks", "Remarks"),
    ("age", "AGE"),
    ("int_int", "INT_INT"),
    ("exc_int", "EXC_INT"),
    ("comp_int", "COMP_INT"),
    ("hum_int", "HUM_INT"),
    ("adm_int", "ADM_INT"),
    ("plc_int", "PLC_INT"),
    ("mch_int", "MCH_INT"),
    ("ftw_int", "FTW_INT"),
    ("emp_int", "EMP_INT"),
    ("people", "PEOPLE"),
    ("organization", "ORGANIZATION"),
    ("business", "BUSINESS"),
    ("persistent", "PERSISTENT"),
    ("perseverance", "PERSEVERANCE"),
    ("passion", "PASSION"),
    ("grit", "GRIT"),
    ("value_driven", "Value Driven"),
    ("leadership_comp", "Leadership Comp"),
    ("business_comp", "Business Comp"),
    ("technical_comp", "Technical Comp"),
    ("overall_skor", "OVERALL_SKOR"),
    ("talent_class", "TALENT CLASS"),
    ("strength", "STRENGTH"),
    ("area_of_development", "AREA OF DEVELOPMENT (GAP)"),
    ("idp", "IDP"),
    ("iq", "IQ"),
    ("disc", "DISC"),
    ("hav", "HAV"),
    ("hav_tia", "HAV_TIA"),
)  # besides road_map_<year>, for whichever years a sheet has (ROADMAP_COLUMN_RE)

# Sheet names accepted for the two inputs (matched case- and space-insensitively).
ROSTER_SHEET_NAMES: tuple[str, ...] = ("Raw Data",)
ASSESSMENT_SHEET_NAMES: tuple[str, ...] = ("Assesment", "Assessment")

# FIXED VALUES: gender normalisation, upper-cased, stripped cell → value; anything else (blank, null, unknown) → GENDER_DEFAULT.
GENDER_MAP: dict[str, str] = {
    "LAKI-LAKI": "Male",
    "PEREMPUAN": "Female",
    "L": "Male",
    "P": "Female",
    "M": "Male",
    "F": "Female",
}
GENDER_DEFAULT = "Male"
GENDER_DOMAIN: tuple[str, ...] = ("Male", "Female")

# Generated business keys.
UNK_PREFIX = "unk-"
UNK_DEFAULT_START = 5001
JOB_TITLE_DEFAULT = "Unknown"
JOB_STATUS = "active"
JOB_STATUS_ENDED = "inactive"
JOB_STATUS_DOMAIN: tuple[str, ...] = (JOB_STATUS, JOB_STATUS_ENDED)

# Cell texts that mean "empty" after stripping.
EMPTY_TOKENS: tuple[str, ...] = ("nan", "NaN", "")

# Date patterns tried in order when text is coerced to DATE.
DATE_PATTERNS: tuple[str, ...] = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy", "dd/MM/yy")

# Whitespace removed by cell stripping: the characters Python's str.strip() removes.
STRIP_CHARS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


# ---------------------------------------------------------------------------------------------------------------------
# Target tables.
# ---------------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class DatasetSpec:
    """One target table: where it goes, its conflict key, how transform columns map to it and its typed schema."""

    name: str
    target: str
    key: tuple[str, ...]
    column_map: tuple[tuple[str, str], ...]  # (transform column, target column), in load order
    schema: T.StructType
    defaults: tuple[tuple[str, str], ...] = field(default=())  # (target column, SQL default applied on insert only)
    not_null: tuple[str, ...] = field(default=())  # non-key columns the table declares NOT NULL
    parents: tuple[str, ...] = field(default=())  # tables that must hold rows before this one is loaded
    past_dates: tuple[str, ...] = field(default=())  # dates that can't lie in the future (two-digit years)

    @property
    def target_columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


S, D, SH, TS = T.StringType(), T.DateType(), T.ShortType(), T.TimestampType()

#: Default of a column that takes the time of the load.
NOW = "now()"

# FIXED VALUES — target tables, conflict keys and column maps, in load order.
EMPLOYEES = DatasetSpec(
    name="employees",
    target="employees",
    key=("employee_id",),
    column_map=(
        ("employee_id", "employee_id"),
        ("nama", "fullname"),
        ("tanggal_lahir", "birth_date"),
        ("jenis_kelamin", "gender"),
    ),
    schema=_schema(("employee_id", S), ("fullname", S), ("birth_date", D), ("gender", S), ("agama", S), ("created_at", TS), ("updated_at", TS)),
    defaults=(("gender", "'Male'"), ("created_at", NOW), ("updated_at", NOW)),
    not_null=("fullname",),
    past_dates=("birth_date",),
)

EDUCATION = DatasetSpec(
    name="riwayat_pendidikan",
    target="riwayat_pendidikan",
    parents=("employees",),
    key=("employee_id", "tingkat_pendidikan", "universitas", "jurusan"),
    column_map=(
        ("employee_id", "employee_id"),
        ("tingkat_pendidikan", "tingkat_pendidikan"),
        ("universitas", "universitas"),
        ("jurusan", "jurusan"),
        ("tanggal_masuk_pendidikan", "tanggal_masuk"),
        ("tanggal_keluar_pendidikan", "tanggal_keluar"),
    ),
    schema=_schema(
        ("employee_id", S), ("tingkat_pendidikan", S), ("universitas", S), ("jurusan", S),
        ("tanggal_masuk", D), ("tanggal_keluar", D),
    ),
)

JOBS = DatasetSpec(
    name="riwayat_pekerjaan",
    target="riwayat_pekerjaan",
    parents=("employees",),
    key=("employee_id", "subholding_code", "company_code", "jabatan", "tanggal_mulai"),
    column_map=(
        ("employee_id", "employee_id"),
        ("nik", "employee_no_subholding"),
        ("subholding", "subholding_code"),
        ("subco", "company_code"),
        ("divisi", "divisi"),
        ("department", "department"),
        ("level", "level_jabatan"),
        ("job_title", "jabatan"),
        ("function", "functions"),
        ("gol", "golongan"),
        ("kj", "kelompok_jabatan"),
        ("tanggal_masuk_kerja", "tanggal_mulai"),
        ("tanggal_resign", "tanggal_selesai"),
        ("status", "status"),
    ),
    schema=_schema(
        ("employee_id", S), ("employee_no_subholding", S), ("subholding_code", S), ("company_code", S),
        ("divisi", S), ("department", S), ("level_jabatan", S), ("jabatan", S), ("functions", S),
        ("golongan", S), ("kelompok_jabatan", S), ("tanggal_mulai", D), ("tanggal_selesai", D), ("status", S),
        ("created_at", TS), ("updated_at", TS),
    ),
    defaults=(("created_at", NOW), ("updated_at", NOW)),
)

_ASSESSMENT_SCORE_MAP = (
    ("int_int", "integ_int"), ("exc_int", "exc_int"), ("comp_int", "comp_int"), ("hum_int", "hum_int"),
    ("adm_int", "adm_int"), ("plc_int", "plc_int"), ("mch_int", "mch_int"), ("ftw_int", "ftw_int"),
    ("emp_int", "emp_int"), ("people", "people"), ("organization", "organization"), ("business", "business"),
    ("persistent", "persistent"), ("perseverance", "perseverance"), ("passion", "passion"), ("grit", "grit"),
    ("value_driven", "value_driven"), ("leadership_comp", "leadership_comp"), ("business_comp", "business_comp"),
    ("technical_comp", "technical_comp"), ("overall_skor", "overal_score"), ("talent_class", "talent_class"),
    ("strength", "strength"), ("area_of_development", "area_of_dev"), ("idp", "idp"), ("iq", "iq"),
    ("disc", "disc"), ("hav", "hav"), ("hav_tia", "hav_tia"),
)

ASSESSMENTS = DatasetSpec(
    name="riwayat_assesment",
    target="riwayat_assesment",
    parents=("employees",),
    key=("employee_id", "assesment_year"),
    column_map=(
        ("employee_id", "employee_id"),
        ("asessment_year", "assesment_year"),
        ("remarks", "remarks"),
        ("dob", "dob"),
        ("age", "age"),
    ) + _ASSESSMENT_SCORE_MAP,
    schema=_schema(
        ("employee_id", S), ("assesment_year", SH), ("remarks", S), ("age", SH),
        *[(t, S) for _, t in _ASSESSMENT_SCORE_MAP],
    ),
)

ROADMAP = DatasetSpec(
    name="individual_career_roadmap",
    target="individual_career_roadmap",
    parents=("employees",),
    key=("employee_id", "year"),
    column_map=(("employee_id", "employee_id"), ("planned_position", "planned_position"), ("year", "year")),
    schema=_schema(("employee_id", S), ("planned_position", S), ("year", SH), ("created_at", TS)),
    defaults=(("created_at", NOW),),
)

# Foreign-key load order: the master first, then its dependents.
LOAD_ORDER: tuple[DatasetSpec, ...] = (EMPLOYEES, JOBS, EDUCATION, ASSESSMENTS, ROADMAP)
SPECS: dict[str, DatasetSpec] = {s.name: s for s in LOAD_ORDER}
MASTER = EMPLOYEES.name

ROADMAP_COLUMN_RE = re.compile(r"^road_map_(\d{4})$")
