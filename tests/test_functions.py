"""Column expressions against their Python definitions."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from rosterline.functions.text import clean_cell, normalize_gender, strip_ws, token_count
from rosterline.operators.headers import normal_form, sheet_columns
from rosterline.specs import STRIP_CHARS

WS = st.sampled_from(list(STRIP_CHARS))
TEXT = st.text(alphabet=st.one_of(WS, st.sampled_from(list("abc XYZ-é"))), max_size=12)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=20))
def test_strip_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(strip_ws("v")).collect()]
    assert got == [v.strip() for v in values]


def test_clean_cell_tokens(spark):
    vals = [" nan ", "NaN", "", "  ", None, " x ", "NAN", "nan nan"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(clean_cell("v")).collect()]
    assert got == [None, None, None, None, None, "x", "NAN", "nan nan"]


def test_gender_map(spark):
    vals = ["LAKI-LAKI", "perempuan", " L ", "P", "m", "F", "WANITA", "", None, "Female", "female"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(normalize_gender("v")).collect()]
    assert got == ["Male", "Female", "Male", "Female", "Male", "Female", "Male", "Male", "Male", "Male", "Male"]


def test_token_count(spark):
    vals = ["Guntur Test", "Joko", "  a  b   c ", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    assert [r[0] for r in df.select(token_count("v")).collect()] == [2, 1, 3, 0, 0]


def test_normal_form():
    assert normal_form("TANGGAL LAHIR\n(DD/MM/YY)") == "tanggal lahir"
    assert normal_form("AREA OF DEVELOPMENT (GAP)") == "area of development"
    assert normal_form("  NIK/NIP ") == "nik/nip"


def test_parse_date(spark):
    from pyspark.sql import functions as F

    from rosterline.functions.dates import parse_date, year_start

    vals = ["1995-05-17", "17/05/1995", "17/05/85", "1995-05-17 00:00:00", "n/a", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [str(r[0]) if r[0] else None for r in df.select(parse_date("v", latest=F.current_date())).collect()]
    assert got == ["1995-05-17", "1995-05-17", "1985-05-17", "1995-05-17", None, None]
    got = [str(r[0]) if r[0] else None for r in df.select(parse_date("v")).collect()]
    assert got[2] == "2085-05-17"  # start and end dates may lie in the future
    ys = [r[0] for r in spark.createDataFrame([("FY 2021",), ("x",), (None,)], "v string").select(year_start("v")).collect()]
    assert ys == ["2021-01-01", None, None]


def test_wanted_header_only_and_any_roadmap_year():
    sheet = sheet_columns(["NIK (KTP)", "NIK/NIP", "road_map_2033", "x"], (("nik", "NIK/NIP"), ("nama", "NAMA")))
    assert sheet.found == {"nik": "NIK/NIP", "road_map_2033": "road_map_2033"}
    assert sheet.missing == ("nama",) and sheet.unknown == ("NIK (KTP)", "x")
    assert sheet_columns(["nik"], (("nik", "NIK/NIP"),), conformed=True).found == {"nik": "nik"}
