from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dqlake import functions as f


@pytest.fixture
def value(rows):
    """Evaluate one expression over one text value."""
    def run(text, make):
        return rows("x string", (text,)).select(make("x").alias("y")).first().y
    return run


@pytest.mark.parametrize("text,key", [(" sub-001 ", "SUB-001"), ("", None), ("-", None), (" - ", None),
                                      (None, None), ("   ", None), ("a-b", "A-B")])
def test_normalize_key(value, text, key):
    assert value(text, f.normalize_key) == key
    assert value(text, f.is_missing) is (key is None)


def test_blank_to_null_keeps_case(value):
    assert value(" Ab ", f.blank_to_null) == "Ab"


@pytest.mark.parametrize("text,flag", [("Y", "YES"), ("yes", "YES"), ("1", "YES"), (" true", "YES"), ("n", "NO"),
                                       ("0", "NO"), ("False", "NO"), ("maybe", None), ("", None), (None, None)])
def test_map_flag(value, text, flag):
    assert value(text, f.map_flag) == flag


@pytest.mark.parametrize("text,want", [("04-SEP-2026", date(2026, 9, 4)), ("04-Sep-2026", date(2026, 9, 4)),
                                       ("2026-09-04", None), ("", None), ("31-FEB-2026", None)])
def test_parse_month_name(value, text, want):
    assert value(text, lambda c: f.parse_date(c, "dd-MMM-yyyy")) == want


@pytest.mark.parametrize("name,want", [("subjects_20260907.csv", date(2026, 9, 7)), ("subjects_2026.csv", None),
                                       ("old_subjects_20260907.csv", None), ("subjects_20261340.csv", None), (None, None)])
def test_delivery_date(value, name, want):
    assert value(name, lambda c: f.delivery_date(c, "subjects")) == want


def test_delivery_date_unanchored(value):
    assert value("x/subjects_20260907.csv", lambda c: f.delivery_date(c, "subjects", anchored=False)) == date(2026, 9, 7)


def test_typed_never_fails(rows):
    df = f.typed(rows("a string, b string, c string", ("12", "1e3", "2026-01-01"), ("x", "", "01/02/2026")),
                 {"a": "int", "b": "double", "c": "date"})
    assert [tuple(r) for r in df.collect()] == [(12, 1000.0, date(2026, 1, 1)), (None, None, None)]


def test_bands(rows):
    df = rows("n int", (64,), (65,), (None,), (80,))
    assert [r.b for r in df.select(f.band("n", [65]).alias("b")).collect()] == ["<65", ">=65", "UNKNOWN", ">=65"]
    assert [r.b for r in df.select(f.band("n", [65, 70]).alias("b")).collect()] == ["<65", "65-70", "UNKNOWN", ">=70"]


def test_units(value):
    assert value(" mg / dL ", f.normalize_unit) == "MG / DL"
    assert value(" mg / dL ", lambda c: f.normalize_unit(c, strip_ws=True)) == "MG/DL"


def test_elapsed_and_stamp(rows):
    df = rows("a date, b date", (date(2026, 1, 1), None), (date(2026, 1, 1), date(2026, 1, 11)), (None, None))
    as_of = F.lit(date(2026, 1, 31))
    got = f.stamp(df.select(f.elapsed_days("a", "b", as_of).alias("d")), "at", as_of).collect()
    assert [r.d for r in got] == [30, 10, None]
    assert got[0]["at"] == datetime(2026, 1, 31)


def test_range_judgement(rows):
    df = rows("v double, lo double, hi double, s string", (5.0, 1.0, 9.0, "Y"), (0.0, 1.0, 9.0, "Y"), (9.5, 1.0, 9.0, "N"),
              (1.0, 1.0, 9.0, "N"), (None, 1.0, 9.0, "N"), (5.0, None, 9.0, "Y"), (5.0, 1.0, 9.0, "?"))
    flag = f.range_flag("v", "lo", "hi")
    got = df.select(flag, f.range_direction("v", "lo", "hi"), f.flag_discrepancy(F.col("s"), flag)).collect()
    assert [tuple(r) for r in got] == [("N", "NORMAL", True), ("Y", "LOW", False), ("Y", "HIGH", True),
                                       ("N", "NORMAL", False), (None, None, None), (None, None, None), ("N", "NORMAL", None)]


def test_rate(rows):
    df = rows("a int, b int", (1, 4), (1, 0), (1, None), (None, 4))
    assert [r[0] for r in df.select(f.rate("a", "b")).collect()] == [0.25, None, None, None]
