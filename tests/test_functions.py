from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from boardroll import functions as fn


def one(df, column):
    return df.select(column.alias("x")).collect()[0][0]


@pytest.fixture
def day(frame):
    return lambda text: frame("d date", (text,))


@pytest.mark.parametrize(
    ("text", "pivot", "expected"),
    [("2020-06-30", 7, 2019), ("2020-07-01", 7, 2020), ("2020-08-31", 9, 2019), ("2020-01-01", 1, 2020), (None, 7, None)],
)
def test_school_year(day, text, pivot, expected):
    assert one(day(text), fn.school_year("d", pivot)) == expected


def test_weekdays_between_matches_counting(frame):
    start = date(2021, 2, 25)
    pairs = [(start + timedelta(i), start + timedelta(i + j)) for i in range(8) for j in range(20)]
    df = frame("a date, b date", *[(a.isoformat(), b.isoformat()) for a, b in pairs])
    got = df.select("a", "b", fn.weekdays_between("a", "b").alias("n")).collect()
    for row in got:
        days = (row.a + timedelta(k) for k in range(1, (row.b - row.a).days + 1))
        assert row.n == sum(d.weekday() < 5 for d in days)


def test_weekdays_over_a_weekend_and_null(frame):
    df = frame("a date, b date", ("2021-03-05", "2021-03-08"), (None, "2021-03-08"))
    assert rows(df.select(fn.weekdays_between("a", "b"))) == [(1,), (None,)]


def test_year_boundaries_is_not_full_years(frame):
    df = frame("a date, b date", ("1999-12-31", "2000-01-01"))
    assert one(df, fn.year_boundaries("a", "b")) == 1


def test_age_weekday_and_text_dates(frame):
    df = frame("t string, d date", ("20000229", "2018-02-28"), ("nope", "2024-01-01"))
    got = df.select(fn.age_on(fn.yyyymmdd("t"), "d"), fn.french_weekday("d")).collect()
    assert [tuple(r) for r in got] == [(17, "mercredi"), (None, "lundi")]


def test_text_helpers(frame):
    df = frame("a string, b string", ("x", None), ("  ", "y"), (None, None))
    got = df.select(fn.concat_blank("a", F.lit("-"), "b"), fn.dash_if_blank("a")).collect()
    assert [tuple(r) for r in got] == [("x-", "x"), ("  -y", "-"), ("-", "-")]


def test_insert_at_and_short_text(frame):
    df = frame("a string", ("0011234567890",), ("001",))
    got = [r[0] for r in df.select(fn.insert_at("a", "-", 4, 6, 12)).collect()]
    assert got == ["001-1-23456-7890", None]


def test_surrogate_key_marks_nulls(frame):
    import hashlib

    df = frame("a int, b string", (1, None))
    expected = hashlib.md5(f"1-{fn.NULL_MARKER}".encode()).hexdigest()
    assert one(df, fn.surrogate_key("a", "b")) == expected


def test_cap_clamp_ratio_keep_nulls(frame):
    df = frame("v double", (5.0,), (None,), (0.5,))
    got = df.select(fn.cap("v", 1.0), fn.clamp("v", 1, 4), fn.ratio(F.lit(1), F.col("v") - 5)).collect()
    assert got[0][:] == (1.0, 4.0, None)
    assert got[1][:] == (None, None, None)
    assert got[2][:2] == (0.5, 1.0)


def test_band_edges(frame):
    df = frame("v int", (9,), (10,), (30,), (None,))
    got = [r[0] for r in df.select(fn.band("v", (10, 20, 30), ("a", "b", "c", "d"))).collect()]
    assert got == ["a", "b", "d", None]


def test_product_handles_zero_and_null(frame):
    df = frame("k int, f double", (1, 0.5), (2, None), (3, 0.5), (4, 0.0), (5, 0.9))
    w = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    got = [r[0] for r in df.select("k", fn.product_over("f", w).alias("p")).orderBy("k").select("p").collect()]
    assert got == pytest.approx([0.5, 0.5, 0.25, 0.0, 0.0])


@pytest.mark.parametrize(
    ("mode", "expected"),
    [("1", 60.0), ("5", 60.0), ("J", 60.0), ("H", 10.0), ("L", 10.0), ("2", 10.0), ("M", 1 / 6), ("G", 1 / 6), ("E", 1 / 6),
     ("6", 1 / 6), ("P", 10.8), ("F", 15.0), ("D", 13.5), ("3", 30.0), ("4", 45.0), ("Z", None)],
)
def test_paid_hours(frame, mode, expected):
    df = frame("mode string, units double", (mode, 10.0))
    got = one(df, fn.paid_hours("mode", "units", F.lit(6.0), F.lit(1080.0)))
    assert got == (None if expected is None else pytest.approx(expected))
