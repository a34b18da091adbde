"""Column helpers (F1-F24), including the traps of SURVEY §7.4."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cadence.functions import columns as fn
from cadence.functions.calendar import calendar_columns


def test_status_label_covers_unknown_and_null(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (5,), (None,)], "s bigint")
    got = [r[0] for r in df.select(fn.status_label("s")).collect()]
    assert got == ["Pending", "Processing", "Rejected", "Completed", "Unknown", "Unknown"]


def test_safe_casts_turn_bad_text_into_null(spark):
    df = spark.createDataFrame([("NULL",), ("2016-13-45",), ("2016-02-29",)], "d string")
    got = [r[0] for r in df.select(fn.safe_date("d")).collect()]
    assert got == [None, None, dt.date(2016, 2, 29)]
    m = spark.createDataFrame([("NULL",), ("7",)], "m string")
    assert [r[0] for r in m.select(fn.safe_long(fn.null_text("m"))).collect()] == [None, 7]


def test_hard_cast_fails_loudly(spark):
    df = spark.createDataFrame([("abc",)], "order_id string")
    with pytest.raises(Exception):
        df.select(fn.to_long("order_id")).collect()


def test_null_text_and_flag(spark):
    df = spark.createDataFrame([("NULL", 1), ("a@b", 0)], "e string, a bigint")
    rows = df.select(fn.null_text("e"), fn.flag_is_one("a")).collect()
    assert [tuple(r) for r in rows] == [(None, True), ("a@b", False)]


def test_full_name_is_null_when_a_part_is_null(spark):
    df = spark.createDataFrame([("Ann", "Lee"), ("Bob", None)], "f string, l string")
    assert [r[0] for r in df.select(fn.full_name("f", "l")).collect()] == ["Ann Lee", None]


def test_line_revenue_rounds_half_up_in_decimals(spark):
    df = spark.createDataFrame(
        [(1, Decimal("2.675"), Decimal("0")), (3, Decimal("19.99"), Decimal("0.07"))],
        "q bigint, p decimal(18,3), d decimal(9,4)",
    )
    got = [r[0] for r in df.select(fn.line_revenue("q", "p", "d")).collect()]
    assert got == [Decimal("2.68"), Decimal("55.77")]


def test_surrogate_key_matches_md5_of_joined_parts(spark):
    import hashlib

    df = spark.createDataFrame([(1, 2), (1, None)], "a bigint, b bigint")
    got = [r[0] for r in df.select(fn.surrogate_key(["a", "b"])).collect()]
    assert got[0] == hashlib.md5(b"1-2").hexdigest()
    assert got[1] == hashlib.md5(f"1-{fn.SURROGATE_NULL}".encode()).hexdigest()


def test_sunday_week_number_matches_percent_u_on_every_day(spark):
    start, end = dt.date(1995, 1, 1), dt.date(2021, 1, 1)
    days = spark.range((end - start).days).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("d")
    )
    rows = days.select("d", fn.week_of_year_sunday("d")).collect()
    bad = [(r[0], r[1]) for r in rows if int(r[0].strftime("%U")) != r[1]]
    assert not bad


def test_calendar_columns(spark):
    df = spark.createDataFrame([(dt.date(2016, 1, 3),)], "date_day date")
    r = df.select(*calendar_columns("date_day")).first().asDict()
    assert r == {
        "year": 2016, "quarter": 1, "month": 1, "month_name": "January", "day_of_month": 3,
        "day_of_week": 1, "day_name": "Sunday", "week_of_year": 1, "year_month": "2016-01",
        "is_weekend": True,
    }


def test_day_diff_and_ratio(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 5), dt.date(2020, 1, 1), 3, 0)],
                               "a date, b date, n bigint, z bigint")
    r = df.select(fn.day_diff("a", "b"), fn.ratio(F.col("n"), F.col("z"))).first()
    assert r[0] == 4 and r[1] is None


def test_hex_keys_come_back_from_packing_as_they_were(spark):
    from cadence.functions.columns import hex_packed, hex_unpacked

    texts = ["00ff", "d41d8cd98f00b204e9800998ecf8427e", "D41D", "abc", "", "no hex", "é", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, k string")
    packed = df.select("i", *hex_packed("k"))
    got = {r["i"]: r["k"] for r in packed.select("i", hex_unpacked("k")).collect()}
    assert [got[i] for i in range(len(texts))] == texts
    assert packed.where("_k_bytes is not null and _k_text is not null").count() == 0
    assert packed.where("i = 1").first()["_k_bytes"] == bytes.fromhex(texts[1])


def test_known_columns_come_back_from_packing_as_they_were(spark):
    from cadence.functions.columns import known_packed, known_unpacked

    rows = [(1, "1"), (2, "two"), (3, None), (None, "x"), (None, None)]
    df = spark.createDataFrame(rows, "a int, k string")
    expected = F.col("a").cast("string")
    packed = df.select("a", known_packed("k", expected))
    got = sorted(packed.select("a", known_unpacked("k", expected)).collect(), key=str)
    assert [tuple(r) for r in got] == sorted(rows, key=lambda r: f"Row(a={r[0]}, k={r[1]!r})")
    assert packed.where("_k_other is not null").count() == 3
