from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cargoloom.functions import (
    address_city,
    address_district,
    calendar_days,
    clip,
    contact_handle,
    date_key,
    fold_accents,
    full_address,
    minutes_between,
    trim_padding,
)
from cargoloom.functions.text import ACCENTED, FOLDED
from cargoloom.plans.dimensions import dim_date, dim_date_covering


def values(spark, inputs, column, schema="a string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_minutes_round_half_away_from_zero_and_pass_nulls(spark):
    at = datetime(2024, 5, 1, 12, 0, 0)
    pairs = [
        (at, None),
        (None, at),
        (at, at.replace(second=30)),
        (at.replace(second=30), at),
        (at, at.replace(second=29, microsecond=999_999)),
        (at.replace(microsecond=900_000), at.replace(minute=2)),
        (at, datetime(2024, 5, 1, 11, 0)),
    ]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, s timestamp_ntz, e timestamp_ntz")
    got = [r[0] for r in df.orderBy("i").select(minutes_between("s", "e")).collect()]
    assert got == [None, None, 1, -1, 0, 2, -60]


def test_default_address_parts(spark):
    addresses = ["A", "A, B", "A, B, C", "A, B, C, D", "A, B, C, D, E", "A, , C", "A,,C,D", "A, B , C", None]
    assert values(spark, addresses, address_city("a")) == [None, None, "B", "C", "D", " ", "C", "B ", None]
    assert values(spark, addresses, address_district("a")) == [None, None, None, "B", "B", None, None, None, None]


def test_street_district_city_layout(spark):
    addresses = ["Số 5 Láng Hạ, Đống Đa, Hà Nội", "Đống Đa, Hà Nội", None]
    layout = "street_district_city"
    assert values(spark, addresses, address_city("a", layout)) == ["Hà Nội", None, None]
    assert values(spark, addresses, address_district("a", layout)) == ["Đống Đa", None, None]
    with pytest.raises(ValueError):
        address_city("a", "other")


def test_full_address(spark):
    df = spark.createDataFrame([(12, "Kim Mã", "Ba Đình", "Hà Nội"), (None, "x", "y", "z")], "n int, s string, d string, c string")
    got = [r[0] for r in df.select(full_address(F.col("n"), F.col("s"), F.col("d"), F.col("c"))).collect()]
    assert got == ["Số 12 Kim Mã, Ba Đình, Hà Nội", None]


def test_accents(spark):
    assert len(ACCENTED) == len(FOLDED) == 134
    assert FOLDED.isascii()
    words = ["Đường Nguyễn Huệ", "ỳỵỷỹ ỲỴỶỸ", "äöü ñ ç plain", None]
    assert values(spark, words, fold_accents("a")) == ["Duong Nguyen Hue", "yyyy YYYY", "äöü ñ ç plain", None]
    assert values(spark, words, contact_handle("a")) == ["duongnguyenhue", "yyyyyyyy", "plain", None]


def test_clip_and_padding(spark):
    assert values(spark, ["x" * 300, "đ" * 256, "short", None], clip("a")) == ["x" * 255, "đ" * 255, "short", None]
    df = spark.createDataFrame([("e_wallet     ", 1)], "m string, n int")
    assert trim_padding(df, [df.columns[0]]).first() == ("e_wallet", 1)


def test_date_key(spark):
    days = [date(2024, 2, 29), date(999, 1, 1), None]
    assert values(spark, days, date_key("a"), "a date") == [20240229, 9990101, None]


def test_calendar(spark):
    assert calendar_days(spark, date(2024, 3, 1), date(2024, 2, 1)).count() == 0
    assert [r[0] for r in calendar_days(spark, date(2024, 2, 29), date(2024, 2, 29)).collect()] == [date(2024, 2, 29)]
    year = {r.full_date: r for r in dim_date(spark, date(2024, 1, 1), date(2024, 12, 31)).collect()}
    assert len(year) == 366
    assert year[date(2024, 1, 1)] == (20240101, date(2024, 1, 1), "Monday", 1, 1, 1, 2024, False, True)
    assert year[date(2024, 12, 25)].is_holiday and not year[date(2024, 12, 24)].is_holiday
    assert [year[date(2024, 6, d)].is_weekend for d in (1, 2, 3)] == [True, True, False]
    empty = spark.createDataFrame([], "d timestamp_ntz")
    assert dim_date_covering(empty, "d").count() == 0
