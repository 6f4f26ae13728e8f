"""Scalar functions on literal rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollbook.functions import columns as c


def values(spark, inputs, make):
    """The function applied to each input, through real rows."""
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, x string")
    return [row.y for row in frame.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_three_rules_for_a_code(spark):
    texts = ["62020 - IT 2", "None Supplied", "", None, "62020", "A-1-2", " 01110 - Growing"]
    assert values(spark, texts, c.first_digits) == ["62020", None, None, None, "62020", "1", "01110"]
    assert values(spark, texts, c.only_digits) == ["620202", "", "", None, "62020", "12", "01110"]
    assert values(spark, texts, c.before_dash) == [
        "62020", "None Supplied", "", None, "62020", "A", "01110",
    ]


def address(spark, line1, line2, town, county, **options):
    frame = spark.createDataFrame(
        [(line1, line2, town, county)], "a string, b string, c string, d string"
    )
    return frame.select(
        c.find_postcode(*[F.col(x) for x in "abcd"], **options).alias("y")
    ).first().y


def test_postcode_search(spark):
    assert address(spark, "1 HIGH ST", "UNIT 4 B2 3AA", "TOWN", "KENT") == "B2 3AA"
    assert address(spark, "1 HIGH ST", "se1 9gf", "TOWN", "KENT") == "se1 9gf"
    assert address(spark, "1 HIGH ST", "se1 9gf", "TOWN", "KENT", ignore_case=False) is None
    assert address(spark, "1 HIGH ST", "SW1A 1AA", "TOWN", "KENT") is None
    assert address(
        spark, "1 HIGH ST", "SW1A 1AA", "TOWN", "KENT", pattern="[A-Z]{1,2}[0-9][0-9A-Z]? +[0-9]+[A-Z]+"
    ) == "SW1A 1AA"
    assert address(spark, "1 HIGH ST", "B2 3AA", "TOWN", None) is None
    assert address(spark, "1 HIGH ST", "B2 3AA", "TOWN", None, skip_nulls=True) == "B2 3AA"


def test_postcode_may_span_address_parts(spark):
    assert address(spark, "PLOT B2", "3AA ROAD", "TOWN", "KENT") == "B2 3AA"


def test_normal_postcode(spark):
    assert values(spark, ["SE1 9GF", " a 1 ", "", None], c.normal_postcode) == ["se19gf", "a1", "", None]


def test_content_key(spark):
    frame = spark.createDataFrame(
        [("a", "b", dt.date(2001, 7, 1)), ("a", None, dt.date(2001, 7, 1))], "a string, b string, d date"
    )
    rows = frame.select(
        c.content_key(F.col("a"), F.col("b")).alias("ab"),
        c.content_key(F.col("a"), F.col("d")).alias("ad"),
        F.md5(F.lit("ab")).alias("md5_ab"),
        F.md5(F.lit("a2001-07-01")).alias("md5_ad"),
    ).collect()
    assert rows[0].ab == rows[0].md5_ab
    assert rows[0].ad == rows[0].md5_ad
    assert rows[1].ab is None


def test_register_date(spark):
    texts = ["31/12/1999", "1/2/2003", "31/02/2020", "", None, "2003-02-01", "junk"]
    assert values(spark, texts, c.register_date) == [
        dt.date(1999, 12, 31), dt.date(2003, 2, 1), None, None, None, None, None,
    ]


def test_previous_month_turns_the_year(spark):
    days = ["2001-01-31", "2001-03-31", "2000-03-01"]
    assert values(spark, days, lambda x: c.previous_month(x.cast("date"))) == [
        dt.date(2000, 12, 1), dt.date(2001, 2, 1), dt.date(2000, 2, 1),
    ]


@pytest.mark.parametrize(
    "months, expected",
    [(0, dt.date(2001, 12, 1)), (1, dt.date(2002, 1, 1)), (-12, dt.date(2000, 12, 1))],
)
def test_first_of_month(months, expected):
    assert c.first_of_month(dt.date(2001, 12, 15), months) == expected


def test_in_month_and_on_day(spark):
    days = ["2001-06-30", "2001-07-01", "2001-07-31", "2001-08-01", "2002-07-10", None]
    inside = values(spark, days, lambda x: c.in_month(x.cast("date"), dt.date(2001, 7, 15)))
    assert inside == [False, True, True, False, False, None]
    moments = ["2001-07-15 00:00:00", "2001-07-15 23:59:59", "2001-07-16 00:00:00"]
    today = values(spark, moments, lambda x: c.on_day(x.cast("timestamp"), dt.date(2001, 7, 15)))
    assert today == [True, True, False]


def test_percent_of_nothing(spark):
    frame = spark.createDataFrame([(1, 0), (1, 3), (-1, 4)], "a bigint, b bigint")
    rows = frame.select(c.percent(F.col("a"), F.col("b")).alias("p")).collect()
    assert [row.p for row in rows] == [None, pytest.approx(100 / 3), -25.0]


def test_file_names(spark):
    paths = ["in/part_17.csv", "part_17.csv", "a/b/Register-2024-01-01.zip", "a/", None]
    assert values(spark, paths, c.file_name) == [
        "part_17.csv", None, "Register-2024-01-01.zip", None, None,
    ]
    assert values(spark, paths, c.fragment_number) == [17, 17, None, None, None]
    assert values(spark, paths, c.release_date) == [None, None, dt.date(2024, 1, 1), None, None]
