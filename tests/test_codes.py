"""Code counts and reports on small tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollbook.operators import codes

AS_OF = dt.date(2001, 7, 15)


def day(month, number=1, year=2001):
    return dt.date(year, month, number)


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=str)


@pytest.fixture
def register(spark):
    return spark.createDataFrame(
        [
            ("1", "Active", "62020 - IT 2", "None Supplied", None, None),
            ("2", "Active - Proposal to Strike Off", "62020 - IT 2", "62020 - IT 2", "01110 - Farm", None),
            ("3", "Liquidation", "62020 - IT 2", None, None, None),
            ("4", "active", "62020 - IT 2", None, None, None),
            ("5", None, "62020 - IT 2", None, None, None),
        ],
        "company_number string, company_status string, sic_text_1 string, sic_text_2 string, "
        "sic_text_3 string, sic_text_4 string",
    )


def test_counts_of_active_companies(register):
    counted = [tuple(row) for row in codes.active_code_counts(register).collect()]
    assert counted == [("620202", 3), ("", 1), ("01110", 1)]


def test_monthly_counts(register):
    monthly = codes.monthly_code_counts(register, F.lit(day(7)), F.substring("sic_code", 1, 2))
    assert rows(monthly) == [("", "", 1, day(7)), ("01110", "01", 1, day(7)), ("620202", "62", 3, day(7))]
    assert monthly.columns == ["sic_code", "sic_code_category", "counts", "file_date"]
    assert {row.sic_code_category for row in codes.monthly_code_counts(register, F.lit(day(7))).collect()} == {None}


def test_candidates_and_rejects(spark, register):
    empty = spark.createDataFrame(
        [], "code string, organisation_id string, company_number string, md5 string, date_last_modified date"
    )
    candidates = codes.code_candidates(register, AS_OF)
    assert candidates.count() == 7
    merged = codes.upsert_codes(empty, candidates, AS_OF)
    found = {(row.company_number, row.code) for row in merged.next.collect()}
    assert found == {("1", "62020"), ("2", "62020"), ("2", "01110"), ("3", "62020"), ("4", "62020"), ("5", "62020")}
    assert [row.company_number for row in merged.rejects.collect()] == ["1"]


def test_potential_entries_count_null_once_per_company(register):
    assert codes.potential_code_entries(register).first()[0] == 12
    assert codes.potential_code_entries(register, unique=True).first()[0] == 12
    assert codes.potential_code_entries(register.union(register)).first()[0] == 12
    assert codes.potential_code_entries(register.limit(0), unique=True).first()[0] == 0


def test_counting_a_unique_register_shuffles_one_row_per_task(register):
    plan = codes.potential_code_entries(register, unique=True)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def counts(spark, *records):
    return spark.createDataFrame(
        [(code, code[:2], number, when) for code, number, when in records],
        "sic_code string, sic_code_category string, counts bigint, file_date date",
    )


def test_code_report(spark):
    facts = counts(
        spark, ("10", 8, day(6)), ("10", 10, day(7)), ("20", 5, day(6)), ("30", 5, day(7)),
        ("40", 4, day(6)), ("40", 0, day(7)), ("10", 99, day(7, year=2000)),
    )
    report = {row.sic_code: row for row in codes.code_month_over_month(facts, AS_OF).collect()}
    assert set(report) == {"10", "40"}
    assert (report["10"].diff, report["10"].pct_change) == (2, 20.0)
    assert (report["40"].diff, report["40"].pct_change) == (-4, None)


def test_category_report_divides_by_the_earlier_count(spark):
    totals = codes.category_totals(
        counts(spark, ("101", 5, day(6)), ("102", 3, day(6)), ("101", 10, day(7)), ("-", 1, day(6)), ("-", 2, day(7)))
    )
    report = codes.category_month_over_month(totals, AS_OF).collect()
    assert [(row.sic_code_category, row.first_month_count, row.diff, row.pct_change) for row in report] == [
        ("10", 8, 2, 25.0)
    ]


def test_two_files_in_a_month_pair_with_each_other(spark):
    facts = counts(spark, ("10", 1, day(6, 1)), ("10", 2, day(6, 20)), ("10", 3, day(7, 1)), ("10", 4, day(7, 20)))
    report = codes.code_month_over_month(facts, AS_OF)
    pairs = {(row.first_month.day, row.second_month.day) for row in report.collect()}
    assert pairs == {(1, 1), (1, 20), (20, 1), (20, 20)}
    assert report.select("md5_str").distinct().count() == 4


def test_backfill_is_the_report_of_every_month(spark):
    facts = counts(
        spark,
        *[("10", 10 * y + m, day(m, 1 + m, 2000 + y)) for y in (0, 1) for m in range(1, 13)],
        ("20", 5, day(3)), ("20", 6, day(5)),
    )
    single = None
    for y in (2000, 2001):
        for m in range(1, 12):
            report = codes.code_month_over_month(facts, dt.date(y, m, 28))
            single = report if single is None else single.union(report)
    assert rows(codes.backfill_codes(facts)) == rows(single)
    everything = codes.backfill_codes(facts, codes.ALL_MONTHS)
    assert {row.second_month.month for row in everything.collect()} == set(range(1, 13))


def test_reports_are_upserted_and_described(spark):
    totals = codes.category_totals(counts(spark, ("10", 8, day(6)), ("10", 10, day(7))))
    report = codes.category_month_over_month(totals, AS_OF)
    audit = {
        "last_modified_by": F.lit(None).cast("string"),
        "last_modified_date": F.lit(None).cast("date"),
        "category_description": F.lit(None).cast("string"),
    }
    empty = report.limit(0).withColumns(audit)
    first = codes.upsert_category_analytics(empty, report, day(7, 15)).next
    second = codes.upsert_category_analytics(first, report, day(7, 16)).next
    assert first.first().last_modified_by == "category report insert"
    assert second.first().last_modified_by == "category report update"
    assert second.first().last_modified_date == day(7, 16)
    names = spark.createDataFrame(
        [("10", "Food"), ("10", "Drinks"), ("11", "Else")], "sic_code_category string, Category_Description string"
    )
    named = codes.fill_descriptions(second, names)
    assert named.first().category_description == "Drinks"
    kept = codes.fill_descriptions(second.withColumn("category_description", F.lit("Own")), names)
    assert kept.first().category_description == "Own"
    assert named.columns == second.columns


def test_new_totals_leave_old_ones_alone(spark):
    totals = codes.category_totals(counts(spark, ("10", 8, day(6)), ("10", 10, day(7))))
    target = totals.filter(F.col("file_date") == F.lit(day(6))).withColumn("count", F.col("count") + 90)
    assert rows(codes.insert_new_totals(target, totals).next.select("Category", "count")) == [("10", 10), ("10", 98)]
