"""What the plans must and must not contain."""

from __future__ import annotations

import datetime as dt

import pytest

from rollbook.bindings.checks import AS_OF, CHECKS
from rollbook.functions import columns as c
from rollbook.operators import codes, locations
from rollbook.sources.snapshots import Parts, Snapshots

SF_DIR = "/root/testdata/sf0.001"
# These run jobs of their own and return a scan of the outcome.
EAGER = {
    "ingest_fragments", "refresh_all", "scan_register", "scan_sic_columns", "export_fragments",
    "file_row_counts", "landing_overwrite",
}
LAZY = [name for name in CHECKS if name not in EAGER]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(CHECKS[name](spark, SF_DIR))
    for node in ["Python", "CartesianProduct", "BroadcastNestedLoopJoin"]:
        assert node not in plan


def test_month_filter_reaches_the_reader(spark, tmp_path):
    facts = spark.sql("select '10' sic_code, 1L counts, date '2001-07-01' file_date")
    facts.write.parquet(str(tmp_path / "facts"))
    stored = spark.read.parquet(str(tmp_path / "facts"))
    plan = plan_of(codes.code_month_over_month(stored, AS_OF))
    assert "GreaterThanOrEqual(file_date,2001-06-01)" in plan
    assert "LessThan(file_date,2001-08-01)" in plan


def test_code_counts_read_five_columns_in_one_scan(spark, tmp_path):
    register = spark.createDataFrame(
        [("1", "Active", "a", "b", "c", "d", "wide")],
        "company_number string, company_status string, sic_text_1 string, sic_text_2 string, "
        "sic_text_3 string, sic_text_4 string, URI string",
    )
    register.write.parquet(str(tmp_path / "register"))
    plan = plan_of(codes.active_code_counts(spark.read.parquet(str(tmp_path / "register"))))
    assert plan.count("FileScan") == 1
    assert "URI" not in plan
    assert "In(company_status" in plan


def test_head_offices_are_cut_before_the_shuffle(spark):
    geo = spark.createDataFrame(
        [(1, "o", "HEAD_OFFICE", "UK")], "id bigint, organisation_id string, address_type string, country string"
    )
    plan = plan_of(locations.keep_latest_head_office(geo))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_in_month_is_a_range(spark):
    text = str(c.in_month(spark.range(1).selectExpr("current_date() d").d, AS_OF))
    assert "month(" not in text.lower()


@pytest.fixture
def broken_but(spark, tmp_path):
    """A fact in monthly parts over two years, of which only the files of the given months can be read."""

    def make(name, count, months):
        store = Snapshots(spark, str(tmp_path / "store"), parts={name: Parts("file_date")})
        days = spark.range(24).selectExpr("add_months(date '2000-01-01', cast(id as int)) file_date", "id + 1 n")
        facts = days.selectExpr("'10' sic_code", "'10' Category", f"n {count}", "file_date")
        stored = store.write(name, facts, "first")
        broken = 0
        for file in (tmp_path / "store" / name).rglob("*.parquet"):
            if file.parent.name.removeprefix("file_date=") not in {str(month) for month in months}:
                file.write_bytes(b"broken")
                (file.parent / f".{file.name}.crc").unlink()
                broken += 1
        assert broken == 24 - len(months)
        return stored

    return make


REPORTS = [
    ("sic_counts", "counts", codes.code_month_over_month, codes.backfill_codes),
    ("category_totals", "count", codes.category_month_over_month, codes.backfill_categories),
]


@pytest.mark.parametrize("name, count, of_month, _", REPORTS)
def test_month_pair_reads_two_parts(broken_but, name, count, of_month, _):
    stored = broken_but(name, count, [dt.date(2001, 6, 1), dt.date(2001, 7, 1)])
    found = [(row.first_month_count, row.second_month_count) for row in of_month(stored, AS_OF).collect()]
    assert found == [(18, 19)]


@pytest.mark.parametrize("name, count, _, backfill", REPORTS)
def test_backfill_reads_the_wanted_months_and_those_before(broken_but, name, count, _, backfill):
    # January's month before is in the year before; the first January has none.
    readable = [dt.date(year, month, 1) for year in (2000, 2001) for month in (1, 5, 6, 12)]
    stored = broken_but(name, count, readable)
    found = sorted((str(row.second_month), row.first_month_count, row.second_month_count) for row in backfill(stored, [1, 6]).collect())
    assert found == [("2000-06-01", 5, 6), ("2001-01-01", 12, 13), ("2001-06-01", 17, 18)]
