"""Figures that were counted beforehand on the middle scale."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollbook.bindings.checks import AS_OF, CHECKS
from rollbook.bindings.views import view
from rollbook.operators import codes, locations

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize(
    "name, rows",
    [
        ("active_code_counts", 361),
        ("changed_in_month", 2500),
        ("code_month_over_month", 57),
        ("backfill_codes", 3965),
        ("orphan_locations", 5000),
        ("section_gate", 70),
    ],
)
def test_row_counts(spark, name, rows):
    assert CHECKS[name](spark, SF_DIR).count() == rows


def test_blank_code(spark):
    blank = CHECKS["active_code_counts"](spark, SF_DIR).filter("sic_code = ''").first()
    assert blank.sic_code_count == 614


def test_potential_codes(spark):
    assert CHECKS["potential_code_entries"](spark, SF_DIR).first()[0] == 39828


def test_year_turn(spark):
    report = codes.code_month_over_month(view(spark, SF_DIR, "sic_counts"), dt.date(2001, 1, 31))
    assert report.count() == 56


def test_repaired_postcodes(spark):
    register = view(spark, SF_DIR, "company_file").filter("reg_address_postcode is null")
    found = F.col("reg_address_postcode").isNotNull()
    assert locations.repair_postcodes(register).filter(found).count() == 2474
    assert locations.repair_postcodes(register, ignore_case=False).filter(found).count() == 1484


def test_filled_counties(spark):
    register = view(spark, SF_DIR, "company_file")
    mapping = view(spark, SF_DIR, "post_code_mappings")
    missing = F.col("reg_address_county").isNull()
    before = register.filter(missing).count()
    after = locations.fill_counties(register, mapping).filter(missing).count()
    assert before - after == 3214


def test_matching_locations(spark):
    rows = locations.geo_rows(locations.add_geo_keys(view(spark, SF_DIR, "company_file")), AS_OF)
    geo = view(spark, SF_DIR, "geo_prev")
    matched = geo.join(rows.select("md5_key"), "md5_key", "left_semi")
    assert matched.count() == 3750
    assert matched.filter("address_type = 'BRANCH'").count() == 1250
