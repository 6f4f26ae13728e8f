"""Row counts per month: what the file holds against what changed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions import columns as c
from rollbook.operators.codes import potential_code_entries
from rollbook.operators.locations import is_home_head_office

# Result column and the counted one it is set against.
DIFFS = {
    "geolocation_diff": "rows_changed_in_geolocation",
    "organisation_diff": "rows_changed_in_org",
    "sic_code_diff": "rows_changed_in_siccode",
}


def _set_count(
    rowcounts: DataFrame, name: str, count: DataFrame, as_of: dt.date, all_rows: bool = False
) -> DataFrame:
    """Write a one-row count into the month's row; the other rows keep theirs."""
    old = F.col(name) if name in rowcounts.columns else F.lit(None).cast("bigint")
    new = count.scalar()
    here = c.in_month(F.col("file_month"), as_of)
    return rowcounts.withColumn(name, new if all_rows else F.when(here, new).otherwise(old))


def changed_rows(table: DataFrame, column: str, as_of: dt.date) -> DataFrame:
    return table.filter(c.in_month(F.col(column), as_of)).agg(F.count("*").alias("changed"))


def count_potential_codes(
    rowcounts: DataFrame,
    register: DataFrame,
    as_of: dt.date,
    all_rows: bool = False,
    unique: bool = False,
) -> DataFrame:
    entries = potential_code_entries(register, unique)
    return _set_count(rowcounts, "potential_sic_code_entries", entries, as_of, all_rows)


def count_changed_codes(rowcounts: DataFrame, codes: DataFrame, as_of: dt.date) -> DataFrame:
    changed = changed_rows(codes, "date_last_modified", as_of)
    return _set_count(rowcounts, "rows_changed_in_siccode", changed, as_of)


def count_changed_locations(
    rowcounts: DataFrame, locations: DataFrame, as_of: dt.date
) -> DataFrame:
    changed = changed_rows(locations.filter(is_home_head_office()), "date_last_modified", as_of)
    return _set_count(rowcounts, "rows_changed_in_geolocation", changed, as_of)


def count_changed_organisations(
    rowcounts: DataFrame, organisations: DataFrame, as_of: dt.date, all_rows: bool = False
) -> DataFrame:
    home = organisations.filter(F.col("country") == "UK")
    changed = changed_rows(home, "last_modified_date", as_of)
    return _set_count(rowcounts, "rows_changed_in_org", changed, as_of, all_rows)


def add_differences(rowcounts: DataFrame, as_of: dt.date) -> DataFrame:
    """File rows minus changed rows, in the month's row."""
    here = c.in_month(F.col("file_month"), as_of)
    for name, changed in DIFFS.items():
        old = F.col(name) if name in rowcounts.columns else F.lit(None).cast("bigint")
        diff = F.col("file_rowcount") - F.col(changed)
        rowcounts = rowcounts.withColumn(name, F.when(here, diff).otherwise(old))
    return rowcounts


# --- counted while the tables are written ---


def changed_count(column: str, as_of: dt.date, where: Column | None = None) -> Column:
    """How many rows changed in the month, as an aggregate to take along with a write."""
    here = c.in_month(F.col(column), as_of)
    return F.count_if(here if where is None else here & where)


def set_counts(rowcounts: DataFrame, counts: Mapping[str, int], as_of: dt.date) -> DataFrame:
    """Write counts that are known into the month's row, and the differences."""
    here = c.in_month(F.col("file_month"), as_of)
    for name, count in counts.items():
        old = F.col(name) if name in rowcounts.columns else F.lit(None).cast("bigint")
        rowcounts = rowcounts.withColumn(name, F.when(here, F.lit(count).cast("bigint")).otherwise(old))
    return add_differences(rowcounts, as_of)
