"""Tracker, row counts and release pages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rollbook.operators import control, reconcile, registers
from rollbook.sources import releases

AS_OF = dt.date(2001, 7, 15)
D = dt.date(2001, 6, 1)


def test_gate_and_mark(spark):
    tracker = spark.createDataFrame(
        [("loaded", D, D, None), ("fetched", D, None, None), ("done", D, D, D)],
        "filename string, section1 date, section2 date, section3 date",
    )
    assert [row.filename for row in control.section_gate(tracker).collect()] == ["loaded"]
    assert control.any_ready(tracker)
    marked = control.mark_done(tracker, AS_OF)
    assert {row.filename: row.section3 for row in marked.collect()} == {"loaded": AS_OF, "fetched": None, "done": D}
    assert not control.any_ready(marked)


def rowcounts(spark):
    return spark.createDataFrame(
        [(dt.date(2001, 7, 3), 10), (dt.date(2001, 6, 1), 8), (dt.date(2000, 7, 1), 6)],
        "file_month date, file_rowcount bigint",
    )


def test_counts_go_into_the_month(spark):
    changed = spark.createDataFrame(
        [(D, "UK"), (AS_OF, "UK"), (dt.date(2001, 7, 31), "UK"), (AS_OF, "IE"), (dt.date(2000, 7, 15), "UK")],
        "last_modified_date date, country string",
    )
    counted = reconcile.count_changed_organisations(rowcounts(spark), changed, AS_OF)
    found = {row.file_month: row.rows_changed_in_org for row in counted.collect()}
    assert found == {dt.date(2001, 7, 3): 2, D: None, dt.date(2000, 7, 1): None}
    everywhere = reconcile.count_changed_organisations(rowcounts(spark), changed, AS_OF, all_rows=True)
    assert {row.rows_changed_in_org for row in everywhere.collect()} == {2}


def test_differences_touch_the_month_only(spark):
    counted = (
        rowcounts(spark)
        .withColumn("rows_changed_in_geolocation", F.lit(4).cast("bigint"))
        .withColumn("rows_changed_in_org", F.lit(5).cast("bigint"))
        .withColumn("rows_changed_in_siccode", F.lit(6).cast("bigint"))
        .withColumn("sic_code_diff", F.lit(-1).cast("bigint"))
    )
    found = {
        row.file_month: (row.geolocation_diff, row.organisation_diff, row.sic_code_diff)
        for row in reconcile.add_differences(counted, AS_OF).collect()
    }
    assert found[dt.date(2001, 7, 3)] == (6, 5, 4)
    assert found[D] == found[dt.date(2000, 7, 1)] == (None, None, -1)


def test_rows_touched_on_a_day(spark):
    table = spark.createDataFrame(
        [(dt.datetime(2001, 7, 15, 23, 59),), (dt.datetime(2001, 7, 16),), (None,)], "last_modified_date timestamp"
    )
    assert registers.touched_on(table, AS_OF).first().touched == 1


def test_release_pages(spark):
    pages = spark.createDataFrame(
        [
            (1, '<a href="BasicCompanyDataAsOneFile-2024-01-01.zip">a</a><a href="other.zip">b</a>'),
            (2, '<a href="/x/BasicCompanyDataAsOneFile-2024-02-01.zip"><a href="BasicCompanyDataAsOneFile-2024-01-01.zip">'),
            (3, "<link href='style.css'><p>nothing</p><A class=x HREF = 'third.zip'>"),
            (4, None),
        ],
        "page_id bigint, html string",
    )
    links = releases.page_links(pages)
    assert links.count() == 5
    assert [row.href for row in links.filter("page_id = 3").collect()] == ["third.zip"]
    found = releases.release_links(links)
    assert {(row.page_id, row.filename[-14:-4], row.release_date) for row in found.collect()} == {
        (1, "2024-01-01", dt.date(2024, 1, 1)),
        (2, "2024-02-01", dt.date(2024, 2, 1)),
        (2, "2024-01-01", dt.date(2024, 1, 1)),
    }
    tracker = spark.createDataFrame(
        [("BasicCompanyDataAsOneFile-2024-01-01.zip", D), ("BasicCompanyDataAsOneFile-2024-02-01.zip", None)],
        "filename string, section1 date",
    )
    waiting = releases.unprocessed(found, tracker).collect()
    assert [row.filename for row in waiting] == ["BasicCompanyDataAsOneFile-2024-02-01.zip"]
