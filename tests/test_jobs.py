"""The monthly job over versioned tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollbook.bindings.views import view
from rollbook.operators import codes, control, locations
from rollbook.plans import jobs
from rollbook.sources import register as files
from rollbook.sources.snapshots import Parts, Snapshots

SF_DIR = "/root/testdata/sf0.001"
AS_OF = dt.date(2001, 7, 15)
RESULTS = ["organisation", "sic_code", "code_analytics", "category_analytics", "register", "geo_location"]
REJECTS = ["sic_code_rejects", "geo_location_rejects", "code_analytics_rejects", "category_analytics_rejects"]
MONTH = dt.date(2001, 7, 1)
MADE = [*RESULTS, *REJECTS, "sic_counts", "category_totals", "rowcounts", "filetracker"]


def category():
    return F.substring("sic_code", 1, 2)


@pytest.fixture
def store(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    counts = view(spark, SF_DIR, "sic_counts")
    totals = codes.category_totals(counts)
    audit = {"last_modified_by": F.lit("seed"), "last_modified_date": F.lit(dt.date(2001, 6, 1))}
    by_code = codes.code_month_over_month(counts, AS_OF).limit(0).withColumns(audit)
    by_category = codes.category_month_over_month(totals, AS_OF).limit(0).withColumns(
        audit | {"category_description": F.lit(None).cast("string")}
    )
    tables = {
        "register": view(spark, SF_DIR, "company_file").withColumn("md5_key", F.lit(None).cast("string")),
        "organisation": view(spark, SF_DIR, "organisation_prev"),
        "sic_code": view(spark, SF_DIR, "sic_code_prev"),
        "sic_counts": counts,
        "category_totals": totals,
        "code_analytics": by_code,
        "category_analytics": by_category,
        "geo_location": view(spark, SF_DIR, "geo_prev"),
        "post_code_mappings": view(spark, SF_DIR, "post_code_mappings"),
        "sic_code_categories": view(spark, SF_DIR, "sic_code_categories"),
        "filetracker": view(spark, SF_DIR, "filetracker"),
        "rowcounts": view(spark, SF_DIR, "rowcounts"),
    }
    for name, table in tables.items():
        store.write(name, table, "seed")
    return store


def test_monthly_job(spark, store):
    assert jobs.run_derived_tables(store, AS_OF, "2001-07")
    assert {store.version(name) for name in RESULTS} == {1}
    assert not jobs.run_derived_tables(store, AS_OF, "2001-07")
    assert not jobs.run_derived_tables(store, AS_OF, "2001-07 once more")
    assert {store.version(name) for name in RESULTS} == {1}

    geo = store.read("geo_location")
    offices = geo.filter(locations.is_home_head_office()).groupBy("organisation_id").count()
    assert offices.agg(F.max("count")).first()[0] == 1
    for name, key in [("organisation", "id"), ("sic_code", "md5"), ("geo_location", "md5_key")]:
        table = store.read(name)
        assert table.count() == table.select(key).distinct().count()
    assert store.read("sic_code_rejects").filter("md5 is not null").count() == 0
    assert store.read("sic_code_rejects").count() > 0
    assert {store.version(name) for name in REJECTS} == {0}
    companies = store.read("register").count()
    assert store.read("organisation").count() == companies


def test_interrupted_job_goes_on(spark, store, monkeypatch):
    write = Snapshots.write

    def fail(self, name, table, run, **options):
        if name == "geo_location":
            raise OSError("lost")
        return write(self, name, table, run, **options)

    monkeypatch.setattr(Snapshots, "write", fail)
    with pytest.raises(OSError):
        jobs.run_derived_tables(store, AS_OF, "2001-07")
    monkeypatch.setattr(Snapshots, "write", write)
    fresh = Snapshots(spark, store.root)
    assert jobs.run_derived_tables(fresh, AS_OF, "2001-07")
    assert {fresh.version(name) for name in RESULTS} == {1}
    assert fresh.read("filetracker").filter("section3 is not null").count() > 0


def test_second_month_only_moves_audit_columns(spark, store):
    jobs.run_derived_tables(store, AS_OF, "2001-07")
    before = {name: store.read(name) for name in ["organisation", "sic_code", "geo_location"]}
    tracker = store.read("filetracker").withColumn("section3", F.lit(None).cast("date"))
    store.write("filetracker", tracker, "reopened")
    assert jobs.run_derived_tables(store, AS_OF, "2001-08")
    for name, table in before.items():
        audit = {"last_modified_date", "last_modified_by", "date_last_modified"}
        same = [column for column in table.columns if column not in audit]
        after = store.read(name)
        assert after.count() == table.count()
        assert table.select(same).exceptAll(after.select(same)).isEmpty()


def test_month_is_loaded_once(spark, store):
    counts, totals = store.read("sic_counts"), store.read("category_totals")
    register = store.read("register")
    month = dt.date(2001, 9, 1)
    category = F.substring("sic_code", 1, 2)
    once_counts, once_totals = jobs.load_month(counts, totals, register, month, category)
    added = once_counts.filter(F.col("file_date") == F.lit(month))
    assert added.agg(F.sum("counts")).first()[0] == codes.count_codes(register, []).agg(F.sum("sic_code_count")).first()[0]
    twice_counts, twice_totals = jobs.load_month(once_counts, once_totals, register, month, category)
    assert twice_counts.exceptAll(once_counts).isEmpty()
    assert twice_totals.exceptAll(once_totals).isEmpty()
    assert twice_totals.count() == once_totals.count()


def rows_of(store, name, run):
    table = store.read(name, version=store.version_of(name, run))
    return sorted(table.select(*sorted(table.columns)).collect(), key=str)


def test_month_is_replaced_in_the_run(spark, store):
    stale = spark.createDataFrame([("gone", "xx", MONTH, 5)], "sic_code string, sic_code_category string, file_date date, counts long")
    counts = store.write("sic_counts", store.read("sic_counts").unionByName(stale), "stale")
    store.write("category_totals", codes.category_totals(counts), "stale")
    assert jobs.run_derived_tables(store, AS_OF, "r", MONTH, category())
    here = F.col("file_date") == F.lit(MONTH)
    expected = codes.monthly_code_counts(store.read("register"), F.lit(MONTH), category())
    found = store.read("sic_counts").filter(here).select(*expected.columns)
    assert found.count() == expected.count() and found.exceptAll(expected).isEmpty()
    totals = store.read("category_totals").filter(here)
    assert totals.exceptAll(codes.category_totals(expected).select(*totals.columns)).isEmpty() and totals.count() > 0
    assert store.read("sic_counts").filter(~here).exceptAll(counts.filter(~here)).isEmpty()
    report = store.read("code_analytics").filter(F.col("second_month") == F.lit(MONTH))
    assert report.filter("sic_code = 'gone'").isEmpty()
    assert not store.read("rowcounts").filter("sic_code_diff is not null").isEmpty()


def test_month_laid_out_in_parts(spark, store, tmp_path):
    laid = Snapshots(spark, str(tmp_path / "laid"), parts={"sic_counts": Parts("file_date"), "category_totals": Parts("file_date")})
    for name in {entry.name for entry in store.entries}:
        laid.write(name, store.read(name), "seed")
    assert jobs.run_derived_tables(laid, AS_OF, "r", MONTH, category())
    assert jobs.run_derived_tables(store, AS_OF, "r", MONTH, category())
    for name in MADE:
        assert rows_of(laid, name, "r") == rows_of(store, name, "r"), name
    months = [path.name for path in (tmp_path / "laid" / "sic_counts" / "version=00000001").glob("file_date=*")]
    assert months == [f"file_date={MONTH}"]
    pair = codes.code_month_over_month(laid.read("sic_counts"), AS_OF)
    assert {row.path for row in read_folders(laid.read("sic_counts").filter("file_date >= '2001-06-01' and file_date < '2001-08-01'"))} <= {"2001-06-01", "2001-07-01"}
    plan = pair._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "file_date" in plan.split("PartitionFilters")[1][:400]


def read_folders(table):
    path = F.regexp_extract("_metadata.file_path", "file_date=([^/]+)/", 1)
    return table.select(path.alias("path")).distinct().collect()


@pytest.mark.parametrize("name", ["category_totals", "register", "geo_location", "filetracker"])
def test_resumed_run_equals_an_undisturbed_one(spark, store, tmp_path, monkeypatch, name):
    """The run stops before it writes ``name``, new companies and changed ones come in, the run goes on."""
    calm = Snapshots(spark, str(tmp_path / "calm"))
    for table in {entry.name for entry in store.entries}:
        calm.write(table, store.read(table), "seed")
    jobs.run_derived_tables(calm, AS_OF, "r", MONTH, category())

    write = Snapshots.write

    def fail(self, table, *rest, **options):
        if table == name:
            raise OSError("lost")
        return write(self, table, *rest, **options)

    monkeypatch.setattr(Snapshots, "write", fail)
    with pytest.raises(OSError):
        jobs.run_derived_tables(store, AS_OF, "r", MONTH, category())
    monkeypatch.setattr(Snapshots, "write", write)
    came = Snapshots(spark, store.root)
    register = came.read("register")
    few = [row.company_number for row in register.select("company_number").orderBy("company_number").limit(3).collect()]
    renamed = F.when(F.col("company_number").isin(few), F.lit("CHANGED")).otherwise(F.col("company_name"))
    new = register.limit(1).withColumns(
        {"company_number": F.lit("NEW"), "organisation_id": F.lit("UKNEW"), "company_name": F.lit("CHANGED"), "sic_text_1": F.lit("99999 - New")}
    )
    came.write("register", register.withColumn("company_name", renamed).unionByName(new), "in between")
    changed = came.read("register").filter("company_name = 'CHANGED'").count()
    later = came.read("filetracker").filter("section2 is null").limit(1).select("filename")
    came.write("filetracker", control.mark_section(came.read("filetracker"), "section2", later, AS_OF), "in between")

    fresh = Snapshots(spark, store.root)
    assert jobs.run_derived_tables(fresh, AS_OF, "r", MONTH, category())
    for table in MADE:
        if table not in ("register", "filetracker"):
            assert rows_of(fresh, table, "r") == rows_of(calm, table, "r"), table
    assert changed == 4 == fresh.read("register").filter("company_name = 'CHANGED'").count()
    # What came in between waits for the next run.
    waiting = control.section_gate(fresh.read("filetracker"))
    assert [row.filename for row in waiting.select("filename").collect()] == [row.filename for row in later.collect()]


def test_release_from_file_to_tracker(spark, tmp_path):
    work = Snapshots(spark, str(tmp_path / "tables"))
    register = view(spark, SF_DIR, "company_file")
    files.export_fragments(register.repartition(2), str(tmp_path / "in"), 400)
    name = "BasicCompanyDataAsOneFile-2001-07-01.zip"
    assert jobs.register_release(work, name, str(tmp_path / "in"), MONTH, AS_OF, "r") == register.count()
    assert jobs.register_release(work, name, str(tmp_path / "in"), MONTH, AS_OF, "r") == register.count()
    tracker = work.read("filetracker").collect()
    assert [(row.filename, row.section1, row.section2) for row in tracker] == [(name, AS_OF, None)]
    assert not control.any_ready(work.read("filetracker"))
    jobs.load_release(work, name, str(tmp_path / "in"), str(tmp_path / "checkpoint"), AS_OF, "r")
    assert control.any_ready(work.read("filetracker"))
    counted = codes.month_from_fragments(work.read("fragment_counts"), "r", F.lit(MONTH), category())
    expected = codes.monthly_code_counts(register, F.lit(MONTH), category())
    assert counted.count() == expected.count() and counted.exceptAll(expected.select(*counted.columns)).isEmpty()
