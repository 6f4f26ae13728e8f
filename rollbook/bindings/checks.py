"""One query per operator over the views, and the DuckDB text of each.

``AS_OF`` is the fixed "now"; no query reads the clock.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.bindings.views import view
from rollbook.functions import columns as c
from rollbook.operators import (
    codes,
    control,
    locations,
    organisations,
    reconcile,
    registers,
)
from rollbook.plans import jobs
from rollbook.session import scratch_folder
from rollbook.sources import register as files
from rollbook.sources import cut, releases
from rollbook.sources.schema import CODE_TEXTS, REGISTER_NAMES
from rollbook.sources.snapshots import Parts, Snapshots, hash_parts
from rollbook.streaming import ingest

AS_OF = dt.date(2001, 7, 15)
TOUCHED_DAY = dt.date(2001, 7, 1)
RELEASE_FROM = dt.date(1997, 1, 1)
SNAPSHOT_TO = dt.date(2000, 1, 1)
TOTALS_TO = dt.date(2001, 1, 1)

CHECK_FRAGMENT_ROWS = 1_000
INGEST_FRAGMENT_ROWS = 5_000
INGEST_BATCHES = 3

FILE_COLUMNS = [
    "company_number", "company_name", "company_status", "IncorporationDate", *CODE_TEXTS,
    "reg_address_line1", "reg_address_line2", "reg_address_posttown", "reg_address_county",
    "reg_address_postcode",
]
GEO_COLUMNS = [
    "id", "organisation_id", "post_code", "md5_key", "address_type", "country",
    "date_last_modified", "last_modified_by",
]
FULL_GEO_COLUMNS = [
    "id", "address_1", "address_2", "town", "county", "post_code", "area_location", "country", "address_type",
    "post_code_formatted", "organisation_id", "md5_key", "date_last_modified", "last_modified_by",
]
LINK_NAME_PATTERN = "^/[a-z]+$"
REGISTER_PARTS = 64
#: Surrogate ids, and a column that only the test view has.
DIGEST_WITHOUT = ["n"]
RELEASE = "release"
RELEASE_MONTH = dt.date(2001, 7, 1)

CHECKS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def check(make: Callable[[SparkSession, Callable[[str], DataFrame]], DataFrame]):
    """Register a query under its function name; it gets the session and the views."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return make(spark, partial(view, spark, sf_dir))

    CHECKS[make.__name__] = run
    return make


# --- files ---


def _exported(spark, cf: DataFrame, rows_per_file: int) -> str:
    path = scratch_folder(spark, "fragments")
    files.export_fragments(cf, path, rows_per_file)
    return path


@check
def scan_register(spark, views):
    path = _exported(spark, views("company_file"), files.FRAGMENT_ROWS)
    return files.scan_register(spark, path).select(*FILE_COLUMNS)


@check
def scan_sic_columns(spark, views):
    path = _exported(spark, views("company_file"), files.FRAGMENT_ROWS)
    return files.scan_code_columns(spark, path)


@check
def ingest_fragments(spark, views):
    path = _exported(spark, views("company_file"), INGEST_FRAGMENT_ROWS)
    parts = len(spark.read.text(path).inputFiles())
    work = scratch_folder(spark, "ingest")
    register = ingest.ingest_fragments(
        spark,
        path,
        Snapshots(spark, f"{work}/tables"),
        f"{work}/checkpoint",
        AS_OF,
        "release",
        files_per_batch=-(-parts // INGEST_BATCHES),
    )
    return register.select(*FILE_COLUMNS, "organisation_id")


@check
def ingest_parts(spark, views):
    """A small release after the first one, into a register in parts: it writes the parts that it touches."""
    work = scratch_folder(spark, "ingest_parts")
    store = Snapshots(spark, f"{work}/tables", parts={"register": hash_parts("company_number", REGISTER_PARTS)})
    cf = views("company_file")
    first = registers.upsert_register(registers.empty_register(spark), cf.select(*FILE_COLUMNS), AS_OF, unique=True)
    store.write("register", first.next, "first")
    few = cf.filter("n % 50000 < 32 and n % 3 = 0").withColumn("company_status", F.lit("Dissolved"))
    files.export_fragments(few, f"{work}/in")
    register = ingest.ingest_fragments(spark, f"{work}/in", store, f"{work}/checkpoint", AS_OF, RELEASE)
    return register.select(*FILE_COLUMNS, "organisation_id")


@check
def cut_raw_file(spark, views):
    """One file with line breaks in its values, read in splits."""
    path = scratch_folder(spark, "raw")
    raw = files.as_register_file(views("raw_file")).coalesce(1)
    raw.write.options(**files.WRITE_OPTIONS).csv(path)
    return cut.scan_raw_register(spark, path).select(*FILE_COLUMNS)


@check
def fragment_counts(spark, views):
    """The month as the sum of what its fragments counted while they were ingested, one of them twice."""
    work = scratch_folder(spark, "fragment_counts")
    files.export_fragments(views("company_file"), f"{work}/in", INGEST_FRAGMENT_ROWS)
    parts = {"fragment_counts": hash_parts("file_name", 8), "register": hash_parts("company_number", REGISTER_PARTS)}
    store = Snapshots(spark, f"{work}/tables", parts=parts)
    for attempt in ("first", "again"):
        ingest.ingest_fragments(spark, f"{work}/in", store, f"{work}/{attempt}", AS_OF, RELEASE, count_codes=True)
    return codes.month_from_fragments(
        store.read("fragment_counts"), RELEASE, F.lit(RELEASE_MONTH), F.substring("sic_code", 1, 2)
    )


@check
def export_fragments(spark, views):
    path = _exported(spark, views("company_file"), CHECK_FRAGMENT_ROWS)
    return files.file_row_counts(spark, path).agg(
        F.sum("row_count").alias("rows_total"),
        (F.max("row_count") <= CHECK_FRAGMENT_ROWS).alias("within_limit"),
    )


@check
def file_row_counts(spark, views):
    path = _exported(spark, views("company_file"), CHECK_FRAGMENT_ROWS)
    return files.total_row_count(files.file_row_counts(spark, path))


@check
def landing_overwrite(spark, views):
    batch = views("company_file").select("company_number", "company_name", "company_status")
    path = scratch_folder(spark, "landing")
    files.land(codes.active(batch), path)
    return files.land(batch, path)


@check
def release_links(spark, views):
    return releases.page_links(views("pages"))


@check
def matching_links(spark, views):
    return releases.release_links(releases.page_links(views("pages")), LINK_NAME_PATTERN)


@check
def release_files(spark, views):
    """The release files, with their dates, that pages with several kinds of links name."""
    return releases.release_links(releases.page_links(views("release_pages")))


@check
def unprocessed_releases(spark, views):
    links = releases.page_links(views("pages")).withColumnRenamed("href", "filename")
    return releases.unprocessed(links, views("filetracker"))


@check
def file_name_parts(spark, views):
    names = views("rowcounts").select(
        F.concat(F.lit("in/Register-"), F.col("file_month").cast("string"), F.lit(".zip")).alias("release"),
        F.concat(F.lit("in/part_"), F.col("file_rowcount").cast("string"), F.lit(".csv")).alias("part"),
    )
    return names.select(
        c.file_name(F.col("release")).alias("release_name"),
        c.release_date(F.col("release")).alias("release_date"),
        c.file_name(F.col("part")).alias("part_name"),
        c.fragment_number(F.col("part")).alias("part_number"),
    ).orderBy("part_number", "release_name")


# --- projections and functions ---


@check
def filter_active(spark, views):
    return codes.active(views("company_file")).select("company_number", "company_status")


@check
def code_extract_rules(spark, views):
    texts = codes.unpivot_codes(views("company_file"), []).select("text").distinct()
    text = F.col("text")
    return texts.filter(text.isNotNull()).select(
        "text",
        c.first_digits(text).alias("first_digits"),
        c.only_digits(text).alias("only_digits"),
        c.before_dash(text).alias("before_dash"),
    )


@check
def content_keys(spark, views):
    number, organisation = F.col("company_number"), F.col("organisation_id")
    return views("company_file").select(
        "company_number",
        c.content_key(number, c.first_digits(F.col("sic_text_2"))).alias("code_key"),
        c.content_key(organisation, F.col("reg_address_postcode")).alias("geo_key"),
        c.content_key(organisation, F.col("file_day")).alias("date_key"),
    )


@check
def postcode_normalise(spark, views):
    return views("company_file").select(
        "company_number", c.normal_postcode(F.col("reg_address_postcode")).alias("post_code_formatted")
    )


@check
def parse_dates(spark, views):
    return views("company_file").select(
        "company_number", c.register_date(F.col("IncorporationDate")).alias("date_formed")
    )


@check
def previous_month(spark, views):
    return views("rowcounts").select(
        "file_month", c.previous_month(F.col("file_month")).alias("previous_month")
    )


@check
def changed_in_month(spark, views):
    table = views("sic_code_prev")
    return table.filter(c.in_month(F.col("date_last_modified"), AS_OF))


@check
def touched_today(spark, views):
    return registers.touched_on(views("sic_code_prev"), TOUCHED_DAY, "date_last_modified")


# --- codes ---


def _counts(spark, views) -> DataFrame:
    """The monthly fact as the stored table that the reports read."""
    return files.land(views("sic_counts"), scratch_folder(spark, "counts"))


@check
def unpivot_codes(spark, views):
    return codes.unpivot_codes(views("company_file"), ["company_number"])


@check
def active_code_counts(spark, views):
    return codes.active_code_counts(views("company_file"))


@check
def monthly_code_counts(spark, views):
    return codes.monthly_code_counts(
        views("company_file"), c.month_start(F.col("file_day")), F.substring("sic_code", 1, 2)
    )


@check
def code_candidates(spark, views):
    candidates = codes.code_candidates(views("company_file"), AS_OF)
    return candidates.drop("date_last_modified").distinct()


@check
def potential_code_entries(spark, views):
    return codes.potential_code_entries(views("company_file"))


@check
def upsert_codes(spark, views):
    candidates = codes.code_candidates(views("company_file"), AS_OF)
    return codes.upsert_codes(views("sic_code_prev"), candidates, AS_OF).next


@check
def rejected_codes(spark, views):
    candidates = codes.code_candidates(views("company_file"), AS_OF)
    return codes.upsert_codes(views("sic_code_prev"), candidates, AS_OF).rejects


@check
def category_totals(spark, views):
    return codes.category_totals(_counts(spark, views))


@check
def insert_new_totals(spark, views):
    totals = codes.category_totals(_counts(spark, views))
    known = totals.filter(F.col("file_date") < F.lit(TOTALS_TO))
    return codes.insert_new_totals(known, totals).next


def _rounded(report: DataFrame) -> DataFrame:
    return report.withColumn("pct_change", F.round("pct_change", 4))


@check
def code_month_over_month(spark, views):
    return _rounded(codes.code_month_over_month(_counts(spark, views), AS_OF))


@check
def aggregate_month_over_month(spark, views):
    totals = codes.category_totals(_counts(spark, views))
    return _rounded(codes.category_month_over_month(totals, AS_OF))


@check
def backfill_codes(spark, views):
    return _rounded(codes.backfill_codes(_counts(spark, views)))


@check
def backfill_categories(spark, views):
    return _rounded(codes.backfill_categories(codes.category_totals(_counts(spark, views))))


@check
def backfill_codes_all_months(spark, views):
    return _rounded(codes.backfill_codes(_counts(spark, views), codes.ALL_MONTHS))


@check
def fill_descriptions(spark, views):
    totals = codes.category_totals(_counts(spark, views))
    report = codes.category_month_over_month(totals, AS_OF)
    bare = report.withColumn("category_description", F.lit(None).cast("string"))
    return _rounded(codes.fill_descriptions(bare, views("sic_code_categories")))


def _report_before(current: DataFrame, earlier: DataFrame) -> DataFrame:
    """A report table that holds the month before and, wrongly counted, what grew."""
    grown = current.filter(F.col("diff") > 0).withColumn(
        "second_month_count", F.col("second_month_count") + 1
    )
    return (
        earlier.unionByName(grown)
        .withColumn("last_modified_by", F.lit("seed"))
        .withColumn("last_modified_date", F.lit(c.first_of_month(AS_OF, -1)))
    )


@check
def upsert_code_analytics(spark, views):
    counts = _counts(spark, views)
    report = codes.code_month_over_month(counts, AS_OF)
    earlier = codes.code_month_over_month(counts, c.first_of_month(AS_OF, -1))
    return _rounded(
        codes.upsert_code_analytics(_report_before(report, earlier), report, AS_OF).next
    )


@check
def upsert_category_analytics(spark, views):
    totals = codes.category_totals(_counts(spark, views))
    report = codes.category_month_over_month(totals, AS_OF)
    earlier = codes.category_month_over_month(totals, c.first_of_month(AS_OF, -1))
    target = _report_before(report, earlier).withColumn(
        "category_description", F.lit(None).cast("string")
    )
    merged = codes.upsert_category_analytics(target, report, AS_OF).next
    return _rounded(codes.fill_descriptions(merged, views("sic_code_categories")))


# --- register and organisations ---


@check
def upsert_register(spark, views):
    cf = views("company_file").drop("n")
    target = (
        cf.filter(F.col("file_day") < F.lit(SNAPSHOT_TO))
        .withColumn("company_status", F.lit("Dormant"))
        .withColumn("phone_number", F.lit("0"))
        .withColumn("md5_key", F.md5("organisation_id"))
        .withColumn("last_modified_date", F.lit(c.first_of_month(AS_OF, -1)))
        .withColumn("last_modified_by", F.lit("seed"))
    )
    batch = cf.filter(F.col("file_day") >= F.lit(RELEASE_FROM)).drop("organisation_id")
    return registers.upsert_register(target, batch, AS_OF, "release").next.drop("file_day")


def _wide(cf: DataFrame) -> DataFrame:
    """The company file with all columns of the register file: those it lacks say their name and a number, or nothing."""
    n = F.col("n")
    filled = {
        name: F.when(n % (at % 5 + 2) != 0, F.concat(F.lit(f"{name} "), (n % (at + 3)).cast("string")))
        for at, name in enumerate(REGISTER_NAMES)
        if name not in cf.columns or name == "sic_text_4"
    }
    return cf.withColumns(filled)


@check
def upsert_register_wide(spark, views):
    """All 55 columns of the file, those that no file fills, and the audit columns."""
    wide = _wide(views("company_file"))
    target = wide.filter(F.col("file_day") < F.lit(SNAPSHOT_TO)).withColumns(
        {name: F.concat(F.lit("old "), F.col(name)) for name in REGISTER_NAMES if name != registers.KEY}
        | {"phone_number": F.lit("0"), "number_of_employees": F.lit("1"), "Date_Of_Insert": F.lit("d"), "SourceFile": F.lit("s")}
        | {"md5_key": F.md5("organisation_id"), "last_modified_by": F.lit("seed")}
        | {"last_modified_date": F.lit(c.first_of_month(AS_OF, -1)).cast("timestamp")}
    )
    batch = wide.filter(F.col("file_day") >= F.lit(RELEASE_FROM)).select(*REGISTER_NAMES)
    names = registers.REGISTER_SCHEMA.fieldNames()
    merged = registers.upsert_register(target.select(*names), batch, AS_OF, RELEASE).next
    return merged.withColumn("last_modified_date", F.to_date("last_modified_date"))


@check
def upsert_organisation(spark, views):
    return organisations.upsert_organisation(
        views("organisation_prev"), views("company_file"), AS_OF
    ).next


# --- locations ---


@check
def postcode_repair(spark, views):
    return locations.repair_postcodes(views("company_file")).select(
        "company_number", "reg_address_postcode"
    )


@check
def postcode_repair_variants(spark, views):
    parts = [F.col(part) for part in locations.ADDRESS_PARTS]
    return views("company_file").select(
        "company_number",
        c.find_postcode(*parts).alias("found"),
        c.find_postcode(*parts, ignore_case=False).alias("found_exact_case"),
        c.find_postcode(*parts, skip_nulls=True).alias("found_skipping_nulls"),
    )


@check
def county_candidates(spark, views):
    return locations.county_candidates(views("company_file"), views("post_code_mappings"))


@check
def fill_counties(spark, views):
    return locations.fill_counties(views("company_file"), views("post_code_mappings")).select(
        "company_number", "reg_address_postcode", "reg_address_county"
    )


@check
def geo_keys(spark, views):
    return locations.add_geo_keys(views("company_file")).select(
        "company_number", "reg_address_postcode", "md5_key"
    )


@check
def project_geo_rows(spark, views):
    return locations.geo_rows(locations.add_geo_keys(views("company_file")), AS_OF)


@check
def orphan_locations(spark, views):
    rows = locations.geo_rows(locations.add_geo_keys(views("company_file")), AS_OF)
    return locations.without_parent(rows, views("organisation_prev")).select(
        "organisation_id", "post_code", "md5_key"
    )


@check
def parented_locations(spark, views):
    rows = locations.geo_rows(locations.add_geo_keys(views("company_file")), AS_OF)
    return locations.with_parent(rows, views("organisation_prev")).select(
        "organisation_id", "post_code", "md5_key"
    )


@check
def upsert_locations(spark, views):
    rows = locations.geo_rows(locations.add_geo_keys(views("company_file")), AS_OF)
    return locations.upsert_locations(views("geo_prev"), rows, AS_OF).next.select(*GEO_COLUMNS)


@check
def upsert_locations_wide(spark, views):
    """All 14 columns, of batches with and without counties."""
    filled = locations.fill_counties(views("company_file"), views("post_code_mappings"))
    rows = locations.geo_rows(locations.add_geo_keys(filled), AS_OF)
    return locations.upsert_locations(views("geo_prev"), rows, AS_OF).next.select(*FULL_GEO_COLUMNS)


def _locations_after_upsert(views) -> DataFrame:
    rows = locations.geo_rows(locations.add_geo_keys(views("company_file")), AS_OF)
    return locations.upsert_locations(views("geo_prev"), rows, AS_OF).next


@check
def head_office_rank(spark, views):
    return locations.head_office_rank(_locations_after_upsert(views))


@check
def keep_latest_head_office(spark, views):
    return locations.keep_latest_head_office(_locations_after_upsert(views)).select(*GEO_COLUMNS)


def _batch_and_state(views) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The numbered batch, the newest offices after it, and the ids that they replace."""
    target = views("geo_prev")
    rows = locations.geo_rows(locations.add_geo_keys(views("company_file")), AS_OF)
    numbered = locations.numbered_locations(target, rows, unique=True)
    offices = locations.batch_offices(target, numbered)
    return numbered, *locations.supersede(locations.newest_offices(target), offices)


@check
def keep_head_office_by_state(spark, views):
    """As ``keep_latest_head_office``, from the table of the newest offices."""
    numbered, _, gone = _batch_and_state(views)
    merged = locations.merge_locations(views("geo_prev"), numbered, AS_OF)
    return locations.drop_superseded(merged, gone).select(*GEO_COLUMNS)


@check
def newest_head_offices(spark, views):
    return _batch_and_state(views)[1]


# --- reconciliation and control ---


@check
def rowcount_codes(spark, views):
    cf = views("company_file")
    after = codes.upsert_codes(
        views("sic_code_prev"), codes.code_candidates(cf, AS_OF), AS_OF
    ).next
    counted = reconcile.count_potential_codes(views("rowcounts"), cf, AS_OF)
    return reconcile.count_changed_codes(counted, after, AS_OF)


@check
def rowcount_locations(spark, views):
    return reconcile.count_changed_locations(
        views("rowcounts"), _locations_after_upsert(views), AS_OF
    )


@check
def rowcount_organisations(spark, views):
    after = organisations.upsert_organisation(
        views("organisation_prev"), views("company_file"), AS_OF
    ).next
    return reconcile.count_changed_organisations(views("rowcounts"), after, AS_OF)


@check
def rowcount_diffs(spark, views):
    cf = views("company_file")
    code_table = codes.upsert_codes(
        views("sic_code_prev"), codes.code_candidates(cf, AS_OF), AS_OF
    ).next
    organisation = organisations.upsert_organisation(views("organisation_prev"), cf, AS_OF).next
    return jobs.reconcile_month(
        views("rowcounts"), cf, code_table, _locations_after_upsert(views), organisation, AS_OF
    )


@check
def rowcount_observed(spark, views):
    """As ``rowcount_diffs``, from what was counted while the tables were written."""
    cf = views("company_file")
    store = Snapshots(spark, scratch_folder(spark, "observed"))
    code_table = codes.upsert_codes(views("sic_code_prev"), codes.code_candidates(cf, AS_OF), AS_OF).next
    organisation = organisations.upsert_organisation(views("organisation_prev"), cf, AS_OF).next
    home, office = F.col("country") == "UK", locations.is_home_head_office()
    changed = {
        "sic_code": (code_table, reconcile.changed_count("date_last_modified", AS_OF)),
        "organisation": (organisation, reconcile.changed_count("last_modified_date", AS_OF, home)),
        "geo_location": (_locations_after_upsert(views), reconcile.changed_count("date_last_modified", AS_OF, office)),
    }
    for name, (table, count) in changed.items():
        store.write(name, table, RELEASE, count={jobs.CHANGED: count})
    store.write("register", cf, RELEASE, count={jobs.POTENTIAL: codes.potential_code_count()})
    counts = {jobs.POTENTIAL: store.counted("register", RELEASE)[jobs.POTENTIAL]}
    counts |= {column: store.counted(name, RELEASE)[jobs.CHANGED] for name, column in jobs.RECONCILED.items()}
    return reconcile.set_counts(views("rowcounts"), counts, AS_OF)


@check
def section_gate(spark, views):
    return control.section_gate(views("filetracker"))


@check
def mark_done(spark, views):
    return control.mark_done(views("filetracker"), AS_OF)


# --- jobs ---


@check
def refresh_addresses(spark, views):
    return jobs.refresh_register_addresses(
        views("company_file"), views("post_code_mappings")
    ).select("company_number", "reg_address_postcode", "reg_address_county", "md5_key")


@check
def refresh_locations(spark, views):
    register = jobs.refresh_register_addresses(views("company_file"), views("post_code_mappings"))
    return jobs.refresh_locations(views("geo_prev"), register, AS_OF).next.select(*GEO_COLUMNS)


@check
def refresh_parented_locations(spark, views):
    register = jobs.refresh_register_addresses(views("company_file"), views("post_code_mappings"))
    merged = jobs.refresh_locations(views("geo_prev"), register, AS_OF, views("organisation_prev"))
    return merged.next.select(*GEO_COLUMNS)


@check
def load_month(spark, views):
    counts = _counts(spark, views)
    totals = codes.category_totals(counts).filter(F.col("file_date") < F.lit(TOTALS_TO))
    category = F.substring("sic_code", 1, 2)
    loaded, _ = jobs.load_month(counts, totals, views("company_file"), TOUCHED_DAY, category)
    return loaded


@check
def load_month_totals(spark, views):
    counts = _counts(spark, views)
    totals = codes.category_totals(counts).filter(F.col("file_date") < F.lit(TOTALS_TO))
    category = F.substring("sic_code", 1, 2)
    _, loaded = jobs.load_month(counts, totals, views("company_file"), TOUCHED_DAY, category)
    return loaded


def _reloaded(spark, views) -> tuple[DataFrame, DataFrame]:
    """July is loaded again from a table in parts: the codes that it had vanish, others come."""
    parts = {"sic_counts": Parts("file_date"), "category_totals": Parts("file_date")}
    store = Snapshots(spark, scratch_folder(spark, "reloaded"), parts=parts)
    counts = store.write("sic_counts", views("sic_counts"), "seed")
    totals = store.write("category_totals", codes.category_totals(counts), "seed")
    month = codes.monthly_code_counts(views("company_file"), F.lit(RELEASE_MONTH), F.substring("sic_code", 1, 2))
    counts = store.write("sic_counts", month.select(*counts.columns), RELEASE, parts=[str(RELEASE_MONTH)])
    of_month = codes.category_totals(counts.filter(F.col("file_date") == F.lit(RELEASE_MONTH)))
    totals = store.write("category_totals", of_month.select(*totals.columns), RELEASE, parts=[str(RELEASE_MONTH)])
    return counts, totals


@check
def reload_month(spark, views):
    return _reloaded(spark, views)[0]


@check
def reload_month_totals(spark, views):
    return _reloaded(spark, views)[1]


def _empty_reports(counts: DataFrame, totals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Report tables that hold the month pair before the current one."""
    month = c.first_of_month(AS_OF, -1)
    audit = {"last_modified_by": F.lit("seed"), "last_modified_date": F.lit(month)}
    by_code = codes.code_month_over_month(counts, month).withColumns(audit)
    by_category = codes.category_month_over_month(totals, month).withColumns(
        audit | {"category_description": F.lit(None).cast("string")}
    )
    return by_code, by_category


def _refreshed_codes(spark, views) -> jobs.Codes:
    counts = _counts(spark, views)
    totals = codes.category_totals(counts)
    return jobs.refresh_codes(
        views("sic_code_prev"),
        *_empty_reports(counts, totals),
        views("company_file"),
        counts,
        totals,
        views("sic_code_categories"),
        AS_OF,
    )


@check
def refresh_codes(spark, views):
    return _refreshed_codes(spark, views).sic_code


@check
def refresh_codes_report(spark, views):
    return _rounded(_refreshed_codes(spark, views).code_analytics)


@check
def refresh_codes_categories(spark, views):
    return _rounded(_refreshed_codes(spark, views).category_analytics)


@check
def refresh_codes_rejects(spark, views):
    return _refreshed_codes(spark, views).sic_code_rejects


def _digest(table: DataFrame, name: str) -> DataFrame:
    """(table_name, row_count, digest): the sum of a hash of every row, all columns but the ids included."""

    def text(column: str, kind: str):
        if kind == "double":
            return F.round(F.col(column) * 10_000).cast("bigint").cast("string")
        return F.col(column).cast("date").cast("string") if kind in ("date", "timestamp") else F.col(column).cast("string")

    kinds = {column: kind for column, kind in table.dtypes if column not in DIGEST_WITHOUT}
    row = F.concat_ws("|", *[F.coalesce(text(column, kinds[column]), F.lit("~")) for column in sorted(kinds, key=str.lower)])
    value = F.conv(F.substring(F.md5(row), 1, 8), 16, 10).cast("bigint")
    return table.agg(F.count("*").alias("row_count"), F.sum(value).alias("digest")).select(F.lit(name).alias("table_name"), "row_count", "digest")


@check
def refresh_all(spark, views):
    store = Snapshots(spark, scratch_folder(spark, "tables"))
    counts = _counts(spark, views)
    totals = codes.category_totals(counts)
    by_code, by_category = _empty_reports(counts, totals)
    seed = {
        "register": views("company_file").withColumn("md5_key", F.lit(None).cast("string")),
        "organisation": views("organisation_prev"),
        "sic_code": views("sic_code_prev"),
        "sic_counts": counts,
        "category_totals": totals,
        "code_analytics": by_code,
        "category_analytics": by_category,
        "geo_location": views("geo_prev"),
        "post_code_mappings": views("post_code_mappings"),
        "sic_code_categories": views("sic_code_categories"),
        "filetracker": views("filetracker"),
    }
    for name, table in seed.items():
        store.write(name, table, "seed")
    jobs.run_derived_tables(store, AS_OF, "2001-07")
    results = [
        "register", "organisation", "sic_code", "code_analytics", "category_analytics",
        "geo_location", "filetracker",
    ]
    digests = [_digest(store.read(name), name) for name in results]
    total = digests[0]
    for digest in digests[1:]:
        total = total.unionByName(digest)
    return total
