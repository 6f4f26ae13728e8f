"""Composite jobs.

The functions that return frames are lazy chains. ``run_derived_tables`` is the
monthly job: it writes each table as a new version and reads it back where a
later step would otherwise compute it again, which also cuts the lineage with
storage that outlives an executor.

The jobs take a register that holds each company once, which is what the ingest
leaves, and pass that on as ``unique`` batches.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.operators import codes, control, locations, organisations, reconcile
from rollbook.operators.merge import Upserted, has_key, upsert
from rollbook.sources import register as files
from rollbook.sources.snapshots import Snapshots
from rollbook.streaming import ingest


class Codes(NamedTuple):
    sic_code: DataFrame
    code_analytics: DataFrame
    category_analytics: DataFrame
    sic_code_rejects: DataFrame
    code_analytics_rejects: DataFrame
    category_analytics_rejects: DataFrame


POTENTIAL, CHANGED = "potential_sic_code_entries", "changed"
#: The tables whose changed rows are counted, and the column for it.
RECONCILED = {
    "sic_code": "rows_changed_in_siccode",
    "geo_location": "rows_changed_in_geolocation",
    "organisation": "rows_changed_in_org",
}
#: The tables that the monthly run reads, and pins when it starts.
INPUTS = [
    "register", "organisation", "sic_code", "sic_counts", "category_totals", "code_analytics", "category_analytics",
    "geo_location", "post_code_mappings", "sic_code_categories", "filetracker", "fragment_counts", "head_offices",
]


def refresh_register_addresses(register: DataFrame, mapping: DataFrame) -> DataFrame:
    """Postcodes, then counties, then keys.

    The order matters: the county is looked up by the repaired postcode, and
    both need missing postcodes to be NULL, which the last step ends.
    """
    repaired = locations.repair_postcodes(register)
    return locations.add_geo_keys(locations.fill_counties(repaired, mapping))


def refresh_locations(
    geo: DataFrame,
    register: DataFrame,
    as_of: dt.date,
    organisation: DataFrame | None = None,
) -> Upserted:
    """The next location table from a register whose addresses are refreshed.

    With ``organisation``, rows without a parent there are rejects, like rows
    without a key.
    """
    rows = locations.geo_rows(register, as_of)
    orphans = None
    if organisation is not None:
        orphans = locations.without_parent(rows, organisation)
        rows = locations.with_parent(rows, organisation)
    merged = locations.upsert_locations(geo, rows, as_of, unique=True)
    rejects = merged.rejects if orphans is None else merged.rejects.unionByName(orphans)
    return Upserted(locations.keep_latest_head_office(merged.next), rejects)


def refresh_codes(
    code_table: DataFrame,
    code_analytics: DataFrame,
    category_analytics: DataFrame,
    register: DataFrame,
    counts: DataFrame,
    totals: DataFrame,
    categories: DataFrame,
    as_of: dt.date,
) -> Codes:
    """The code table and both month-over-month reports of the month of ``as_of``."""
    candidates = codes.code_candidates(register, as_of)
    by_code = codes.code_month_over_month(counts, as_of)
    by_category = codes.category_month_over_month(totals, as_of)
    merged = codes.upsert_codes(code_table, candidates, as_of, unique=True)
    code_report = codes.upsert_code_analytics(code_analytics, by_code, as_of)
    category_report = codes.upsert_category_analytics(category_analytics, by_category, as_of)
    return Codes(
        merged.next,
        code_report.next,
        codes.fill_descriptions(category_report.next, categories),
        merged.rejects,
        code_report.rejects,
        category_report.rejects,
    )


def load_month(
    counts: DataFrame,
    totals: DataFrame,
    register: DataFrame,
    file_date: dt.date,
    category: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The monthly fact and the category totals with the month of one release.

    All files of the release are counted at once. A month that is loaded again
    replaces its counts; totals that exist are left alone.
    """
    month = codes.monthly_code_counts(register, F.lit(file_date), category)
    keys = ["sic_code", "file_date"]
    merged = upsert(counts, month, keys, overwrite=["sic_code_category", "counts"], unique=True)
    new_totals = codes.category_totals(merged.next)
    return merged.next, codes.insert_new_totals(totals, new_totals).next


def reload_month(
    counts: DataFrame, totals: DataFrame, month: DataFrame, file_date: dt.date
) -> tuple[DataFrame, DataFrame]:
    """The monthly fact and the category totals with one month replaced by ``month``, what vanished included."""
    return (
        codes.replace_month(counts, month, file_date),
        codes.replace_month(totals, codes.category_totals(month), file_date),
    )


def reconcile_month(
    rowcounts: DataFrame,
    register: DataFrame,
    code_table: DataFrame,
    geo: DataFrame,
    organisation: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """All counts and differences of the month of ``as_of``."""
    counted = reconcile.count_potential_codes(rowcounts, register, as_of, unique=True)
    counted = reconcile.count_changed_codes(counted, code_table, as_of)
    counted = reconcile.count_changed_locations(counted, geo, as_of)
    counted = reconcile.count_changed_organisations(counted, organisation, as_of)
    return reconcile.add_differences(counted, as_of)


def register_release(
    store: Snapshots, filename: str, fragments: str, file_month: dt.date, as_of: dt.date, run: str, multi_line: bool = True
) -> int:
    """Note a release whose fragments are at hand: its records in ``rowcounts``, its name in the tracker as section 1.

    Returns the number of records. A release noted again sets its count anew.
    """
    spark = store.spark
    counted = files.total_row_count(files.file_row_counts(spark, fragments, multi_line))
    if not store.finished("rowcounts", run):
        row = counted.select(F.lit(file_month).alias("file_month"), "file_rowcount")
        target = store.read("rowcounts", row.limit(0))
        store.write("rowcounts", upsert(target, row, ["file_month"], overwrite=["file_rowcount"], unique=True).next, run)
    mark_section(store, "section1", filename, as_of, run)
    return store.read("rowcounts").filter(F.col("file_month") == F.lit(file_month)).select("file_rowcount").first()[0]


def mark_section(store: Snapshots, section: str, filename: str, as_of: dt.date, run: str) -> None:
    """Date a section of one file in the stored tracker."""
    named = store.spark.range(0, 1, 1, 1).select(F.lit(filename).alias("filename"))
    none = named.limit(0).select("filename", *[F.lit(None).cast("date").alias(name) for name in control.SECTIONS])
    tracker = control.mark_section(store.read("filetracker", none), section, named, as_of)
    store.write("filetracker", tracker, f"{run}/{section}")


def load_release(
    store: Snapshots, filename: str, folder: str, checkpoint: str, as_of: dt.date, run: str, **options
) -> DataFrame:
    """Ingest the fragments of a release, count their codes, and date section 2 of its file when all are in."""
    register = ingest.ingest_fragments(store.spark, folder, store, checkpoint, as_of, run, count_codes=True, **options)
    mark_section(store, "section2", filename, as_of, run)
    return register


def _write_month(store: Snapshots, name: str, before: DataFrame, month: DataFrame, file_date: dt.date, run: str) -> None:
    """Replace a month of a stored table: its part alone, if the table is laid out by ``file_date``."""
    if name in store.parts:
        store.write(name, month.select(*before.columns), run, parts=[str(file_date)])
    else:
        store.write(name, codes.replace_month(before, month, file_date), run)


def run_derived_tables(
    store: Snapshots, as_of: dt.date, run: str, file_date: dt.date | None = None, category: Column | None = None
) -> bool:
    """Refresh all derived tables from the register, if a file is waiting.

    Expects the tables ``register, organisation, sic_code, sic_counts,
    category_totals, code_analytics, category_analytics, geo_location,
    post_code_mappings, sic_code_categories, filetracker`` in ``store``. Rows
    that have no key go to a table of the same name with ``_rejects``.

    With ``file_date`` the counts and totals of that month are replaced first, by
    the sum of ``fragment_counts`` of this ``run`` if the ingest left any, else by a
    count of the register. With a table ``rowcounts`` the month is reconciled at last, from
    what was counted as the tables were written. The newest head offices are kept as
    ``head_offices``; from the second run on, older ones are found by that table alone.

    The run reads the versions that were newest when it started. One that died half-way
    may be started again under the same name: it reads the same versions, keeps the
    tables it has finished and writes the others. What came into the register in between
    stays there, with its addresses refreshed, and is left to the next run.
    """
    if store.finished("filetracker", run):
        return False
    if not store.pinned(run) and not control.any_ready(store.read("filetracker")):
        return False
    pins = store.pin(run, INPUTS)

    def before(name: str) -> DataFrame:
        return store.read(name, version=pins[name])

    def now(name: str) -> DataFrame:
        return store.read(name, version=store.version_of(name, run)) if store.finished(name, run) else before(name)

    register = before("register")
    if file_date is not None:
        month = _month(register, before("fragment_counts") if pins["fragment_counts"] >= 0 else None, run, file_date, category)
        if not store.finished("sic_counts", run):
            _write_month(store, "sic_counts", before("sic_counts"), month, file_date, run)
        if not store.finished("category_totals", run):
            counted = now("sic_counts").filter(F.col("file_date") == F.lit(file_date))
            _write_month(store, "category_totals", before("category_totals"), codes.category_totals(counted), file_date, run)

    if not store.finished("organisation", run):
        merged = organisations.upsert_organisation(before("organisation"), register, as_of, unique=True)
        home = F.col("country") == "UK"
        changed = {CHANGED: reconcile.changed_count("last_modified_date", as_of, home)} if "country" in merged.next.columns else None
        store.write("organisation", merged.next, run, clustered=True, count=changed)

    if not all(store.finished(name, run) for name in Codes._fields):
        refreshed = refresh_codes(
            before("sic_code"),
            before("code_analytics"),
            before("category_analytics"),
            register,
            now("sic_counts"),
            now("category_totals"),
            before("sic_code_categories"),
            as_of,
        )
        changed = {CHANGED: reconcile.changed_count("date_last_modified", as_of)}
        for name, table in refreshed._asdict().items():
            codes_table = name == "sic_code"
            store.write(name, table, run, clustered=codes_table, count=changed if codes_table else None)

    mapping = before("post_code_mappings")
    potential = {POTENTIAL: codes.potential_code_count()}
    if not store.finished("register", run):
        if store.version("register") != pins["register"]:
            # The locations of this run are made from the register it started with.
            store.write("register_of_run", refresh_register_addresses(register, mapping), run, count=potential)
        store.write("register", refresh_register_addresses(store.read("register"), mapping), run, count=potential)
    of_run = "register_of_run" if store.finished("register_of_run", run) else "register"
    refreshed = now(of_run)
    # The organisations were just taken from this register, so every row has its
    # parent and the check would only cost a join.
    if not store.finished("geo_location", run):
        geo, rows = before("geo_location"), locations.geo_rows(refreshed, as_of)
        newest = before("head_offices") if pins["head_offices"] >= 0 else locations.newest_offices(geo)
        store.write("geo_location_rejects", rows.filter(~has_key(["md5_key"])), run)
        batch = store.write("geo_batch", locations.numbered_locations(geo, rows, unique=True), run)
        after, gone = locations.supersede(newest, locations.batch_offices(geo, batch))
        store.write("head_offices", after, run)
        changed = {CHANGED: reconcile.changed_count("date_last_modified", as_of, locations.is_home_head_office())}
        # Without a table of the newest offices the location table may hold older ones besides.
        merged = locations.merge_locations(geo, batch, as_of)
        kept = locations.drop_superseded(merged, gone) if pins["head_offices"] >= 0 else locations.keep_latest_head_office(merged)
        store.write("geo_location", kept, run, count=changed)

    if store.version("rowcounts") >= 0 and not store.finished("rowcounts", run):
        counts = {POTENTIAL: store.counted(of_run, run)[POTENTIAL]}
        counts |= {column: store.counted(name, run).get(CHANGED, 0) for name, column in RECONCILED.items()}
        store.write("rowcounts", reconcile.set_counts(store.read("rowcounts"), counts, as_of), run)

    store.write("filetracker", control.mark_done(store.read("filetracker"), as_of, before("filetracker")), run)
    return True


def _month(register: DataFrame, fragments: DataFrame | None, run: str, file_date: dt.date, category: Column | None) -> DataFrame:
    if fragments is not None and not fragments.filter(F.col("release") == run).isEmpty():
        return codes.month_from_fragments(fragments, run, F.lit(file_date), category)
    return codes.monthly_code_counts(register, F.lit(file_date), category)
