"""Industry codes: counts, candidates, month-over-month reports and their upserts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions import columns as c
from rollbook.operators.merge import Upserted, upsert
from rollbook.sources.schema import CODE_TEXTS

# What counts as active, and categories that mean "none".
ACTIVE_STATUSES = ["Active", "Active - Proposal to Strike Off"]
BLANK_CATEGORIES = ["", "-"]

ALL_MONTHS = range(1, 13)
BACKFILL_MONTHS = range(1, 12)


# --- from the register to counts ---


def active(register: DataFrame) -> DataFrame:
    return register.filter(F.col("company_status").isin(ACTIVE_STATUSES))


def unpivot_codes(register: DataFrame, ids: Sequence[str]) -> DataFrame:
    """One row per company and code column (``slot``, ``text``), in one pass.

    Repeated texts and NULLs are kept.
    """
    return register.select(*ids, *CODE_TEXTS).unpivot(list(ids), CODE_TEXTS, "slot", "text")


def count_codes(register: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Codes of active companies counted per ``ids``; a text without digits counts as ''.

    Texts are counted first and only then stripped, so the regular expression
    runs once per distinct text and not once per company.
    """
    texts = (
        unpivot_codes(active(register), ids)
        .filter(F.col("text").isNotNull())
        .groupBy(*ids, "text")
        .agg(F.count("*").alias("n"))
    )
    return texts.groupBy(*ids, c.only_digits(F.col("text")).alias("sic_code")).agg(
        F.sum("n").alias("sic_code_count")
    )


def active_code_counts(register: DataFrame) -> DataFrame:
    """(sic_code, sic_code_count), most frequent first."""
    return count_codes(register, []).orderBy(F.desc("sic_code_count"), "sic_code")


def monthly_code_counts(
    register: DataFrame, file_date: Column, category: Column | None = None
) -> DataFrame:
    """The monthly fact (sic_code, sic_code_category, counts, file_date).

    All fragments of all months are counted at once. ``category`` is an
    expression over ``sic_code``; nothing in the register tells it.
    """
    counts = count_codes(register.withColumn("file_date", file_date), ["file_date"])
    return counts.select(
        "sic_code",
        (F.lit(None) if category is None else category).cast("string").alias("sic_code_category"),
        F.col("sic_code_count").alias("counts"),
        "file_date",
    )


def fragment_counts(fragments: DataFrame, release: str) -> DataFrame:
    """(release, file_name, sic_code, sic_code_count): what each file adds to the month's counts."""
    counts = count_codes(fragments, ["file_name"])
    return counts.select(F.lit(release).alias("release"), "file_name", "sic_code", "sic_code_count")


def replace_fragments(table: DataFrame, counts: DataFrame, files: DataFrame) -> DataFrame:
    """The table with the counts of ``files`` (release, file_name) replaced, also where nothing is left to count."""
    return table.join(files, ["release", "file_name"], "left_anti").select(*counts.columns).unionByName(counts)


def month_from_fragments(
    table: DataFrame, release: str, file_date: Column, category: Column | None = None
) -> DataFrame:
    """The monthly fact as the sum of the files' counts, without reading the register.

    A company that stands in two files counts in both.
    """
    counts = table.filter(F.col("release") == release).groupBy("sic_code").agg(F.sum("sic_code_count").alias("counts"))
    return counts.select(
        "sic_code",
        (F.lit(None) if category is None else category).cast("string").alias("sic_code_category"),
        "counts",
        file_date.alias("file_date"),
    )


def replace_month(table: DataFrame, month: DataFrame, file_date: dt.date) -> DataFrame:
    """The table with the rows of one ``file_date`` replaced; what is not counted any more goes."""
    other = F.coalesce(F.col("file_date") != F.lit(file_date), F.lit(True))
    return table.filter(other).unionByName(month.select(*table.columns))


# --- from the register to the code table ---


def code_candidates(register: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per company and distinct code, shaped like the code table.

    Texts without digits give one row with a NULL code and a NULL key. A code
    that repeats within a company is dropped in its row, before anything moves;
    where the register holds each company once, so do the candidates each key.
    """
    texts = [F.col(name) for name in CODE_TEXTS]
    found = [F.col(f"code_{number}") for number in range(len(texts))]
    coded = register.select(
        "company_number",
        *CODE_TEXTS,
        *[c.first_digits(text).alias(f"code_{number}") for number, text in enumerate(texts)],
    )
    slots = []
    for number, text in enumerate(texts):
        keep = text.isNotNull()
        for other in range(number):
            keep = keep & ~(texts[other].isNotNull() & found[number].eqNullSafe(found[other]))
        slots.append(F.when(keep, F.struct(found[number].alias("code"))).alias(f"slot_{number}"))
    names = [f"slot_{number}" for number in range(len(slots))]
    return (
        coded.select("company_number", *slots)
        .unpivot(["company_number"], names, "slot", "pair")
        .filter(F.col("pair").isNotNull())
        .select("company_number", "pair.code")
        .select(
            "code",
            c.organisation_id(F.col("company_number")).alias("organisation_id"),
            "company_number",
            c.content_key(F.col("company_number"), F.col("code")).alias("md5"),
            F.lit(as_of).alias("date_last_modified"),
        )
    )


def upsert_codes(
    target: DataFrame, candidates: DataFrame, as_of: dt.date, unique: bool = False
) -> Upserted:
    """New (company, code) pairs are inserted, known ones get the new date."""
    return upsert(
        target,
        candidates,
        ["md5"],
        on_match={"date_last_modified": F.lit(as_of)},
        unique=unique,
    )


def _codes_in_row() -> Column:
    return F.array_distinct(F.array(*[c.before_dash(F.col(text)) for text in CODE_TEXTS]))


def potential_code_count() -> Column:
    """The count of potential entries as an aggregate, where each company stands once."""
    return F.coalesce(F.sum(F.size(_codes_in_row())), F.lit(0))


def potential_code_entries(register: DataFrame, unique: bool = False) -> DataFrame:
    """Number of distinct (company, code before the dash) pairs; NULL is one code.

    Codes are made distinct within their row first. Where the register holds
    each company once, as ``unique`` states, their number is all there is to add
    up and nothing is shuffled.
    """
    name = "potential_sic_code_entries"
    if unique:
        return register.agg(potential_code_count().alias(name))
    pairs = register.select("company_number", F.explode(_codes_in_row()).alias("code"))
    return pairs.distinct().agg(F.count("*").alias(name))


# --- category totals ---


def category_totals(counts: DataFrame) -> DataFrame:
    """(file_date, Category, count, md5_str) per month and category."""
    return (
        counts.groupBy("file_date", F.col("sic_code_category").alias("Category"))
        .agg(F.sum("counts").alias("count"))
        .withColumn("md5_str", c.content_key(F.col("file_date"), F.col("Category")))
    )


def insert_new_totals(target: DataFrame, totals: DataFrame) -> Upserted:
    return upsert(target, totals, ["md5_str"])


# --- month over month ---


def _compare(
    before: DataFrame, after: DataFrame, on: Sequence[str], key: str, count: str, name: str, base: str
) -> DataFrame:
    """Inner join of two months, their difference and its percentage of ``base``."""
    first = before.select(
        *on, F.col("file_date").alias("first_month"), F.col(count).alias("first_month_count")
    )
    second = after.select(
        *on, F.col("file_date").alias("second_month"), F.col(count).alias("second_month_count")
    )
    diff = c.change(F.col("first_month_count"), F.col("second_month_count"))
    return first.join(second, list(on)).select(
        F.col(key).alias(name),
        "first_month",
        "second_month",
        "first_month_count",
        "second_month_count",
        diff.alias("diff"),
        c.percent(diff, F.col(base)).alias("pct_change"),
        c.content_key(F.col(key), F.col("first_month"), F.col("second_month")).alias("md5_str"),
    )


def _month_pair(facts: DataFrame, as_of: dt.date, **report: str) -> DataFrame:
    before = facts.filter(c.in_month(F.col("file_date"), as_of, -1))
    after = facts.filter(c.in_month(F.col("file_date"), as_of))
    return _compare(before, after, [report["key"]], **report)


def _all_month_pairs(facts: DataFrame, months: Sequence[int], **report: str) -> DataFrame:
    """Every month with the one before it, in one join on key and month.

    ``months`` are the months of the year that may be the later one. Either side is
    cut to the months it can use, so facts laid out by month are not read beyond these.
    """

    def of_months(wanted: Sequence[int]) -> DataFrame:
        return facts.filter(F.month("file_date").isin(list(wanted)))

    start = c.month_start(F.col("file_date"))
    after = of_months(months).withColumn("month", start)
    before = of_months([(month - 2) % 12 + 1 for month in months]).withColumn("month", F.add_months(start, 1))
    return _compare(before, after, [report["key"], "month"], **report)


# The percentage is of the later count for codes, of the earlier for categories.
CODE_REPORT = {
    "key": "sic_code", "count": "counts", "name": "sic_code", "base": "second_month_count",
}
CATEGORY_REPORT = {
    "key": "Category", "count": "count", "name": "sic_code_category", "base": "first_month_count",
}


def named_categories(totals: DataFrame) -> DataFrame:
    category = F.col("Category")
    return totals.filter(category.isNotNull() & ~category.isin(BLANK_CATEGORIES))


def code_month_over_month(counts: DataFrame, as_of: dt.date) -> DataFrame:
    return _month_pair(counts, as_of, **CODE_REPORT)


def category_month_over_month(totals: DataFrame, as_of: dt.date) -> DataFrame:
    return _month_pair(named_categories(totals), as_of, **CATEGORY_REPORT)


def backfill_codes(counts: DataFrame, months: Sequence[int] = BACKFILL_MONTHS) -> DataFrame:
    return _all_month_pairs(counts, months, **CODE_REPORT)


def backfill_categories(totals: DataFrame, months: Sequence[int] = BACKFILL_MONTHS) -> DataFrame:
    return _all_month_pairs(named_categories(totals), months, **CATEGORY_REPORT)


# --- report tables ---


def _upsert_report(
    target: DataFrame, report: DataFrame, as_of: dt.date, inserted_by: str, updated_by: str
) -> Upserted:
    return upsert(
        target,
        report,
        ["md5_str"],
        on_insert={"last_modified_by": F.lit(inserted_by), "last_modified_date": F.lit(as_of)},
        overwrite=[name for name in report.columns if name != "md5_str"] + ["last_modified_date"],
        on_match={"last_modified_by": F.lit(updated_by)},
    )


def upsert_code_analytics(target: DataFrame, report: DataFrame, as_of: dt.date) -> Upserted:
    return _upsert_report(target, report, as_of, "code report insert", "code report update")


def upsert_category_analytics(target: DataFrame, report: DataFrame, as_of: dt.date) -> Upserted:
    return _upsert_report(target, report, as_of, "category report insert", "category report update")


def fill_descriptions(analytics: DataFrame, categories: DataFrame) -> DataFrame:
    """Set missing descriptions by category.

    A category has one row per month pair in the report table, so no category
    can outgrow a task.
    """
    known = categories.groupBy("sic_code_category").agg(
        F.min("Category_Description").alias("__description")
    )
    return (
        analytics.join(known, "sic_code_category", "left")
        .withColumn("category_description", F.coalesce("category_description", "__description"))
        .select(*analytics.columns)
    )
