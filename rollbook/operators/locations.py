"""Addresses: postcode repair, counties, keys, the location table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions import columns as c
from rollbook.operators.merge import Upserted, has_key, latest_per_key, upsert
from rollbook.operators.skew import descending_rank, lookup, number_by_hash

HEAD_OFFICE = "HEAD_OFFICE"
HOME_COUNTRY = "UK"
#: What a location table of keys and types alone does without.
ADDRESS_COLUMNS = ["address_1", "address_2", "town", "county", "area_location", "post_code_formatted"]
ADDRESS_PARTS = [
    "reg_address_line1", "reg_address_line2", "reg_address_posttown", "reg_address_county",
]


# --- repairs on the register ---


def repair_postcodes(
    register: DataFrame,
    pattern: str = c.POSTCODE_PATTERN,
    ignore_case: bool = True,
    skip_nulls: bool = False,
) -> DataFrame:
    """Fill a missing postcode with one found in the rest of the address."""
    found = c.find_postcode(
        *[F.col(part) for part in ADDRESS_PARTS],
        pattern=pattern,
        ignore_case=ignore_case,
        skip_nulls=skip_nulls,
    )
    return register.withColumn(
        "reg_address_postcode", F.coalesce("reg_address_postcode", found)
    )


def county_by_postcode(mapping: DataFrame) -> DataFrame:
    """(post_key, new_county), one row per postcode: the first county by name."""
    return (
        mapping.filter(F.col("County").isNotNull() & F.col("Postcode").isNotNull())
        .groupBy(c.without_blanks(F.col("Postcode")).alias("post_key"))
        .agg(F.min("County").alias("new_county"))
    )


def lacks_county() -> Column:
    """The county is missing and there is a postcode to look it up by."""
    return F.col("reg_address_county").isNull() & (F.col("reg_address_postcode") != "")


def _with_new_county(register: DataFrame, mapping: DataFrame) -> DataFrame:
    """The register with ``new_county`` where a county is missing and known."""
    postcode = c.without_blanks(F.col("reg_address_postcode"))
    keyed = register.withColumn("post_key", F.when(lacks_county(), postcode))
    return lookup(keyed, "post_key", county_by_postcode(mapping), "new_county")


def county_candidates(register: DataFrame, mapping: DataFrame) -> DataFrame:
    """(organisation_id, new_county) of the organisations whose county can be filled."""
    lacking = register.filter(lacks_county()).select(
        "organisation_id", "reg_address_county", "reg_address_postcode"
    )
    return (
        _with_new_county(lacking, mapping)
        .filter(F.col("new_county").isNotNull())
        .groupBy("organisation_id")
        .agg(F.min("new_county").alias("new_county"))
    )


def fill_counties(register: DataFrame, mapping: DataFrame) -> DataFrame:
    """Fill a missing county by postcode.

    Only the rows that lack one are looked up; the rest is not shuffled.
    """
    county = F.coalesce("reg_address_county", "new_county")
    return (
        _with_new_county(register, mapping)
        .withColumn("reg_address_county", county)
        .select(*register.columns)
    )


def add_geo_keys(register: DataFrame) -> DataFrame:
    """Blank instead of a missing postcode, then the content key where there is none."""
    if "md5_key" not in register.columns:
        register = register.withColumn("md5_key", F.lit(None).cast("string"))
    keyed = register.withColumn(
        "reg_address_postcode", c.blank_if_null(F.col("reg_address_postcode"))
    )
    key = c.content_key(F.col("organisation_id"), F.col("reg_address_postcode"))
    return keyed.withColumn("md5_key", F.coalesce("md5_key", key))


# --- the location table ---


def geo_rows(register: DataFrame, as_of: dt.date) -> DataFrame:
    """The register as head offices, shaped like the location table without ``id``."""
    postcode = F.col("reg_address_postcode")
    return register.select(
        F.col("reg_address_line1").alias("address_1"),
        F.col("reg_address_line2").alias("address_2"),
        F.col("reg_address_posttown").alias("town"),
        F.col("reg_address_county").alias("county"),
        postcode.alias("post_code"),
        F.col("reg_address_county").alias("area_location"),
        F.lit(HOME_COUNTRY).alias("country"),
        F.lit(HEAD_OFFICE).alias("address_type"),
        c.normal_postcode(postcode).alias("post_code_formatted"),
        c.organisation_id(F.col("company_number")).alias("organisation_id"),
        c.content_key(F.col("organisation_id"), postcode).alias("md5_key"),
        F.lit(as_of).alias("date_last_modified"),
        F.lit("location insert").alias("last_modified_by"),
    )


def with_parent(rows: DataFrame, organisations: DataFrame) -> DataFrame:
    """Location rows whose organisation exists.

    The rows come from the register, one per organisation, so the join has no
    hot key on this side, and the organisation table is unique by ``id``.
    """
    parents = organisations.select(F.col("id").alias("organisation_id"))
    return rows.join(parents, "organisation_id", "left_semi").select(*rows.columns)


def without_parent(rows: DataFrame, organisations: DataFrame) -> DataFrame:
    """The others. Rows without any organisation are set aside before the join."""
    parents = organisations.select(F.col("id").alias("organisation_id"))
    missing = F.col("organisation_id").isNull()
    orphans = rows.filter(~missing).join(parents, "organisation_id", "left_anti")
    return orphans.select(*rows.columns).unionByName(rows.filter(missing))


def upsert_locations(
    target: DataFrame, rows: DataFrame, as_of: dt.date, unique: bool = False
) -> Upserted:
    """Insert new addresses under new ids; a known address becomes head office again.

    A target may lack the address columns; any other difference is an error.
    Ids continue after the highest one. Every row of the batch draws a number,
    so known addresses leave gaps, as they do in an auto-increment column.
    """
    merged = merge_locations(target, numbered_locations(target, rows, unique), as_of)
    return Upserted(merged, rows.filter(~has_key(["md5_key"])))


def numbered_locations(target: DataFrame, rows: DataFrame, unique: bool = False) -> DataFrame:
    """The batch with an ``id`` for each row, as ``merge_locations`` takes it; rows without a key are left out."""
    # The key is NULL where one of these is. They are the cheaper filter, as one
    # on the key would compute the hash a second time at the scan.
    keyed = rows.filter(has_key(["organisation_id", "post_code"]))
    if not unique:
        keyed = latest_per_key(keyed, ["md5_key"])
    last_id = target.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    return number_by_hash(keyed, "md5_key", last_id, "id")


def merge_locations(target: DataFrame, numbered: DataFrame, as_of: dt.date) -> DataFrame:
    return upsert(
        target,
        numbered,
        ["md5_key"],
        on_match={
            "address_type": F.lit(HEAD_OFFICE),
            "date_last_modified": F.lit(as_of),
            "last_modified_by": F.lit("location update"),
        },
        unique=True,
        ignore=ADDRESS_COLUMNS,
    ).next


def is_home_head_office() -> Column:
    return F.coalesce(
        (F.col("address_type") == HEAD_OFFICE) & (F.col("country") == HOME_COUNTRY), F.lit(False)
    )


def head_office_rank(locations: DataFrame) -> DataFrame:
    """(id, organisation_id, id_rank) of the home head offices, newest id first."""
    offices = locations.filter(is_home_head_office()).select("id", "organisation_id")
    return descending_rank(offices, "organisation_id", "id", "id_rank")


def keep_latest_head_office(locations: DataFrame) -> DataFrame:
    """Drop every home head office but the one with the highest id per organisation.

    Other rows form groups by their id, apart from the offices, so one window serves
    the whole table and all of them have rank 1, also those without an id. Spark cuts
    each task's groups to rank 1 before the shuffle; the size of a group of offices
    does not matter.
    """
    office = is_home_head_office()
    newest = Window.partitionBy(
        office, F.when(office, F.col("organisation_id")), F.when(~office, F.col("id"))
    ).orderBy(F.desc("id"))
    return (
        locations.withColumn("__rank", F.rank().over(newest))
        .filter(F.col("__rank") == 1)
        .drop("__rank")
    )


# --- the newest head offices as a table of their own ---


def newest_offices(locations: DataFrame) -> DataFrame:
    """(organisation_id, id): the home head office with the highest id of each organisation."""
    offices = locations.filter(is_home_head_office() & F.col("organisation_id").isNotNull())
    return offices.groupBy("organisation_id").agg(F.max("id").alias("id"))


def batch_offices(target: DataFrame, numbered: DataFrame) -> DataFrame:
    """(organisation_id, id): the home head offices that a batch makes or makes again, by three columns of the table."""
    known = target.select("md5_key", F.col("id").alias("known_id"), F.col("country").alias("known_country"))
    met = numbered.select("md5_key", "organisation_id", "id", "country").join(known, "md5_key", "left")
    country = F.when(F.col("known_id").isNull(), F.col("country")).otherwise(F.col("known_country"))
    return met.filter(country == HOME_COUNTRY).select("organisation_id", F.coalesce("known_id", "id").alias("id"))


def supersede(newest: DataFrame, offices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The newest offices after a batch, and the ids that are not the newest any more.

    ``newest`` holds an organisation once. Only organisations of the batch can lose an
    office, so that is all that is compared; nothing of the location table is sorted.
    """
    touched = offices.select("organisation_id").distinct()
    candidates = newest.join(touched, "organisation_id", "left_semi").unionByName(offices)
    latest = candidates.groupBy("organisation_id").agg(F.max("id").alias("id"))
    gone = candidates.join(latest.withColumnRenamed("id", "latest"), "organisation_id").filter("id < latest").select("id")
    return newest.join(touched, "organisation_id", "left_anti").unionByName(latest), gone


def drop_superseded(locations: DataFrame, gone: DataFrame) -> DataFrame:
    """The location table without the offices that a batch replaced, as many as the batch has rows at most."""
    return locations.join(gone, "id", "left_anti").select(*locations.columns)
