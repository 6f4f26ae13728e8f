"""Addresses and head offices on small tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollbook.operators import locations
from rollbook.plans import jobs

AS_OF = dt.date(2001, 7, 15)
REGISTER = (
    "company_number string, organisation_id string, reg_address_line1 string, reg_address_line2 string, "
    "reg_address_posttown string, reg_address_county string, reg_address_postcode string"
)
GEO = (
    "id bigint, organisation_id string, post_code string, md5_key string, address_type string, "
    "country string, date_last_modified date, last_modified_by string"
)


def register_of(spark, *records):
    return spark.createDataFrame([(n, "UK" + n, *rest) for n, *rest in records], REGISTER)


def geo_of(spark, *records):
    frame = spark.createDataFrame(
        [(i, o, p, None, t, country, dt.date(2001, 6, 1), "seed") for i, o, p, t, country in records], GEO
    )
    return frame.withColumn("md5_key", F.md5(F.concat("organisation_id", "post_code")))


@pytest.fixture
def mapping(spark):
    return spark.createDataFrame(
        [("B2 3AA", "Kent"), ("B23AA", "Essex"), ("C1 1AA", None), ("D11 AA", "Devon"), (None, "Nowhere")],
        "Postcode string, County string",
    )


def test_repair_keeps_what_is_there(spark):
    register = register_of(
        spark,
        ("1", "l", "B2 3AA", "t", "c", "Z9 9ZZ"),
        ("2", "l", "B2 3AA", "t", "c", None),
        ("3", "l", "nothing", "t", "c", None),
        ("4", "l", "B2 3AA", "t", "c", ""),
    )
    repaired = locations.repair_postcodes(register).orderBy("company_number").collect()
    assert [row.reg_address_postcode for row in repaired] == ["Z9 9ZZ", "B2 3AA", None, ""]


def test_counties(spark, mapping):
    register = register_of(
        spark,
        ("1", "l", "l", "t", None, "B2 3AA"),
        ("2", "l", "l", "t", "Own", "B2 3AA"),
        ("3", "l", "l", "t", None, "C1 1AA"),
        ("4", "l", "l", "t", None, ""),
        ("5", "l", "l", "t", None, None),
        ("6", "l", "l", "t", None, "D1 1AA"),
    )
    filled = locations.fill_counties(register, mapping).orderBy("company_number").collect()
    assert [row.reg_address_county for row in filled] == ["Essex", "Own", None, None, None, "Devon"]
    candidates = locations.county_candidates(register, mapping)
    assert {tuple(row) for row in candidates.collect()} == {("UK1", "Essex"), ("UK6", "Devon")}


def test_keys_are_built_where_there_is_none(spark):
    register = register_of(spark, ("1", "l", "l", "t", "c", None)).withColumn("md5_key", F.lit(None).cast("string"))
    keyed = locations.add_geo_keys(register).first()
    assert keyed.reg_address_postcode == ""
    assert keyed.md5_key == locations.add_geo_keys(register.drop("md5_key")).first().md5_key
    kept = locations.add_geo_keys(register.withColumn("md5_key", F.lit("own"))).first()
    assert kept.md5_key == "own"


def test_blank_postcode_is_not_repaired_again(spark, mapping):
    register = register_of(spark, ("1", "l", "none", "t", "c", None))
    once = jobs.refresh_register_addresses(register, mapping)
    moved = once.withColumn("reg_address_line2", F.lit("B2 3AA"))
    assert jobs.refresh_register_addresses(moved, mapping).first().reg_address_postcode == ""


def test_upsert_numbers_new_rows_above_old_ones(spark):
    geo = geo_of(spark, (7, "UK1", "A1 1AA", "BRANCH", "UK"))
    register = register_of(
        spark, ("1", "l", "l", "t", "c", "A1 1AA"), ("2", "l", "l", "t", "c", "B1 1AA"), ("3", "l", "l", "t", "c", None)
    )
    merged = locations.upsert_locations(geo, locations.geo_rows(register, AS_OF), AS_OF)
    found = {row.organisation_id: row for row in merged.next.collect()}
    assert set(found) == {"UK1", "UK2"}
    assert (found["UK1"].id, found["UK1"].address_type, found["UK1"].last_modified_by) == (7, "HEAD_OFFICE", "location update")
    assert found["UK2"].id > 7
    assert merged.rejects.count() == 1


def test_first_locations_of_all(spark):
    register = register_of(spark, *[(str(n), "l", "l", "t", "c", "A1 1AA") for n in range(50)])
    empty = geo_of(spark, (1, "x", "y", "z", "UK")).limit(0)
    merged = locations.upsert_locations(empty, locations.geo_rows(register, AS_OF), AS_OF).next
    assert merged.select("id").distinct().count() == 50


def test_latest_head_office_only(spark):
    geo = geo_of(
        spark,
        (1, "UK1", "a", "HEAD_OFFICE", "UK"), (2, "UK1", "b", "HEAD_OFFICE", "UK"),
        (3, "UK1", "c", "BRANCH", "UK"), (4, "UK1", "d", "BRANCH", "UK"),
        (5, "UK1", "e", "HEAD_OFFICE", "IE"), (6, "UK1", "f", None, "UK"), (7, "UK1", "g", "HEAD_OFFICE", None),
        (8, "UK2", "h", "HEAD_OFFICE", "UK"),
    )
    kept = {row.id for row in locations.keep_latest_head_office(geo).collect()}
    assert kept == {2, 3, 4, 5, 6, 7, 8}
    ranks = {row.id: row.id_rank for row in locations.head_office_rank(geo).collect()}
    assert ranks == {1: 2, 2: 1, 8: 1}


def test_rows_without_id_stay_beside_offices_without_organisation(spark):
    geo = geo_of(
        spark,
        (None, "UK1", "a", "BRANCH", "UK"), (None, "UK2", "b", "BRANCH", "UK"),
        (3, None, "c", "HEAD_OFFICE", "UK"), (4, None, "d", "HEAD_OFFICE", "UK"),
    )
    kept = [(row.id, row.organisation_id) for row in locations.keep_latest_head_office(geo).collect()]
    assert sorted(kept, key=str) == sorted([(None, "UK1"), (None, "UK2"), (4, None)], key=str)


def test_old_address_that_returns_is_dropped(spark):
    """The highest id stays, though the file names the older address again."""
    geo = geo_of(spark, (1, "UK1", "A1 1AA", "HEAD_OFFICE", "UK"), (2, "UK1", "B1 1AA", "HEAD_OFFICE", "UK"))
    register = register_of(spark, ("1", "l", "l", "t", "c", "A1 1AA"))
    refreshed = jobs.refresh_locations(geo, register, AS_OF).next.collect()
    assert [row.id for row in refreshed] == [2]


def test_parents(spark):
    register = register_of(spark, ("1", "l", "l", "t", "c", "A1 1AA"), ("2", "l", "l", "t", "c", "A1 1AA"))
    rows = locations.geo_rows(register, AS_OF)
    rows = rows.unionByName(rows.limit(1).withColumn("organisation_id", F.lit(None).cast("string")))
    parents = spark.createDataFrame([("UK1",), (None,)], "id string")
    assert [row.organisation_id for row in locations.with_parent(rows, parents).collect()] == ["UK1"]
    orphans = {row.organisation_id for row in locations.without_parent(rows, parents).collect()}
    assert orphans == {"UK2", None}


def test_at_most_one_home_head_office(spark, mapping):
    register = register_of(spark, *[(str(n), "l", "B2 3AA", "t", None, None if n % 2 else "Z1 1ZZ") for n in range(40)])
    geo = geo_of(spark, *[(n, f"UK{n % 25}", f"P{n % 7}", "HEAD_OFFICE", "UK") for n in range(100)])
    geo = geo.dropDuplicates(["md5_key"])
    refreshed = jobs.refresh_locations(geo, jobs.refresh_register_addresses(register, mapping), AS_OF).next
    offices = refreshed.filter(locations.is_home_head_office()).groupBy("organisation_id").count()
    assert offices.agg(F.max("count")).first()[0] == 1
    assert offices.count() == 40


def test_newest_offices_as_kept_state(spark):
    """Batches that insert, that make an old address the office again, and one of a branch abroad."""
    columns = "id long, organisation_id string, post_code string, md5_key string, address_type string, country string, date_last_modified date, last_modified_by string"
    geo = spark.createDataFrame(
        [
            (1, "a", "P1", "a1", "HEAD_OFFICE", "UK", None, "s"),
            (2, "b", "P2", "b2", "HEAD_OFFICE", "UK", None, "s"),
            (3, "c", "P3", "c3", "BRANCH", "UK", None, "s"),
            (4, "c", "P4", "c4", "HEAD_OFFICE", "UK", None, "s"),
            (5, "d", "P5", "d5", "HEAD_OFFICE", "IE", None, "s"),
            (6, None, "P6", None, "HEAD_OFFICE", "UK", None, "s"),
        ],
        columns,
    )
    batch = spark.createDataFrame(
        [("a", "N", "00a9"), ("c", "P3", "c3"), ("d", "P5", "d5"), ("e", "N", "00e9")], "organisation_id string, post_code string, md5_key string"
    ).withColumns({"address_type": F.lit("HEAD_OFFICE"), "country": F.lit("UK"), "date_last_modified": F.lit(AS_OF), "last_modified_by": F.lit("x")})
    newest = locations.newest_offices(geo)
    numbered = locations.numbered_locations(geo, batch, unique=True)
    after, gone = locations.supersede(newest, locations.batch_offices(geo, numbered))
    kept = locations.drop_superseded(locations.merge_locations(geo, numbered, AS_OF), gone)
    expected = locations.keep_latest_head_office(locations.upsert_locations(geo, batch, AS_OF, unique=True).next)
    assert sorted(map(str, kept.collect())) == sorted(map(str, expected.collect()))
    assert {row.id for row in gone.collect()} == {1, 3}
    assert sorted(map(str, after.collect())) == sorted(map(str, locations.newest_offices(kept).collect()))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Window [rank" not in plan
