"""The file stream into the register, and the versioned tables beneath it."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from rollbook.operators import codes, registers
from rollbook.sources.snapshots import Parts, Snapshots, hash_parts
from rollbook.streaming import ingest
from tests.test_files import write_file

AS_OF = dt.datetime(2001, 7, 15, 12)


def company(number, name, **rest):
    return {"company_number": number, "company_name": name, **rest}


def arrive(folder, name, records, minute):
    """A file with a given time, as the newest file of a batch wins."""
    write_file(folder / name, records)
    moment = 1_000_000_000 + 60 * minute
    os.utime(folder / name, (moment, moment))


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    arrive(path, "part_1.csv", [company("01", "A"), company("02", "B", URI="u"), company("", "NO KEY")], 1)
    arrive(path, "part_2.csv", [company("02", "B2"), company("03", "C\nC")], 2)
    arrive(path, "part_3.csv", [company("03", "C3"), company("04", "D"), company("04", "D")], 3)
    return path


def run(spark, tmp_path, folder, label, store=None, **options):
    store = store or Snapshots(spark, str(tmp_path / label / "tables"))
    register = ingest.ingest_fragments(
        spark, str(folder), store, str(tmp_path / label / "checkpoint"), AS_OF, "r", **options
    )
    return store, register


def names(register):
    return {row.company_number: row.company_name for row in register.collect()}


FINAL = {"01": "A", "02": "B2", "03": "C3", "04": "D"}


def test_files_one_by_one_or_at_once(spark, tmp_path, folder):
    store, register = run(spark, tmp_path, folder, "one", files_per_batch=1)
    assert names(register) == FINAL
    assert store.version("register") == 2
    whole_store, whole = run(spark, tmp_path, folder, "all")
    assert names(whole) == FINAL
    assert whole_store.version("register") == 0
    same = ["company_number", "company_name", "URI", "organisation_id"]
    assert whole.select(same).exceptAll(register.select(same)).isEmpty()
    audit = {row.company_number: row.last_modified_by for row in register.collect()}
    assert audit["01"] == "register insert part_1.csv"
    assert audit["02"] == "register update part_2.csv"
    assert [row.company_name for row in store.read("register_rejects").collect()] == ["NO KEY"]


def test_malformed_records_are_rejects(spark, tmp_path, folder):
    run(spark, tmp_path, folder, "malformed")
    arrive(folder, "part_4.csv", [company("01", "LONG"), company("02", "SHORT"), company("09", "GOOD")], 4)
    header, long, short, good = (folder / "part_4.csv").read_text().splitlines()
    (folder / "part_4.csv").write_text("\n".join([header, long + ',"more"', short.rsplit(",", 3)[0], good]) + "\n")
    store, register = run(spark, tmp_path, folder, "malformed")
    assert names(register) == FINAL | {"09": "GOOD"}
    rejects = store.read("register_rejects").collect()
    assert {row.file_name for row in rejects} == {"part_4.csv"}
    assert {name for name in ("LONG", "SHORT") if any(name in row.malformed for row in rejects)} == {"LONG", "SHORT"}


def test_new_checkpoint_under_a_used_run_name(spark, tmp_path, folder):
    store, _ = run(spark, tmp_path, folder, "first")
    other = tmp_path / "other"
    other.mkdir()
    arrive(other, "part_1.csv", [company("77", "NEW")], 5)
    _, register = run(spark, tmp_path, other, "second", store)
    assert names(register) == FINAL | {"77": "NEW"}


@pytest.mark.parametrize("multi_line", [True, False])
def test_last_record_of_a_file_wins(spark, tmp_path, multi_line):
    folder = tmp_path / "in"
    folder.mkdir()
    arrive(folder, "part_1.csv", [company("01", "ZZ first"), *[company(str(n), "x") for n in range(2, 9)], company("01", "AA last")], 1)
    _, register = run(spark, tmp_path, folder, "last", multi_line=multi_line)
    assert names(register)["01"] == "AA last"


def test_bucketed_register(spark, tmp_path, folder):
    spark.sql("create database if not exists ingest_test")
    spark.catalog.setCurrentDatabase("ingest_test")
    try:
        root = tmp_path / "bucketed" / "tables"
        store = Snapshots(spark, str(root), buckets={"register": (8, "company_number")})
        _, register = run(spark, tmp_path, folder, "bucketed", store, files_per_batch=1)
        assert names(register) == FINAL
        assert store.bucketed("register")
        for version in range(3):
            assert len(list((root / "register" / f"version={version:08d}").glob("*.parquet"))) <= 8
        unbucketed = Snapshots(spark, str(root))
        assert names(unbucketed.read("register")) == FINAL
    finally:
        spark.catalog.setCurrentDatabase("default")
        spark.sql("drop database ingest_test cascade")


def test_only_new_files_are_read(spark, tmp_path, folder):
    store, _ = run(spark, tmp_path, folder, "again")
    _, same = run(spark, tmp_path, folder, "again", store)
    assert store.version("register") == 0
    arrive(folder, "part_4.csv", [company("01", "A4")], 4)
    _, register = run(spark, tmp_path, folder, "again", store)
    assert store.version("register") == 1
    assert names(register) == FINAL | {"01": "A4"}


def test_handled_files_can_be_moved_away(spark, tmp_path, folder):
    archive = tmp_path / "archive"
    run(spark, tmp_path, folder, "clean", files_per_batch=1, clean_source="archive", archive=str(archive))
    arrive(folder, "part_4.csv", [company("05", "E")], 4)
    run(spark, tmp_path, folder, "clean", clean_source="archive", archive=str(archive))
    moved = {path.name for path in archive.rglob("*.csv")}
    assert "part_1.csv" in moved
    assert not (folder / "part_1.csv").exists()


def test_replayed_batch_changes_nothing(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    store.write("t", spark.range(3), "r/0")
    again = store.write("t", spark.range(99), "r/0")
    assert again.count() == 3
    assert store.version("t") == 0
    fresh = Snapshots(spark, str(tmp_path))
    assert fresh.finished("t", "r/0") and fresh.version("t") == 0
    assert fresh.write("t", fresh.read("t").union(spark.range(1)), "r/1").count() == 4


def test_unlogged_folder_is_not_read(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    spark.range(5).write.parquet(str(tmp_path / "t" / "version=00000000"))
    with pytest.raises(LookupError):
        store.read("t")
    assert store.write("t", spark.range(2), "r").count() == 2


def test_update_clears_what_the_file_lacks(spark):
    old = registers.upsert_register(
        registers.empty_register(spark),
        spark.createDataFrame([("01", "A", "key", "123")], "company_number string, company_name string, md5_key string, phone_number string"),
        AS_OF,
    ).next
    assert old.first().md5_key == "key"
    new = registers.upsert_register(
        old, spark.createDataFrame([("01", None)], "company_number string, company_name string"), AS_OF, "x"
    ).next.first()
    assert (new.company_name, new.md5_key, new.phone_number) == (None, None, None)
    assert new.organisation_id == "UK01"
    assert new.last_modified_by == "register update x"


def test_bucketed_register_is_not_shuffled(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "b"), buckets={"bucketed_register": (8, "company_number")})
    rows = spark.range(1000).select(
        F.lpad(F.col("id").cast("string"), 8, "0").alias("company_number"),
        F.lit("x").alias("company_name"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        empty = registers.empty_register(spark)
        target = store.write("bucketed_register", registers.upsert_register(empty, rows, AS_OF).next, "1")
        merged = registers.upsert_register(target, rows.withColumn("company_name", F.lit("y")), AS_OF).next
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        after = store.write("bucketed_register", merged, "2", clustered=True)
        for version in (0, 1):
            files = list((tmp_path / "b" / "bucketed_register" / f"version={version:08d}").glob("*.parquet"))
            assert len(files) <= 8
        assert after.filter("company_name = 'y'").count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for version in (0, 1):
            spark.sql(f"drop table if exists bucketed_register_{version:08d}")


def test_batch_touches_its_parts_only(spark, tmp_path):
    root = tmp_path / "parts"
    store = Snapshots(spark, str(root), parts={"register": hash_parts("company_number", 32)})
    rows = spark.range(6400).select(F.lpad(F.col("id").cast("string"), 8, "0").alias("company_number"), F.sha2(F.col("id").cast("string"), 256).alias("company_name"))
    whole = registers.upsert_register(registers.empty_register(spark), rows, AS_OF).next
    store.write("register", whole, "all")
    folder = tmp_path / "in"
    folder.mkdir()
    arrive(folder, "part_1.csv", [company("00000007", "CHANGED"), company("NEW", "N")], 1)
    register = ingest.ingest_fragments(spark, str(folder), store, str(tmp_path / "c"), AS_OF, "r")
    assert register.count() == 6401
    found = names(register.filter("company_number in ('00000007', 'NEW', '00000008')"))
    assert found["00000007"] == "CHANGED" and found["NEW"] == "N" and found["00000008"] not in ("CHANGED", "N")

    def size(version):
        return sum(path.stat().st_size for path in (root / "register" / f"version={version:08d}").rglob("*.parquet"))

    parts = list((root / "register" / "version=00000001").glob("part=*"))
    assert len(parts) == 2 and size(1) < size(0) / 5
    # Only the parts that a batch touches are read for it.
    target = store.read("register", parts=["p3"])
    read = {row.path for row in target.select(F.regexp_extract("_metadata.file_path", "part=([^/]+)/", 1).alias("path")).distinct().collect()}
    assert read == {"p3"}
    assert Snapshots(spark, str(root), parts=store.parts).read("register").exceptAll(register).isEmpty()
    assert store.read("register", version=0).exceptAll(whole.select(*whole.columns)).isEmpty()


def test_parts_may_become_empty(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path), parts={"t": Parts("month")})
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, month string")
    store.write("t", rows, "1")
    after = store.write("t", rows.limit(0), "2", parts=["a"])
    assert sorted((row.n, row.month) for row in after.collect()) == [(2, "b"), (3, None)]
    assert store.write("t", rows.filter("n = 1"), "3").collect() == [(1, "a")]
    assert store.read("t", version=1).count() == 2
    empty = Snapshots(spark, str(tmp_path / "e"), parts={"t": Parts("month")})
    assert empty.write("t", rows.limit(0), "1").count() == 0
    with pytest.raises(ValueError):
        Snapshots(spark, str(tmp_path / "x")).write("t", rows, "1", parts=["a"])


def test_counts_of_fragments_in_any_order_and_twice(spark, tmp_path):
    """One of the fragments comes a second time, with other records."""
    texts = [("10 - A", "Active"), ("10 - A", "Active"), ("20 - B", "Liquidation"), ("30 - C", "Active")]
    records = [company(str(i), "c", sic_text_1=text, company_status=status) for i, (text, status) in enumerate(texts * 3)]
    final = None
    for label, order in {"ab": [(1, 0, 6), (2, 6, 12)], "ba": [(2, 6, 12), (1, 0, 6)], "twice": [(1, 2, 9), (2, 6, 12), (1, 0, 6)], "gone": [(1, 0, 6), (2, 6, 12), (3, 0, 4), (3, 2, 3)]}.items():
        folder = tmp_path / label
        folder.mkdir()
        store = Snapshots(spark, str(tmp_path / label / "tables"), parts={"fragment_counts": hash_parts("file_name", 4)} if label == "twice" else None)
        for minute, (number, start, stop) in enumerate(order):
            # A file that comes again has its name in a folder of its own.
            (folder / f"in{minute}").mkdir()
            arrive(folder / f"in{minute}", f"part_{number}.csv", records[start:stop], minute)
            ingest.ingest_fragments(spark, str(folder / f"in{minute}"), store, str(folder / f"c{minute}"), AS_OF, "r", count_codes=True)
        counts = codes.month_from_fragments(store.read("fragment_counts"), "r", F.lit(AS_OF.date()))
        found = {row.sic_code: row.counts for row in counts.collect()}
        final = final or found
        assert found == final == {"10": 6, "30": 3}


def test_landing_of_the_batch_before_stays(spark, tmp_path, folder, monkeypatch):
    store, _ = run(spark, tmp_path, folder, "landing")
    landed = {path for path in (tmp_path / "landing" / "tables" / "_landing").rglob("*.parquet")}
    arrive(folder, "part_4.csv", [company("05", "E")], 4)
    monkeypatch.setattr(ingest, "upsert_register", lambda *a, **b: 1 / 0)
    with pytest.raises(Exception):
        run(spark, tmp_path, folder, "landing", store)
    assert all(path.exists() for path in landed)
    monkeypatch.undo()
    _, register = run(spark, tmp_path, folder, "landing", Snapshots(spark, store.root))
    assert names(register) == FINAL | {"05": "E"}
