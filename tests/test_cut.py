"""One large file read in splits, against the reader that takes it in one task."""

from __future__ import annotations

import random

import pytest

from rollbook.sources import cut
from rollbook.sources import register as files
from rollbook.sources.schema import REGISTER_NAMES
from tests.test_files import write_file


@pytest.fixture
def splits(spark):
    """Splits of a few hundred bytes, so that many edges fall into values and quotes."""
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def records(count: int, seed: int) -> list[dict[str, str]]:
    rng = random.Random(seed)
    parts = ["A", "\n", '"', '""', ",", "\n\n", " ", "é", "x" * 50, '"\n"', "\r\n"]
    return [
        {
            "company_number": f"{n:08d}",
            "company_name": "N" + "".join(rng.choices(parts, k=rng.randint(0, 9))) + "N",
            "reg_address_line1": "".join(rng.choices(parts[:6], k=rng.randint(0, 4))) + "L",
            "URI": "u",
        }
        for n in range(count)
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_the_whole_scan(spark, tmp_path, splits, seed):
    write_file(tmp_path / "raw.csv", records(120, seed))
    tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    assert tasks > 20
    found = cut.scan_raw_register(spark, str(tmp_path / "raw.csv"))
    expected = files.scan_register(spark, str(tmp_path / "raw.csv"))
    assert found.columns == REGISTER_NAMES
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_records_keep_their_number(spark, tmp_path, splits):
    rows = records(60, 4)
    write_file(tmp_path / "raw.csv", rows)
    found = cut.cut_records(spark, str(tmp_path / "raw.csv")).orderBy("record").collect()
    assert [row.record for row in found] == list(range(1, 62))
    assert [f'"{row["company_number"]}"' in text.text for row, text in zip(rows, found[1:], strict=True)] == [True] * 60


def test_one_value_over_many_splits(spark, tmp_path, splits):
    rows = records(5, 5) + [{"company_number": "LONG", "company_name": "line\n" * 2000}] + records(5, 6)
    write_file(tmp_path / "raw.csv", rows)
    found = {row.company_number: row.company_name for row in cut.scan_raw_register(spark, str(tmp_path)).collect()}
    assert found["LONG"] == "line\n" * 2000 and len(found) == 6


def test_fragments_of_a_raw_file(spark, tmp_path, splits):
    write_file(tmp_path / "raw.csv", records(90, 7))
    cut.cut_into_fragments(spark, str(tmp_path / "raw.csv"), str(tmp_path / "out"), 10)
    counts = files.file_row_counts(spark, str(tmp_path / "out")).collect()
    assert max(row.row_count for row in counts) <= 10 and sum(row.row_count for row in counts) == 90
    again = files.scan_register(spark, str(tmp_path / "out"))
    assert sorted(map(str, again.collect())) == sorted(map(str, files.scan_register(spark, str(tmp_path / "raw.csv")).collect()))


def test_windows_line_ends_blank_lines_and_two_files(spark, tmp_path):
    write_file(tmp_path / "a.csv", records(3, 8))
    plain = [{"company_number": "P1", "company_name": "P"}, {"company_number": "P2", "company_name": "Q"}]
    write_file(tmp_path / "b.csv", plain)
    (tmp_path / "b.csv").write_bytes((tmp_path / "b.csv").read_bytes().replace(b"\n", b"\r\n") + b"\r\n\r\n")
    found = {row.company_number: row.company_name for row in cut.scan_raw_register(spark, str(tmp_path)).collect()}
    assert len(found) == 5 and found["P2"] == "Q"


@pytest.mark.parametrize("wrong", ["header", "record"])
def test_wrong_files_fail(spark, tmp_path, wrong):
    write_file(tmp_path / "raw.csv", records(3, 9))
    lines = (tmp_path / "raw.csv").read_text()
    changed = lines.replace("CompanyName", "Name", 1) if wrong == "header" else lines + '"too","few"\n'
    (tmp_path / "raw.csv").write_text(changed)
    with pytest.raises(Exception, match="another header|MALFORMED"):
        cut.scan_raw_register(spark, str(tmp_path)).collect()
