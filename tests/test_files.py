"""Register files: reading, cutting, counting, landing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rollbook.session import scratch_folder
from rollbook.sources import register as files
from rollbook.sources.schema import CODE_TEXTS, FILE_HEADER, REGISTER_NAMES


def write_file(path, records, header=FILE_HEADER):
    """A file as published: every value quoted, quotes doubled."""

    def line(cells):
        return ",".join('"' + cell.replace('"', '""') + '"' for cell in cells)

    body = [
        line([record.get(name, "") for name in REGISTER_NAMES]) for record in records
    ]
    path.write_text("\n".join([",".join(header), *body]) + "\n")


PLAIN = [
    {"company_name": "ONE, TWO & CO", "company_number": "00012345", "sic_text_1": "62020 - IT"},
    {"company_name": 'THE "BEST" LTD', "company_number": "SC000001", "company_status": "Active"},
]
SPANNING = [
    {"company_name": "TWO\nLINES", "company_number": "00000007", "reg_address_line1": " padded "},
    *PLAIN,
]


def test_values_survive(spark, tmp_path):
    write_file(tmp_path / "a.csv", SPANNING)
    found = {row.company_number: row for row in files.scan_register(spark, str(tmp_path)).collect()}
    assert found["00000007"].company_name == "TWO\nLINES"
    assert found["00000007"].reg_address_line1 == " padded "
    assert found["00012345"].company_name == "ONE, TWO & CO"
    assert found["SC000001"].company_name == 'THE "BEST" LTD'
    assert found["SC000001"].sic_text_1 is None
    assert len(found) == 3


def test_plain_lines_are_read_in_splits(spark, tmp_path):
    write_file(tmp_path / "a.csv", PLAIN * 500)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        scan = files.scan_register(spark, str(tmp_path), multi_line=False)
        assert scan.rdd.getNumPartitions() > 1
        assert scan.count() == 1000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("change", [lambda line: line + ',"more"', lambda line: line.rsplit(",", 1)[0]])
def test_malformed_record_fails_a_full_scan(spark, tmp_path, change):
    write_file(tmp_path / "a.csv", PLAIN)
    lines = (tmp_path / "a.csv").read_text().splitlines()
    (tmp_path / "a.csv").write_text("\n".join([*lines[:-1], change(lines[-1])]) + "\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        files.scan_register(spark, str(tmp_path)).collect()


def test_other_columns_are_refused(spark, tmp_path):
    header = ["Wrong"] + FILE_HEADER[1:]
    write_file(tmp_path / "a.csv", PLAIN, header)
    with pytest.raises(Exception, match="header|Header"):
        files.scan_register(spark, str(tmp_path)).collect()


def test_code_columns(spark, tmp_path):
    write_file(tmp_path / "a.csv", SPANNING)
    scan = files.scan_code_columns(spark, str(tmp_path))
    assert scan.columns == [*CODE_TEXTS, "company_status"]
    assert scan.filter("sic_text_1 = '62020 - IT'").count() == 1
    assert scan.filter("company_status = 'Active'").count() == 1


@pytest.mark.parametrize("multi_line", [True, False])
def test_file_header_has_its_blanks(spark, tmp_path, multi_line):
    out = str(tmp_path / "out")
    register = spark.createDataFrame([(" a ", "00000001"), (None, "")], "company_name string, company_number string")
    files.export_fragments(register.coalesce(1), out, 10)
    part = next((tmp_path / "out").glob("*.csv"))
    first = part.read_text().splitlines()[0]
    assert first == ",".join(f'"{name}"' for name in FILE_HEADER)
    back = files.scan_register(spark, out, multi_line).select("company_name", "company_number")
    assert {tuple(row) for row in back.collect()} == {(" a ", "00000001"), (None, None)}


def test_fragments_hold_whole_records(spark, tmp_path):
    write_file(tmp_path / "a.csv", SPANNING * 10)
    out = str(tmp_path / "out")
    files.export_fragments(files.scan_register(spark, str(tmp_path / "a.csv")), out, 7)
    counts = files.file_row_counts(spark, out)
    assert counts.agg(F.max("row_count")).first()[0] <= 7
    assert counts.count() >= 5
    assert files.total_row_count(counts).first().file_rowcount == 30
    names = files.scan_register(spark, out).filter("company_name like 'TWO%'")
    assert names.count() == 10


def test_landing_holds_the_last_batch(spark, tmp_path):
    path = str(tmp_path / "landing")
    files.land(spark.range(10), path)
    assert files.land(spark.range(3), path).count() == 3
    assert files.land(spark.range(0), path).count() == 0


class Session:
    """As much of a session as the scratch folder asks for."""

    def __init__(self, master, settings):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(settings.get)})


def test_scratch_lies_in_the_shared_folder():
    shared = Session("yarn", {"spark.checkpoint.dir": "hdfs://shared/tmp/"})
    assert scratch_folder(shared, "x").startswith("hdfs://shared/tmp/rollbook-x-")
    assert scratch_folder(shared, "x") != scratch_folder(shared, "x")
    with pytest.raises(ValueError):
        scratch_folder(Session("yarn", {}), "x")
    assert "rollbook-x-" in scratch_folder(Session("local[8]", {}), "x")
