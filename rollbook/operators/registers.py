"""The register snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.functions import columns as c
from rollbook.operators.merge import Upserted, upsert
from rollbook.sources.schema import REGISTER_NAMES, UNFILLED_COLUMNS

KEY = "company_number"
AUDIT_COLUMNS = ["last_modified_date", "last_modified_by"]

REGISTER_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in [*REGISTER_NAMES, *UNFILLED_COLUMNS, "organisation_id", "md5_key"]
    ]
    + [
        T.StructField("last_modified_date", T.TimestampType()),
        T.StructField("last_modified_by", T.StringType()),
    ]
)


def empty_register(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REGISTER_SCHEMA)


def upsert_register(
    target: DataFrame,
    batch: DataFrame,
    as_of: dt.datetime | dt.date,
    source: str | Column = "",
    order: tuple[str, ...] = (),
    unique: bool = False,
) -> Upserted:
    """Insert new companies, overwrite known ones with all that the batch says.

    On a match every column but the key and the identity is overwritten, with
    NULL where the batch has no value or no such column. That clears ``md5_key``
    until the location job builds it again.
    """
    source = F.lit(source) if isinstance(source, str) else source
    kept = {KEY, "organisation_id", *AUDIT_COLUMNS}
    return upsert(
        target,
        batch,
        [KEY],
        on_insert={
            "organisation_id": c.organisation_id(F.col(KEY)),
            "last_modified_date": F.lit(as_of),
            "last_modified_by": F.concat(F.lit("register insert "), source),
        },
        overwrite=[name for name in target.columns if name not in kept] + ["last_modified_date"],
        on_match={"last_modified_by": F.concat(F.lit("register update "), source)},
        order=order,
        unique=unique,
    )


def touched_on(table: DataFrame, day: dt.date, column: str = "last_modified_date") -> DataFrame:
    """Number of rows whose ``column`` falls on ``day``."""
    return table.filter(c.on_day(F.col(column), day)).agg(F.count("*").alias("touched"))
