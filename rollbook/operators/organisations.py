"""The organisation table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions import columns as c
from rollbook.operators.merge import Upserted, upsert


def organisation_rows(register: DataFrame) -> DataFrame:
    return register.select(
        F.col("organisation_id").alias("id"),
        "company_number",
        "company_name",
        "company_status",
        c.register_date(F.col("IncorporationDate")).alias("date_formed"),
    )


def upsert_organisation(
    target: DataFrame, register: DataFrame, as_of: dt.date, unique: bool = False
) -> Upserted:
    """New companies are inserted; known ones only get the audit columns."""
    return upsert(
        target,
        organisation_rows(register),
        ["id"],
        on_insert={
            "last_modified_date": F.lit(as_of),
            "last_modified_by": F.lit("organisation insert"),
        },
        overwrite=["last_modified_date"],
        on_match={"last_modified_by": F.lit("organisation update")},
        unique=unique,
    )
