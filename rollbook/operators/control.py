"""The file tracker: which files are ready for the derived tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECTIONS = ["section1", "section2", "section3"]


def is_ready() -> Column:
    """Loaded into the register, not yet into the derived tables."""
    return F.col("section3").isNull() & F.col("section2").isNotNull()


def section_gate(tracker: DataFrame) -> DataFrame:
    return tracker.filter(is_ready())


def any_ready(tracker: DataFrame) -> bool:
    return not section_gate(tracker).isEmpty()


def mark_done(tracker: DataFrame, as_of: dt.date, among: DataFrame | None = None) -> DataFrame:
    """Date the files that passed the gate; the others stay as they are.

    With ``among``, a tracker read earlier, only files that were ready there are dated.
    """
    done = F.when(is_ready(), F.lit(as_of)).otherwise(F.col("section3"))
    if among is None:
        return tracker.withColumn("section3", done)
    ready = section_gate(among).select("filename", F.lit(True).alias("__ready")).distinct()
    marked = tracker.join(ready, "filename", "left")
    return marked.withColumn("section3", F.when(F.col("__ready"), done).otherwise(F.col("section3"))).select(*tracker.columns)


def mark_section(tracker: DataFrame, section: str, files: DataFrame, as_of: dt.date) -> DataFrame:
    """Date ``section`` for the named files; names the tracker does not know are added, dates that stand are kept."""
    named = files.select("filename").filter(F.col("filename").isNotNull()).distinct().withColumn("__named", F.lit(True))
    dated = F.coalesce(F.col(section), F.when(F.col("__named"), F.lit(as_of)))
    return tracker.join(named, "filename", "full_outer").withColumn(section, dated).select(*tracker.columns)
