"""Release pages: which files are on offer and which are still to be handled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions import columns as c

# The name of a release file, and a link in a page.
RELEASE_FILE_PATTERN = "BasicCompanyDataAsOneFile-[0-9]{4}-[0-9]{2}-[0-9]{2}\\.zip"
LINK_PATTERN = "(?i)<a\\s[^>]*?href\\s*=\\s*[\"']([^\"']+)[\"']"


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, href), one row per link; a link may occur several times."""
    links = F.regexp_extract_all("html", F.lit(LINK_PATTERN), F.lit(1))
    return pages.select("page_id", F.explode(links).alias("href"))


def release_links(links: DataFrame, pattern: str = RELEASE_FILE_PATTERN) -> DataFrame:
    """(page_id, filename, release_date) of the links that name a release file."""
    return (
        links.filter(F.col("href").rlike(pattern))
        .select("page_id", F.regexp_substr("href", F.lit(pattern)).alias("filename"))
        .withColumn("release_date", c.release_date(F.col("filename")))
    )


def unprocessed(releases: DataFrame, tracker: DataFrame) -> DataFrame:
    """Distinct file names that the tracker does not show as loaded.

    Names are made distinct first, within each task before the shuffle, so a
    name that occurs millions of times does not fill one task of the join.
    """
    loaded = tracker.filter(F.col("section1").isNotNull()).select("filename")
    return releases.select("filename").distinct().join(loaded, "filename", "left_anti")
