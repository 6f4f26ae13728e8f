"""Session helpers: a local session for tests, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cpus: str = "8", app: str = "rollbook") -> SparkSession:
    """A single-JVM session for tests and benchmarks.

    A cluster brings its own session; nothing in the library depends on the
    settings below, except that dates are read in UTC.
    """
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name for one run, on storage that every executor sees.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only a
    local master, where driver and executors share one disk, may go without it
    and gets a temporary folder.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if shared:
        return f"{shared.rstrip('/')}/rollbook-{label}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"rollbook-{label}-") + "/data"
