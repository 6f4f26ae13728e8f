"""Versioned Parquet tables.

Parquet cannot be changed in place, so each load writes a new folder and then
adds one row to a log of finished versions. Readers take the newest logged
version; a load that dies half-way leaves no trace in the log, and the next one
writes over its folder. One writer at a time is assumed.

A table laid out in parts may be written in part: the version then holds the parts
that were replaced, and the others are read from the versions that wrote them last.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = "name string, version bigint, run string, parts array<string>, counted map<string,bigint>, schema string"
PIN_SCHEMA = "run string, name string, version bigint"


class Parts(NamedTuple):
    """How a table is laid out: by a column of its own, or by a ``value`` under that name.

    Values become folder names. Choose those that keep a part as large as a task
    likes to read, such as a month, or a hash of the key modulo the size in tasks.
    """

    column: str
    value: Column | None = None

    def of_rows(self) -> Column:
        """The part of a row, as the log names it; values of one's own are marked as text."""
        return F.col(self.column).cast("string") if self.value is None else F.concat(F.lit("p"), self.value.cast("string"))


def hash_parts(key: str, count: int) -> Parts:
    """Parts by a hash of the key."""
    return Parts("part", F.pmod(F.xxhash64(key), F.lit(count)))


class Snapshots:
    """Tables under ``root``.

    ``buckets`` maps a table to (number of buckets, key). Its versions are then
    saved as catalog tables bucketed and sorted by the key, and an upsert by
    that key does not shuffle them. Choose at least as many buckets as
    ``spark.sql.shuffle.partitions``, or Spark shuffles the table after all.
    Without a lasting catalog a later session reads the same files unbucketed.
    ``parts`` maps a table to its layout in parts.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        buckets: Mapping[str, tuple[int, str]] | None = None,
        parts: Mapping[str, Parts] | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = dict(buckets or {})
        self.parts = dict(parts or {})
        self._log = f"{self.root}/_log"
        self._pins = f"{self.root}/_pins"
        self._entries: list[Row] | None = None

    def _folder(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/version={version:08d}"

    def _table(self, name: str, version: int) -> str:
        return f"{name}_{version:08d}"

    @property
    def entries(self) -> list[Row]:
        """The log, one row per finished version; read once per object."""
        if self._entries is None:
            self._entries = self._rows(self._log, LOG_SCHEMA)
        return self._entries

    def _rows(self, path: str, schema: str) -> list[Row]:
        try:
            return self.spark.read.schema(schema).parquet(path).collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def version(self, name: str) -> int:
        """The newest finished version; -1 if there is none."""
        return max((entry.version for entry in self.entries if entry.name == name), default=-1)

    def finished(self, name: str, run: str) -> bool:
        return any(entry.name == name and entry.run == run for entry in self.entries)

    def version_of(self, name: str, run: str) -> int:
        """The version that a run wrote."""
        return next(entry.version for entry in self.entries if entry.name == name and entry.run == run)

    def pinned(self, run: str) -> bool:
        return any(row.run == run for row in self._rows(self._pins, PIN_SCHEMA))

    def pin(self, run: str, names: Sequence[str]) -> dict[str, int]:
        """The versions that a run reads: the newest ones when it first asked, and the same whenever it asks again."""
        pinned = {row.name: row.version for row in self._rows(self._pins, PIN_SCHEMA) if row.run == run}
        if not pinned:
            pinned = {name: self.version(name) for name in names}
            rows = [F.struct(F.lit(name).alias("name"), F.lit(at).cast("bigint").alias("version")) for name, at in pinned.items()]
            table = self.spark.range(0, 1, 1, 1).select(F.lit(run).alias("run"), F.inline(F.array(*rows)))
            table.write.mode("append").parquet(self._pins)
        return pinned

    def bucketed(self, name: str) -> bool:
        """Whether the newest version can be read without a shuffle by its key."""
        version = self.version(name)
        if name not in self.buckets or version < 0:
            return False
        return self.spark.catalog.tableExists(self._table(name, version))

    def read(self, name: str, empty: DataFrame | None = None, version: int | None = None, parts: Sequence[str] | None = None) -> DataFrame:
        """A version, by default the newest, or ``empty`` if there is none.

        Of a table in parts only the given ``parts`` are read, or all.
        """
        newest = self.version(name)
        version = newest if version is None else version
        if version < 0:
            if empty is None:
                raise LookupError(f"no version of {name} under {self.root}")
            return empty
        if name in self.parts:
            return self._read_parts(name, version, parts)
        if version == newest and self.bucketed(name):
            return self.spark.table(self._table(name, version))
        return self.spark.read.parquet(self._folder(name, version))

    def _read_parts(self, name: str, version: int, wanted: Sequence[str] | None) -> DataFrame:
        """One scan over the folders of the versions concerned; what is not wanted is pruned by folder."""
        layout, owned, taken = self.parts[name], set(), []
        part = F.col(layout.column).cast("string")
        for entry in sorted((e for e in self.entries if e.name == name and e.version <= version), key=lambda e: -e.version):
            if entry.parts is None:
                taken.append((entry.version, F.coalesce(~part.isin(sorted(owned)), F.lit(True)) if owned else F.lit(True)))
                break
            own = sorted(set(entry.parts) - owned)
            owned.update(own)
            if own:
                taken.append((entry.version, part.isin(own)))
        folders = [self._folder(name, at) for at, _ in taken]
        # An empty table has no file that tells its columns; the log does.
        columns = next(e.schema for e in self.entries if e.name == name and e.version == version)
        schema = T.StructType.fromJson(json.loads(columns)).add("version", T.LongType())
        table = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*folders)
        chosen = reduce(lambda a, b: a | b, [(F.col("version") == at) & where for at, where in taken])
        table = table.where(chosen if wanted is None else chosen & part.isin(list(wanted))).drop("version")
        return table if layout.value is None else table.drop(layout.column)

    def touched(self, name: str, rows: DataFrame) -> list[str]:
        """The parts that the rows belong to; as many as there are parts at most."""
        return [row.part for row in rows.select(self.parts[name].of_rows().alias("part")).distinct().collect()]

    def write(
        self,
        name: str,
        table: DataFrame,
        run: str,
        clustered: bool = False,
        parts: Sequence[str] | None = None,
        count: Mapping[str, Column] | None = None,
    ) -> DataFrame:
        """Write ``table`` as the next version and return it as read back.

        ``run`` names the load. A run that has finished before is not written
        again, so a replayed load changes nothing.

        A bucketed table is brought together by its key first, or each task
        would write a file per bucket. ``clustered`` states that the table is
        an upsert into the bucketed version before: its tasks hold one bucket
        each already.

        Of a table in parts, ``table`` replaces the given ``parts``, and may leave some of
        them empty; without ``parts`` it replaces all. What is returned has all parts.

        ``count`` names aggregates, whole numbers, that are taken of the rows as they are
        written; ``counted`` tells them afterwards, without another read.
        """
        if self.finished(name, run):
            return self.read(name, version=self.version_of(name, run))
        version = self.version(name) + 1
        if parts is not None and name not in self.parts:
            raise ValueError(f"{name} is not laid out in parts")
        if name in self.parts:
            layout = self.parts[name]
            if layout.value is not None:
                table = table.withColumn(layout.column, layout.of_rows())
            table, seen = self._observed(table.repartition(layout.column), count)
            table.write.mode("overwrite").partitionBy(layout.column).parquet(self._folder(name, version))
            return self._logged(name, version, run, parts, seen, table.schema)
        if name in self.buckets:
            buckets, key = self.buckets[name]
            if not (clustered and self.bucketed(name)):
                table = table.repartition(buckets, key)
            table, seen = self._observed(table, count)
            writer = table.write.mode("overwrite")
            writer.bucketBy(buckets, key).sortBy(key).option(
                "path", self._folder(name, version)
            ).saveAsTable(self._table(name, version))
        else:
            table, seen = self._observed(table, count)
            table.write.mode("overwrite").parquet(self._folder(name, version))
        return self._logged(name, version, run, None, seen, table.schema)

    @staticmethod
    def _observed(table: DataFrame, count: Mapping[str, Column] | None) -> tuple[DataFrame, Observation | None]:
        """The table as it goes to the writer, so that no task that runs again counts twice."""
        if not count:
            return table, None
        seen = Observation()
        return table.observe(seen, *[value.cast("bigint").alias(name) for name, value in count.items()]), seen

    def counted(self, name: str, run: str) -> dict[str, int]:
        """What the write of that run counted."""
        return next(dict(entry.counted or {}) for entry in self.entries if entry.name == name and entry.run == run)

    def _logged(
        self, name: str, version: int, run: str, parts: Sequence[str] | None, seen: Observation | None, schema: T.StructType
    ) -> DataFrame:
        counted = {key: value or 0 for key, value in seen.get.items()} if seen else {}
        numbers = [F.lit(x) for key, value in counted.items() for x in (key, value)]
        row = self.spark.range(0, 1, 1, 1).select(
            F.lit(name).alias("name"),
            F.lit(version).cast("bigint").alias("version"),
            F.lit(run).alias("run"),
            F.lit(None if parts is None else list(parts)).cast("array<string>").alias("parts"),
            F.create_map(*numbers).cast("map<string,bigint>").alias("counted"),
            F.lit(schema.json()).alias("schema"),
        )
        known = self.entries
        row.write.mode("append").parquet(self._log)
        known.append(Row(name=name, version=version, run=run, parts=None if parts is None else list(parts), counted=counted, schema=schema.json()))
        return self.read(name)
