"""Sinks: raw loads, published tables, views, and working tables between jobs."""

import json
import time
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType

from authlytics.sources.raw import conform

CHECKPOINT_DIR = "spark.checkpoint.dir"


def working_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints; where it names none, one is set
    beside the tables, in the warehouse, which all executors share as well."""
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        spark.sparkContext.setCheckpointDir(f"{warehouse}/_working")
        named = spark.sparkContext.getCheckpointDir()
    return named


class WorkingTables:
    """Parquet tables of one run under the shared folder, each run in a folder of its own."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{working_folder(spark)}/authlytics-{uuid.uuid4().hex}"
        # What nobody drops before goes with the driver.
        self._file_system().deleteOnExit(self._path(self.folder))

    def write(self, rows: DataFrame, name: str, *partition_columns: str) -> DataFrame:
        """Write the rows and return a DataFrame that reads them back."""
        path = f"{self.folder}/{name}"
        rows.write.partitionBy(*partition_columns).parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete the named tables, or the run's folder; what reads them becomes unusable."""
        for path in [f"{self.folder}/{name}" for name in names] or [self.folder]:
            self._file_system().delete(self._path(path), True)

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _file_system(self):
        settings = self.spark.sparkContext._jsc.hadoopConfiguration()
        return self._path(self.folder).getFileSystem(settings)


KEPT_BUILDS = 2  # of a group, the current one included, for readers that started before a switch
ABANDONED_HOURS = 24  # after which a build that was never shown is taken for half-written


class Record(NamedTuple):
    """An entry of a group's log: the build that became current as this version."""

    version: int
    build: str
    measured: dict[str, dict[str, object]]


class BuildLog:
    """The builds of a group in the order in which they became current.

    An entry is a file named by its version in the database's folder.  It is created only where it
    is not there yet, so of two writers that aim at the same version one fails and takes the next;
    the file system has to create files exclusively, as HDFS does.  An entry that was cut short
    counts as none.
    """

    def __init__(self, spark: SparkSession, database: str, group: str):
        location = spark.catalog.getDatabase(database).locationUri
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop
        self._io = spark.sparkContext._jvm.org.apache.commons.io
        self._folder = f"{location}/_{group}__log"
        settings = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path(self._folder).getFileSystem(settings)

    def _path(self, path: str):
        return self._hadoop.fs.Path(path)

    def _versions(self) -> list[int]:
        if not self._files.exists(self._path(self._folder)):
            return []
        names = (f.getPath().getName() for f in self._files.listStatus(self._path(self._folder)))
        return sorted(int(name) for name in names if name.isdigit())

    def _file(self, version: int):
        return self._path(f"{self._folder}/{version:010d}")

    def records(self) -> list[Record]:
        """All entries, the newest last."""
        found = []
        for version in self._versions():
            stream = self._files.open(self._file(version))
            text = self._io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            try:
                found.append(Record(version, **json.loads(text)))
            except ValueError:
                pass
        return found

    def append(self, build: str, measured: dict) -> int:
        """Enter a build after all others; its version."""
        entry = json.dumps({"build": build, "measured": measured}, default=str).encode()
        while True:
            version = max(self._versions(), default=0) + 1
            try:
                stream = self._files.create(self._file(version), False)
            except Py4JJavaError:
                if not self._files.exists(self._file(version)):
                    raise
                continue  # another writer was first
            stream.write(entry)
            stream.close()
            return version

    def forget(self, versions: list[int]) -> None:
        for version in versions:
            self._files.delete(self._file(version), False)


class Build:
    """One build of a group of tables, written beside the current one and then shown all at once.

    Every table keeps its builds as partitions, each written by its own job into its own folder,
    and a view of the table's name shows the build that the group's `current` view names.  `show`
    enters the build in the group's log and replaces that one view, so readers see a complete old
    build or a complete new one, however a run ends.  Several writers may build at once: the log
    orders them, and whoever replaces the view last leaves it at the log's newest entry.  The last
    KEPT_BUILDS builds stay for readers that started before; older ones go, and so do builds that
    were begun more than ABANDONED_HOURS ago and never shown.
    """

    def __init__(self, spark: SparkSession, database: str, group: str):
        self.spark, self.database, self.group = spark, database, group
        self.name = f"{int(time.time() * 1000):013d}_{uuid.uuid4().hex}"
        self.log = BuildLog(spark, database, group)
        self.tables: dict[str, list[str]] = {}
        self.measured: dict[str, dict[str, object]] = {}

    def _folder(self, name: str) -> str:
        location = self.spark.catalog.getDatabase(self.database).locationUri
        return f"{location}/{name}__builds"

    def write(
        self, rows: DataFrame, name: str, measures: dict[str, Column] | None = None
    ) -> DataFrame:
        """Write a table of this build, once, and return a DataFrame that reads it.

        `measures` are aggregates of the rows that are taken while they are written.
        """
        table, path = f"{self.database}.{name}__builds", f"{self._folder(name)}/build={self.name}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}, build STRING) USING parquet "
            "PARTITIONED BY (build)"
        )
        seen, written = Observation(), rows
        if measures:
            named = [m.alias(f"m{i}") for i, m in enumerate(measures.values())]
            written = rows.observe(seen, *named)
        written.write.parquet(path)
        self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (build = '{self.name}')")
        if measures:
            # A table that is known to be empty before it is written reports nothing.
            values = seen.get
            self.measured[name] = {m: values.get(f"m{i}") for i, m in enumerate(measures)}
        self.tables[name] = rows.columns
        return self.spark.read.schema(rows.schema).parquet(path)

    def show(self) -> None:
        """Make this build the current one of its group."""
        current = f"{self.database}.{self.group}__current"
        self.log.append(self.name, self.measured)
        while True:
            newest = self.log.records()[-1]
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {current} AS SELECT '{newest.build}' AS build"
            )
            if self.log.records()[-1].version == newest.version:
                break
        for name, names in self.tables.items():
            columns = ", ".join(f"`{c}`" for c in names)
            self.spark.sql(
                f"CREATE VIEW IF NOT EXISTS {self.database}.{name} AS SELECT {columns} "
                f"FROM {self.database}.{name}__builds WHERE build = (SELECT build FROM {current})"
            )
        self._retire()

    def _retire(self) -> None:
        records = self.log.records()
        kept = {record.build for record in records[-KEPT_BUILDS:]}
        entered = {record.build for record in records}
        oldest = (time.time() - 3600 * ABANDONED_HOURS) * 1000
        jvm, settings = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc
        for name in self.tables:
            folder = jvm.org.apache.hadoop.fs.Path(self._folder(name))
            files = folder.getFileSystem(settings.hadoopConfiguration())
            for found in files.listStatus(folder):
                build = found.getPath().getName().removeprefix("build=")
                begun, _, key = build.partition("_")
                if build in kept or not (begun.isdigit() and key):
                    continue
                if build in entered or int(begun) < oldest:
                    self.spark.sql(
                        f"ALTER TABLE {self.database}.{name}__builds "
                        f"DROP IF EXISTS PARTITION (build = '{build}')"
                    )
                    files.delete(found.getPath(), True)
        self.log.forget([r.version for r in records if r.build not in kept])


def publish(spark: SparkSession, database: str, group: str, tables: dict[str, DataFrame]) -> None:
    """Replace the tables of a group in a database, all of them at once."""
    build = Build(spark, database, group)
    for name, rows in tables.items():
        build.write(rows, name)
    build.show()


def measured(spark: SparkSession, database: str, groups: Iterable[str]) -> dict[str, object]:
    """What was measured while the builds that the groups show were written."""
    shown = [f"SELECT '{g}' AS name, build FROM {database}.{g}__current" for g in groups]
    found: dict[str, object] = {}
    for group, build in spark.sql(" UNION ALL ".join(shown)).collect():
        for record in BuildLog(spark, database, group).records():
            if record.build == build:
                for values in record.measured.values():
                    found |= values
    return found


def load_raw(
    rows: DataFrame,
    schema: StructType,
    database: str,
    name: str,
    measures: dict[str, Column] | None = None,
) -> None:
    """Replace a raw table by the rows, cast to its declared schema; the old one is read until
    the new one is whole."""
    build = Build(rows.sparkSession, database, name)
    build.write(conform(rows, schema), name, measures)
    build.show()


def publish_view(spark: SparkSession, database: str, name: str, query: str) -> None:
    """A view in the database, for every session."""
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {query}")
