"""Layer tables as parquet folders under one root, optionally named in a catalog.

The root is shared storage (object store / HDFS path on a cluster). When a
``database`` is given, each table is also named there, as a view over its
folder, so SQL can use ``database.table`` names; otherwise a temp view of
the same name is created.

Versioned tables (Bronze, Silver, thresholds) live in ``<table>`` folders
with ``version=N`` partitions; their plain name shows the latest version
(a view) and ``<table>_versions`` shows all versions. Temp views list their
folders when they are registered (every run); catalog views list at query
time only, so use a ``database`` for large, long-lived lakes.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlake import schema as S
from fraudlake.operators import versions

VERSIONS_SUFFIX = "_versions"
# Unversioned tables are one partition, so that they are replaced as versions are.
CURRENT, CURRENT_VALUE = "lote", "atual"


class TableStore:
    def __init__(self, spark: SparkSession, root: str, database: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database
        if database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def name(self, table: str) -> str:
        """Name to use in SQL: ``database.table`` or a temp view ``table``."""
        return f"{self.database}.{table}" if self.database else table

    def _schema(self, table: str) -> T.StructType | None:
        return {S.RUN_LOG_TABLE: S.RUN_LOG_SCHEMA, S.BRONZE_TABLE: S.BRONZE_SCHEMA,
                S.THRESHOLDS_TABLE: S.THRESHOLDS_SCHEMA}.get(table)

    def _reader(self, table: str):
        schema = self._schema(table)
        return self.spark.read if schema is None else self.spark.read.schema(schema)

    def read(self, table: str) -> DataFrame:
        return self.read_log() if table == S.RUN_LOG_TABLE else self._reader(table).parquet(
            self._folder(table))

    def _folder(self, table: str) -> str:
        return f"{self.path(table)}/{CURRENT}={CURRENT_VALUE}"

    def write(self, df: DataFrame, table: str) -> None:
        """Replace the table's rows (staged: a job that dies leaves the old ones)."""
        versions.replace_partition(df, self.path(table), CURRENT, CURRENT_VALUE)
        self.register(table, df.schema)

    def append_log(self, entry: DataFrame, now: _dt.datetime | None = None) -> None:
        """Append run-log rows. A repeated run id (always text: ``007`` is not
        ``7``) is appended again, and the row written last counts."""
        at = now or _dt.datetime.now(_dt.timezone.utc)
        rows = entry.withColumn(S.LOG_WRITTEN, F.lit(at))
        (rows.select(*[F.col(f.name).cast(f.dataType) for f in S.RUN_LOG_SCHEMA.fields])
         .coalesce(1).write.mode("append").parquet(self.path(S.RUN_LOG_TABLE)))
        self.register(S.RUN_LOG_TABLE)

    def read_log(self) -> DataFrame:
        """The run log: of each run id, the row written last."""
        return _last_of_run(self.spark.read.schema(S.RUN_LOG_SCHEMA).parquet(
            self.path(S.RUN_LOG_TABLE)))

    # --- versioned tables ---------------------------------------------------

    def write_version(self, df: DataFrame, table: str, version: int,
                      now: _dt.datetime | None = None,
                      watch: versions.Watch | None = None) -> None:
        versions.write_snapshot(df, self.path(table), version, now, watch)

    def read_all_versions(self, table: str, schema: T.StructType) -> DataFrame:
        """Every version that the manifest lists, with its number."""
        found = versions.versions_in(self.spark, self.path(table))
        return versions.read_versions(self.spark, self.path(table), found, schema)

    def read_version(self, table: str, version: int) -> DataFrame:
        return versions.read_as_of(self.spark, self.path(table), version, self._schema(table))

    def latest(self, table: str) -> int | None:
        return versions.latest_version(self.spark, self.path(table))

    def register_versions(self, table: str, last: int | None = None) -> None:
        """``<table>_versions``: every version; ``<table>``: the latest one."""
        last = self.latest(table) if last is None else last
        if last is None:
            return
        path = self.path(table)
        if self.database:
            self._view(table + VERSIONS_SUFFIX, f"parquet.`{path}`")
            self._view(table, f"parquet.`{path}/{S.SNAPSHOT_VERSION}={last}`")
        else:
            schema = self._schema(table)
            rows = self.spark.read.option("basePath", path)
            if schema is not None:
                rows = rows.schema(T.StructType(
                    schema.fields + [T.StructField(S.SNAPSHOT_VERSION, T.IntegerType())]))
            rows.parquet(path).createOrReplaceTempView(table + VERSIONS_SUFFIX)
            self.read_version(table, last).createOrReplaceTempView(table)

    # --- catalog -------------------------------------------------------------

    def _view(self, table: str, relation: str) -> None:
        """A catalog view over a parquet folder: always current (files are
        listed at query time), replaced atomically, no partition bookkeeping."""
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(table)} AS "
                       f"SELECT * FROM {relation}")

    def register(self, table: str, schema: T.StructType | None = None) -> None:
        """Expose an unversioned table to SQL (catalog view or temp view)."""
        if table == S.RUN_LOG_TABLE and self.database:
            columns = [f.name for f in S.RUN_LOG_SCHEMA.fields if f.name != S.RUN_ID]
            last = ", ".join(f"max_by({c}, {S.LOG_WRITTEN}) AS {c}" for c in columns)
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {self.name(table)} AS SELECT {S.RUN_ID}, {last} "
                f"FROM parquet.`{self.path(table)}` GROUP BY {S.RUN_ID}")
        elif self.database:
            self._view(table, f"parquet.`{self._folder(table)}`")
        elif schema is not None:
            (self.spark.read.schema(schema).parquet(self._folder(table))
             .createOrReplaceTempView(table))
        else:
            self.read(table).createOrReplaceTempView(table)

    def drop(self, table: str, delete_files: bool = False) -> None:
        """Forget the catalog views / temp views; with ``delete_files`` the rows
        are deleted too and cannot be brought back."""
        for t in (table, table + VERSIONS_SUFFIX):
            if self.database:
                self.spark.sql(f"DROP VIEW IF EXISTS {self.name(t)}")
            else:
                self.spark.catalog.dropTempView(t)
        if delete_files:
            jvm = self.spark.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(self.path(table))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _last_of_run(rows: DataFrame) -> DataFrame:
    """Of each run id, the row written last."""
    others = [c for c in rows.columns if c != S.RUN_ID]
    return rows.groupBy(S.RUN_ID).agg(
        *[F.max_by(c, S.LOG_WRITTEN).alias(c) for c in others]).select(*rows.columns)
