"""Versioned snapshots: each write is partition ``version=N`` of one folder.

A version is written by Spark's dynamic partition overwrite: files are staged
and replace the partition when the job commits, so a job that dies half-way
leaves the old rows as they were, and a version may be rebuilt from its own
rows. An empty frame replaces the version by an empty one.

A tiny manifest (``<path>/_versions``, skipped by Spark's file listing
because of the leading underscore) records number, rows and time of every
write; versions and history are read from it, without touching a data file.
Reading "as of" a version lists and reads only that version's folder.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlake import schema as S

V = S.SNAPSHOT_VERSION
MANIFEST = "_versions"


def manifest_path(path: str) -> str:
    return f"{path.rstrip('/')}/{MANIFEST}"


MANIFEST_SCHEMA = T.StructType([T.StructField(V, T.IntegerType()),
                                T.StructField("linhas", T.LongType()),
                                T.StructField("escrito_em", T.TimestampType())])


def manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """(version, linhas, escrito_em) of every write, or None before the first."""
    if not folder_exists(spark, manifest_path(path)):
        return None
    return spark.read.schema(MANIFEST_SCHEMA).parquet(manifest_path(path))


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there, asked of the store that holds it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def versions_in(spark: SparkSession, path: str) -> list[int]:
    """Versions written under ``path``, as the manifest records them."""
    rows = manifest(spark, path)
    return [] if rows is None else sorted(r[V] for r in rows.select(V).distinct().collect())


def latest_version(spark: SparkSession, path: str) -> int | None:
    found = versions_in(spark, path)
    return found[-1] if found else None


def next_version(spark: SparkSession, path: str) -> int:
    last = latest_version(spark, path)
    return 0 if last is None else last + 1


class Watch:
    """Aggregates of the rows that a write writes, measured by the write itself:
    ``exprs`` maps names to SQL aggregates, ``values`` has them after the write."""

    def __init__(self, exprs: dict[str, str]):
        self.exprs = exprs
        self.values: dict = {}
        self.schema: T.StructType | None = None

    def row(self, spark: SparkSession) -> DataFrame:
        """The values as a one-row DataFrame."""
        return spark.range(1).select(*[
            F.lit(self.values[f.name]).cast(f.dataType).alias(f.name) for f in self.schema.fields])


def _watched(df: DataFrame, watch: Watch | None) -> tuple[DataFrame, Callable[[], int]]:
    """``df`` as observed, and what to call after the write for its rows."""
    seen, exprs = Observation(), [] if watch is None else [
        F.expr(e).alias(k) for k, e in watch.exprs.items()]
    if watch is not None:
        watch.schema = df.agg(*exprs).schema

    def written() -> int:
        if watch is not None:
            watch.values = {k: seen.get[k] for k in watch.exprs}
        return seen.get["__n"]

    return df.observe(seen, F.count(F.lit(1)).alias("__n"), *exprs), written


def write_watched(df: DataFrame, folder: str, watch: Watch | None = None) -> int:
    """Write ``df`` to a folder of its own; returns its rows."""
    rows, written = _watched(df, watch)
    rows.write.mode("overwrite").parquet(folder)
    return written()


def replace_partition(df: DataFrame, path: str, column: str, value: int | str,
                      watch: Watch | None = None) -> int:
    """Replace partition ``column=value`` of the folder by ``df``; returns its rows.

    The partition changes only when the job commits: until then, and for good
    if the job dies, readers see the old rows. ``watch`` is observed in the
    writing tasks: no scan after it, and no row counted twice if one is repeated.
    """
    rows, written = _watched(df.drop(column), watch)
    (rows.withColumn(column, F.lit(value)).write.mode("overwrite").partitionBy(column)
     .option("partitionOverwriteMode", "dynamic").parquet(path.rstrip("/")))
    n = written()
    if not n:  # no row, no partition to replace: leave an empty one
        (df.sparkSession.createDataFrame([], df.drop(column).schema).write.mode("overwrite")
         .parquet(f"{path.rstrip('/')}/{column}={value}"))
    return n


def write_snapshot(df: DataFrame, path: str, version: int | None = None,
                   now: _dt.datetime | None = None, watch: Watch | None = None) -> int:
    """Write ``df`` as version ``version`` (default: latest + 1); returns it.

    ``now`` is the time recorded for the write. One writer at a time is assumed.
    """
    spark = df.sparkSession
    v = next_version(spark, path) if version is None else int(version)
    n = replace_partition(df, path, V, v, watch)
    record(spark, path, {v: n}, now)
    return v


def record(spark: SparkSession, path: str, rows: dict[int, int],
           now: _dt.datetime | None = None) -> None:
    """Enter writes (version: rows) in the manifest."""
    at = now or _dt.datetime.now(_dt.timezone.utc)
    (spark.createDataFrame([(v, n, at) for v, n in sorted(rows.items())], MANIFEST_SCHEMA)
     .coalesce(1).write.mode("append").parquet(manifest_path(path)))


def write_snapshots(df: DataFrame, path: str, versions: Sequence[int],
                    now: _dt.datetime | None = None) -> dict[int, int]:
    """Replace each of ``versions`` by its rows of ``df`` (column ``version``), all in
    one job; returns their numbers of rows. A version without rows is empty then."""
    spark, seen = df.sparkSession, Observation()
    counts = [F.count_if(F.col(V) == v).alias(f"v{v}") for v in versions]
    (df.filter(F.col(V).isin(list(versions))).observe(seen, *counts).write.mode("overwrite")
     .partitionBy(V).option("partitionOverwriteMode", "dynamic").parquet(path.rstrip("/")))
    rows = {v: seen.get[f"v{v}"] for v in versions}
    for v in (v for v, n in rows.items() if not n):
        (spark.createDataFrame([], df.drop(V).schema).write.mode("overwrite")
         .parquet(f"{path.rstrip('/')}/{V}={v}"))
    record(spark, path, rows, now)
    return rows


def read_versions(spark: SparkSession, path: str, versions: Sequence[int],
                  schema: T.StructType) -> DataFrame:
    """Several versions with their number in column ``version``; only their folders
    are read."""
    where = [f"{path.rstrip('/')}/{V}={int(v)}" for v in versions]
    fields = [*schema.fields, T.StructField(V, T.IntegerType())]
    return (spark.read.schema(T.StructType(fields)).option("basePath", path.rstrip("/"))
            .parquet(*where))


def adopt(spark: SparkSession, staged: str, path: str, version: int, rows: int,
          now: _dt.datetime | None = None) -> None:
    """Make the folder ``staged`` version ``version`` by renaming it: its rows are not
    written again. An older folder of that version goes only when the new one is in
    its place."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    new, target = hadoop(staged), hadoop(f"{path.rstrip('/')}/{V}={int(version)}")
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(target.getParent())
    old = hadoop(f"{staged.rstrip('/')}.old")
    had = store.exists(target)
    if had and not store.rename(target, old):
        raise OSError(f"cannot set {target} aside")
    if not store.rename(new, target):
        raise OSError(f"cannot move {new} to {target}")
    if had:
        store.delete(old, True)
    record(spark, path, {int(version): rows}, now)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder (nothing happens if it is not there)."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def read_as_of(spark: SparkSession, path: str, version: int,
               schema: T.StructType | None = None) -> DataFrame:
    """The snapshot at ``version`` without the version column (one folder read).
    A known ``schema`` saves the job that reads it from a file."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path.rstrip('/')}/{V}={int(version)}")


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    last = latest_version(spark, path)
    if last is None:
        raise ValueError(f"no snapshot under {path}")
    return read_as_of(spark, path, last)


def snapshot_history(spark: SparkSession, path: str) -> DataFrame:
    """Per version: rows and time of its last write, from the manifest alone."""
    rows = manifest(spark, path)
    if rows is None:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return (rows.groupBy(V).agg(F.max_by("linhas", "escrito_em").alias("linhas"),
                                F.max("escrito_em").alias("escrito_em")).orderBy(V))


def _digest(columns: Sequence[str]) -> list:
    """128 bits of a row: two 64-bit hashes of its values and of where it is NULL
    (hashes skip NULLs)."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])
    return [F.xxhash64(nulls, *columns).alias("_h1"),
            F.xxhash64(*reversed(list(columns)), nulls, F.lit("second")).alias("_h2")]


def snapshot_diff(spark: SparkSession, path: str, a: int, b: int,
                  exclude: Sequence[str] = S.TIME_COLUMNS) -> DataFrame:
    """Row counts of two versions and rows only in one of them (as multisets).

    One aggregate over both versions, grouped on a 128-bit digest of the data
    columns: 16 bytes a row are shuffled instead of every column, and repeated
    rows collapse before, so a value repeated on a third of all rows costs one
    row per task. Two different rows of ``n`` share a digest with a chance of
    about ``n * n / 2**129`` (one in 10**14 for 10**12 rows).
    """
    one, two = read_as_of(spark, path, a), read_as_of(spark, path, b)
    if set(one.columns) != set(two.columns):
        raise ValueError("the versions have different columns")
    cols = sorted(c for c in one.columns if c not in exclude)
    sides = (one.select(*_digest(cols), F.lit(1).alias("_a"), F.lit(0).alias("_b"))
             .unionAll(two.select(*_digest(cols), F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    per_row = sides.groupBy("_h1", "_h2").agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))

    def total(x: F.Column, name: str) -> F.Column:
        return F.coalesce(F.sum(x), F.lit(0)).cast("long").alias(name)

    return per_row.agg(
        F.lit(int(a)).alias("versao_a"), F.lit(int(b)).alias("versao_b"),
        total(F.col("_a"), "linhas_a"), total(F.col("_b"), "linhas_b"),
        total(F.greatest(F.col("_a") - F.col("_b"), F.lit(0)), "so_em_a"),
        total(F.greatest(F.col("_b") - F.col("_a"), F.lit(0)), "so_em_b"))
