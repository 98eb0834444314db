"""Helpers shared by the operators: staged tables, whole groups, safe columns."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.session import scratch_path

__all__ = ["file_store", "group_starts", "scratch_path", "shuffle_partitions", "staged",
           "text_rows", "whole_groups"]


def staged(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to a fresh folder under ``spark.checkpoint.dir`` and read it
    back: lineage is cut by a table every executor can read again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_store(path: str):
    """(pyarrow file system, path in it) of a URI or a plain path."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:/"):
        if path.startswith("file:/") and not path.startswith("file://"):
            path = "file://" + path[5:]
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` (long) and ``text`` (string): other columns cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))


def whole_groups(batches: Iterable[pd.DataFrame], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Frames of whole groups from key-sorted batches: the last, perhaps
    unfinished, group of a batch waits for the next one. Memory: one batch plus
    the largest group."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        cuts = np.flatnonzero(_changes(batch, keys))
        if rest and _same(rest[-1].iloc[-1], batch.iloc[0], keys):
            first = int(cuts[0]) + 1 if len(cuts) else len(batch)
            rest.append(batch.iloc[:first])
            if first == len(batch):
                continue
            batch = batch.iloc[first:]
            cuts = np.flatnonzero(_changes(batch, keys))
        if rest:
            yield pd.concat(rest, ignore_index=True)
        last = int(cuts[-1]) + 1 if len(cuts) else 0
        if last:
            yield batch.iloc[:last].reset_index(drop=True)
        rest = [batch.iloc[last:]]
    if rest:
        yield pd.concat(rest, ignore_index=True)


def _changes(frame: pd.DataFrame, keys: Sequence[str]) -> np.ndarray:
    """True at row i if row i + 1 starts another group."""
    out = np.zeros(max(len(frame) - 1, 0), bool)
    for key in keys:
        values = frame[key].to_numpy()
        out |= values[1:] != values[:-1]
    return out


def _same(a: pd.Series, b: pd.Series, keys: Sequence[str]) -> bool:
    return all(a[k] == b[k] for k in keys)


def group_starts(frame: pd.DataFrame, keys: Sequence[str]) -> np.ndarray:
    """First row of each group, and the number of rows at the end."""
    return np.concatenate(([0], np.flatnonzero(_changes(frame, keys)) + 1, [len(frame)]))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
