"""Incremental Bronze landing: new CSV files in a folder -> Bronze parquet.

The same Bronze step as the batch run (source columns + control columns),
run as a file stream. The checkpoint records which files were taken, so a
rerun (or a restart after losing executors or the driver) lands each file
exactly once. ``trigger(availableNow=True)`` processes what is there and
stops, which suits a scheduled job; a processing-time trigger keeps it
running. Downstream layers are batch: they read Bronze as a table.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fraudlake import schema as S
from fraudlake.operators.bronze import add_control_columns


def bronze_stream(spark: SparkSession, landing: str, bronze_path: str, checkpoint: str,
                  source_name: str = S.DEFAULT_SOURCE, available_now: bool = True,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the landing stream; returns the running query."""
    # A file stream needs a schema; enforceSchema=false makes Spark check
    # each file's header names against it instead of mapping by position.
    # Rows that cannot be read whole keep their text, as in the batch source.
    reader = (spark.readStream.schema(T.StructType(
        S.CSV_SCHEMA.fields + [T.StructField(S.CORRUPT_COL, T.StringType())]))
              .option("header", True).option("enforceSchema", False)
              .option("columnNameOfCorruptRecord", S.CORRUPT_COL))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = add_control_columns(reader.csv(landing), source=source_name,
                               ts=F.current_timestamp())
    writer = (rows.writeStream.format("parquet")
              .option("checkpointLocation", checkpoint)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="1 minute")
    return writer.start(bronze_path)
