"""Bronze: the source rows as they came, plus control columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake import schema as S


def add_control_columns(df: DataFrame, source: str = S.DEFAULT_SOURCE,
                        version: str = S.DEFAULT_PIPELINE_VERSION,
                        ts: Column | None = None) -> DataFrame:
    """Append ingestion time, source name and pipeline version.

    ``ts`` lets a run stamp every table with one time; default is
    ``current_timestamp()`` (one value per query, fixed by the optimizer).
    """
    return df.withColumns({
        S.INGEST_TS: ts if ts is not None else F.current_timestamp(),
        S.SOURCE_COL: F.lit(source),
        S.VERSION_COL: F.lit(version),
    })
