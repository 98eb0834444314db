"""CSV source (the raw card-transaction file) and a CSV sink for hand-offs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlake import schema as S


def read_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Read the transaction CSV (header row); columns are taken by header name.

    The eight source columns are read as double (``typed`` later casts the
    indicators to integer), all in one pass. A row with a value that is no
    number, or with too few or too many fields, is kept: what cannot be read
    is NULL, and ``_corrupt_record`` has the row's text as it came (NULL for
    good rows), so that nothing is lost and a gate rule can count such rows.
    ``infer=True`` asks Spark for the types, which costs one more pass; a
    column with text in it then is text, and ``_corrupt_record`` has the rows
    with too few or too many fields. Extra columns are ignored; a missing one
    is an error, and so is a file whose header differs from the first file's.
    """
    # enforceSchema=false: every file's header must match the first one's, so
    # a file with its columns in another order fails instead of being read
    # by position.
    reader = spark.read.option("header", True).option("enforceSchema", False)
    header = reader.csv(path) if not infer else reader.option("inferSchema", True).csv(path)
    schema = T.StructType([
        f if infer or f.name not in S.SOURCE_COLUMNS else T.StructField(f.name, T.DoubleType())
        for f in header.schema.fields] + [T.StructField(S.CORRUPT_COL, T.StringType())])
    # Without pruning every field is parsed, whatever a query needs, so that a
    # row is malformed in all queries or in none.
    rows = (reader.option("inferSchema", False).schema(schema).option("columnPruning", False)
            .option("columnNameOfCorruptRecord", S.CORRUPT_COL).csv(path))
    return rows.select(*S.SOURCE_COLUMNS, S.CORRUPT_COL)


def with_corrupt_column(df: DataFrame) -> DataFrame:
    """``df`` with the corrupt-record column, NULL if it had none."""
    if S.CORRUPT_COL in df.columns:
        return df
    return df.withColumn(S.CORRUPT_COL, F.lit(None).cast("string"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``df`` as CSV with a header (one file per partition)."""
    df.write.mode(mode).option("header", True).csv(path)
