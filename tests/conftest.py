import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fraudlake import schema as S  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    tmp = tempfile.mkdtemp(prefix="fraudlake-test-")
    spark = (
        SparkSession.builder.master("local[*]")
        .appName("fraudlake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", os.path.join(tmp, "warehouse"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="fraudlake-lake-")


def rows_df(spark, rows):
    """DataFrame of source rows: tuples in SOURCE_COLUMNS order (None = NULL)."""
    return spark.createDataFrame(rows, S.SOURCE_SCHEMA)
