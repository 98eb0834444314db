"""Incremental Bronze landing lands each CSV file once."""

import os

from fraudlake import schema as S
from fraudlake.sources.csv import write_csv
from fraudlake.sources.fixtures import read_transactions
from fraudlake.streaming.ingest import bronze_stream
from tests.conftest import SF_SMALL


def test_bronze_stream_available_now(spark, tmp_root):
    landing, bronze, ckpt = (os.path.join(tmp_root, d) for d in ("landing", "bronze", "ckpt"))
    src = read_transactions(spark, SF_SMALL)
    write_csv(src.limit(1000).coalesce(1), os.path.join(landing, "batch1"))
    q = bronze_stream(spark, os.path.join(landing, "*"), bronze, ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(bronze).count() == 1000
    # a second batch arrives; a restart with the same checkpoint lands only it
    write_csv(src.limit(500).coalesce(1), os.path.join(landing, "batch2"))
    q = bronze_stream(spark, os.path.join(landing, "*"), bronze, ckpt)
    q.awaitTermination(120)
    out = spark.read.parquet(bronze)
    assert out.count() == 1500
    assert set(out.columns) == {f.name for f in S.BRONZE_SCHEMA.fields}


def test_checkpoint_root_fallback_on_bare_local_session():
    from fraudlake.session import checkpoint_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Ctx:
        master = "local[2]"
        _dir = None

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return self._dir

        def setCheckpointDir(self, d):
            self._dir = d + "/uuid"

    class Session:
        conf = Conf()
        sparkContext = Ctx()

    root = checkpoint_root(Session())
    assert root.endswith("/uuid") and os.path.isdir(root[: -len("/uuid")])
