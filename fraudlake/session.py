"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", app: str = "fraudlake",
                  shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A ``local[cpus]`` session for tests and the bench.

    On a cluster use the session the platform gives you; nothing in the
    library depends on these settings except the scratch folder below.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session has none (a bare local test session) do we give the
    SparkContext a private one, so ``DataFrame.checkpoint`` and our scratch
    writes work. On a cluster an unset value is an error.
    """
    root = spark.conf.get(_CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getConf().get(_CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fraudlake-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder name under the shared checkpoint root."""
    return "/".join([checkpoint_root(spark), "fraudlake", uuid.uuid4().hex, *parts])

