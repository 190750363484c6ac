"""Session helpers (H1): building a session and finding the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours wants; callers may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "vectable",
    master: str | None = None,
    conf: dict[str, str] | None = None,
    log_level: str = "WARN",
) -> SparkSession:
    """Return the active session, creating one with our defaults if none exists.

    On a cluster the launcher supplies ``master`` and the shared
    ``spark.checkpoint.dir``; here we only add what is missing.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


#: Bytes of rows that go to a Python worker at a time, and rows that are read from Parquet at a time.
BATCH_BYTES, READ_ROWS = 4 << 20, 512


def small_batches(spark: SparkSession) -> None:
    """From now on rows of this session are read, and go to Python workers, in
    small batches. The defaults, 4,096 and 10,000 rows, are tens of MB of whole
    texts, which the executor and the worker each hold, and twice while they grow.
    Smaller settings stay."""
    to_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most, number in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES, to_bytes), ("spark.sql.parquet.columnarReaderBatchSize", READ_ROWS, int)):
        was = number(spark.conf.get(key))
        spark.conf.set(key, min(was, most) if was > 0 else most)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Where it is unset, a local master (one machine, as
    in tests) gets a private folder under the system temp dir; on a cluster
    that would be a folder of each machine's own, so it is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="vectable-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
