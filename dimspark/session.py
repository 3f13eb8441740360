"""Session set-up and shared scratch storage.

The settings here are the ones every job of the library relies on:
UTC session time zone (the time dimension must not depend on where an
executor runs), adaptive query execution with skew-join splitting, and
ANSI mode left on (text-to-number casts go through ``try_cast``).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings applied to every session built here.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "dimspark",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the library's settings.

    ``master`` is only given in tests and benchmarks; on a cluster the
    launcher decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate may return a running session: make the runtime SQL
    # settings hold for it as well.
    for k, v in conf.items():
        if k.startswith("spark.sql.") and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("WARN")
    return spark


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Apply the library's runtime SQL settings (UTC, AQE, skew join) to a
    session built elsewhere, e.g. by a launcher."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql.") and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; it is read from the
    session. Only when it is unset (tests, a laptop) is a fresh local
    folder created and registered.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        return root
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        # A machine-local folder is invisible to other executors and lost
        # with the machine: a cluster must name a shared one.
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder (e.g. on HDFS or S3)")
    root = tempfile.mkdtemp(prefix="dimspark-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
