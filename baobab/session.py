"""Session construction and cluster-facing settings.

Everything here is plain Spark configuration.  The defaults aim at a large
cluster (AQE with partition coalescing and skew-join splitting, UTC session
clock, ANSI mode kept on) and are overridable per call.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings applied to every session we build.  ANSI stays on (the 4.x
#: default): tolerant parsing is asked for explicitly with ``try_*``.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Parquet scans: ~128 MB splits keep tasks spill-free at any scale.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "baobab",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a configured session (re-uses an active one if present)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Set on a caller's session the two settings that results depend on: the
    UTC clock and ANSI arithmetic.  Everything else stays as the caller has it."""
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(key, DEFAULT_CONF[key])
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``.

    A scratch folder is created only for a ``local`` master with the
    setting unset (tests, benchmarks); on a cluster an unset setting is an
    error rather than a silent machine-local folder that other executors
    cannot read.  Jobs that cut their lineage call this and then
    ``DataFrame.checkpoint()``.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set for this cluster session")
        named = tempfile.mkdtemp(prefix="baobab-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(named)
    return named


def materialise(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet into a folder of its own under the shared checkpoint
    folder, and read again: later steps re-read it if an executor is lost, and plan
    with its true size."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/baobab-steps/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
