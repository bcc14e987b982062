"""Session helpers: building a local session for tests / bench, and locating the
shared checkpoint folder on a cluster."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "riskfeed",
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the setting names shared storage and is used as is; without it a
    job stops, as executors would write to folders that others cannot see. Only a
    single-JVM session (``local[n]``, tests) gets a private scratch folder.
    """
    global _LOCAL_DIR
    current = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_DIR
    if not current and not spark.conf.get("spark.master", "local").startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not current:
        current = tempfile.mkdtemp(prefix="riskfeed-ckpt-", dir=os.environ.get("RISKFEED_SCRATCH", "/tmp"))
        _LOCAL_DIR = current
        try:
            spark.conf.set("spark.checkpoint.dir", current)
        except Exception:  # noqa: BLE001 - a core setting: not modifiable at run time
            pass
    try:
        spark.sparkContext.setCheckpointDir(current)
    except Exception:  # noqa: BLE001 - remote session: the setting is what it reads
        pass
    return current


_LOCAL_DIR: str | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
