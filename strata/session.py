"""Session helpers.

The library never owns the cluster configuration: it reads what the
session says and only fills in settings that are unset (tests, bench).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every query in this package relies on for correct results.
REQUIRED_CONF = {
    # Source tables hold UTC wall time as TIMESTAMP_NTZ; date_trunc and
    # casts between NTZ and LTZ must not shift them.
    "spark.sql.session.timeZone": "UTC",
}

# Settings that are good defaults for a local session; a cluster's own
# values win because we only set them when the builder creates the session.
LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings the plans assume on a large cluster (about 100 TB of input,
# 1000 executors). The library never applies them itself: the cluster's
# operator does, with values sized for its hardware.
SCALE_RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # large initial shuffle width, merged back by AQE to ~256 MB partitions
    "spark.sql.shuffle.partitions": "65536",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "512m",
    # broadcast only what AQE measures below this size
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    # bounded hot-key handling of the ordered windows (strata.operators.sequence)
    "spark.strata.sequence.hotRows": "4000000",
    "spark.strata.sequence.segmentRows": "1000000",
    # streaming state (open candle windows) off the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "strata", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**LOCAL_DEFAULTS, **REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator to a shared filesystem; we
    only pick a local scratch folder when nothing is configured (tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):  # executors and driver share no local folder
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediates."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "strata", name) if "://" not in base else f"{base.rstrip('/')}/strata/{name}"
