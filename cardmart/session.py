"""SparkSession construction and session-scoped settings.

Every job in the package takes a ``SparkSession`` argument; this module only
supplies a sensible one for tests, the bench and command-line use.  On a real
cluster the session comes from the platform and ``get_spark`` just returns the
active one, adding nothing but the settings the package relies on for
correctness (UTC session clock).
"""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that change results, so they are enforced on any session we are given.
_CORRECTNESS_CONF = {
    # Timestamp columns are TIMESTAMP_NTZ; pin the session clock so that
    # current_timestamp() casts and date arithmetic do not depend on the host.
    "spark.sql.session.timeZone": "UTC",
}

# Settings for performance; applied only when we build the session ourselves.
_BUILD_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Broadcast joins only below this runtime-measured size (AQE re-checks
    # the real shuffle output size before converting a join).
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.shuffle.partitions": "8",
    # A long-running driver (pipeline runs, streams, benches) should release the
    # broadcasts and shuffle files of finished jobs well before the 30 min default.
    "spark.cleaner.periodicGC.interval": "60s",
}


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 128 * 1024 * 1024,
                           cores: int | None = None) -> int:
    """Initial shuffle partition count for a job reading ``input_bytes``.

    Roughly one partition per ``target_bytes`` of shuffled data (so a task's
    partition fits in executor memory and spills little), at least two waves
    of the cluster's cores.  AQE then coalesces small partitions at runtime
    (``spark.sql.adaptive.coalescePartitions``) and splits skewed ones, so
    this is an upper bound, not a fixed plan: at 100 TB with 1,000 executors x
    8 cores it gives ~800k partitions, which AQE reduces to what the actual
    shuffle sizes need.
    """
    by_size = max(1, -(-input_bytes // target_bytes))
    return max(by_size, 2 * (cores or 1))


def get_spark(master: str | None = None, app_name: str = "cardmart",
              shuffle_partitions: int | None = None,
              extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Return the active session (cluster) or build a local one (tests, bench)."""
    active = SparkSession.getActiveSession()
    if active is not None and master is None:
        spark = active
    else:
        builder = SparkSession.builder.appName(app_name)
        builder = builder.master(master or os.environ.get("CARDMART_MASTER", "local[*]"))
        conf = dict(_BUILD_CONF)
        conf.update(_CORRECTNESS_CONF)
        if shuffle_partitions is not None:
            conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        conf.setdefault("spark.driver.memory", "8g")
        if extra_conf:
            conf.update(extra_conf)
        for k, v in conf.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    for k, v in _CORRECTNESS_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``cardmart`` importable on every Python worker (``addPyFile``, once per context).

    Python functions that Spark runs on executors (Arrow UDFs, ``mapInPandas``)
    may refer to functions of this package by module name; shipping the package
    as a zip is what ``spark-submit --py-files`` does, done at runtime.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="cardmart-pyfiles-")) / "cardmart"
    archive = shutil.make_archive(str(out), "zip", root_dir=pkg.parent, base_dir=pkg.name)
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the platform sets it to a shared (distributed) folder and we
    only read it.  Only when it is unset -- local tests and the bench -- do we
    create a private scratch folder and register it with the SparkContext.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 -- not visible through the session conf
            configured = None
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    current = tempfile.mkdtemp(prefix="cardmart-ckpt-")
    sc.setCheckpointDir(current)
    return current


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables."""
    return ensure_checkpoint_dir(spark)
