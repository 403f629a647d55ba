"""SparkSession helpers: the configuration every job in this package assumes."""

from __future__ import annotations

import os
import tempfile
import threading
import zipfile

from pyspark.sql import SparkSession

# Wall-clock minutes carry no zone; pin the session zone so date_format/date_trunc agree
# with the engines we compare against.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # Tables bucketed by broadcast and product are joined on these and more keys as they lie.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "stockout", warehouse_dir: str | None = None) -> SparkSession:
    """Session for tests, the bench and local runs. On a cluster, pass the cluster's
    master and leave ``spark.checkpoint.dir`` to the cluster configuration."""
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    if warehouse_dir is not None:
        builder = builder.config("spark.sql.warehouse.dir", warehouse_dir)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("STOCKOUT_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application, so that
    functions running there can be imported whatever the workers' own path is."""
    app = spark.sparkContext.applicationId
    with _SHIP_LOCK:
        if app in _SHIPPED:
            return
        package = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="stockout-py-"), "stockout_package.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, names in sorted(os.walk(package)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(package)))
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(app)


_LOCAL_FALLBACK: dict[str, str] = {}
_FALLBACK_LOCK = threading.Lock()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for checkpoints and written stages.

    Taken from ``spark.checkpoint.dir`` (the cluster's shared folder), else from a
    checkpoint folder already set on the context. Only on a local master (tests) is a scratch
    folder created when neither exists; on a cluster, where executors share no local folder,
    that is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = sc.applicationId
    with _FALLBACK_LOCK:
        if app not in _LOCAL_FALLBACK:
            _LOCAL_FALLBACK[app] = tempfile.mkdtemp(prefix="stockout-ckpt-")
            sc.setCheckpointDir(_LOCAL_FALLBACK[app])
    return sc.getCheckpointDir() or _LOCAL_FALLBACK[app]
