"""Session construction and shared-storage locations."""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings every job relies on: UTC for all timestamp maths, AQE for runtime
# re-planning (partition coalescing, skew-join splitting, join demotion),
# Arrow for the Python scorer path, RocksDB for streaming state.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Commit only the change log per micro-batch; snapshots are uploaded in
    # the background.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app: str = "feedlens",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """A session. When submitted (spark-submit has set a master) the submitter's
    settings win and only what is missing is added; otherwise a local one with
    ``master`` and ``shuffle_partitions``."""
    b = SparkSession.builder.appName(app)
    submitted = SparkConf()  # what spark-submit or spark-defaults.conf have set
    conf = dict(BASE_CONF)
    if not submitted.contains("spark.master"):
        b = b.master(master)
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        conf["spark.driver.memory"] = "8g"
    conf = {k: v for k, v in conf.items() if not submitted.contains(k)} | (extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``feedlens`` importable in Python workers (the scorer that runs
    under ``mapInPandas``): the package is zipped once per application on the
    driver and distributed with ``addPyFile``, the same as ``--py-files``."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="feedlens-pyfiles-"), "feedlens.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    spark.sparkContext.addPyFile(out)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints, streaming state and written tables.

    On a cluster this is the folder named by ``spark.checkpoint.dir``; only when
    it is unset (local tests) do we create one under the local temp folder."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="feedlens-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir()
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, *parts)


def stored(df, name: str):
    """``df`` written as Parquet below the shared folder and read back: cuts the
    lineage of iterative jobs, and a lost executor loses nothing of it."""
    import uuid
    path = shared_path(df.sparkSession, "steps", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
