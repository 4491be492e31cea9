"""Session settings and the shared scratch location.

Jobs never pick a machine-local folder on their own: intermediate files (the JSON
input of a streaming run, checkpoints, snapshots) go below the shared folder the
cluster names in ``spark.checkpoint.dir``.  A local master may leave it unset and
gets a temporary folder; on a cluster that is an error.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    master: str | None = None,
    app_name: str = "trailmark",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local/test session with the settings the library assumes.

    On a cluster, ``spark-submit`` owns master, memory and partition counts; this
    helper is for tests, the bench and single-machine runs.
    """
    cpus = os.cpu_count() or 4
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # small shuffles keep some parallelism instead of collapsing into one task
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        .config("spark.driver.memory", os.environ.get("TRAILMARK_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Event time is an instant; rendered wall-clock values are UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster; a local master may leave it unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current.rstrip("/")
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    # one machine (tests, a laptop): a folder of our own, once per session
    local = tempfile.mkdtemp(prefix="trailmark-chk-")
    if sc is None:
        spark.conf.set("spark.checkpoint.dir", local)
        return local
    sc.setCheckpointDir(local)
    return (sc.getCheckpointDir() or local).rstrip("/")


#: The scratch folder of this driver process for each checkpoint root.
_RUNS: dict[str, str] = {}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the checkpoint root (never reused).

    All folders of a driver process lie in one, which ``remove_scratch`` deletes; it is deleted at the end of the
    process if its session is still there.
    """
    root = checkpoint_root(spark)
    if root not in _RUNS:
        _RUNS[root] = f"{root}/trailmark/run-{uuid.uuid4().hex}"
        if len(_RUNS) == 1:
            atexit.register(_remove_at_exit)
    return f"{_RUNS[root]}/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the cluster's file system."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(there, True)


def remove_scratch(spark: SparkSession) -> None:
    """Delete this process's scratch tables.  Call it once the results that read them have been written."""
    run = _RUNS.pop(checkpoint_root(spark), None)
    if run is not None:
        remove_path(spark, run)


def _remove_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        remove_scratch(spark)
