"""Session helpers: a tuned local session for tests/bench and a shared
scratch location taken from ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every casekit job relies on.  ANSI stays at Spark's default; the
# operators use try_cast where a bad value must become NULL.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(executors: int = 1000, cores_per_executor: int = 8) -> dict[str, str]:
    """Settings for a large cluster (pass to ``spark-submit --conf`` or the builder).

    Shuffle width starts high and AQE coalesces it to ~256 MB partitions, so
    one setting serves jobs of any size; skewed partitions (one case number or
    one date holding a third of the rows) are split by AQE's skew join; scan
    splits of 256 MB keep task counts manageable on 100 TB inputs.
    """
    cores = executors * cores_per_executor
    return {
        **{k: v for k, v in RECOMMENDED_CONF.items() if k != "spark.ui.enabled"},
        "spark.sql.shuffle.partitions": str(4 * cores),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(4 * cores),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "casekit", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (never used by library code)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set: executors and driver share no local folder,
    and a restarted stream must find its checkpoint again.  Only a local
    session (tests, a notebook) gets a folder of its own if it is unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and spark.conf.get("spark.master", "").startswith("local"):
        if not spark.conf.get("spark.master").startswith("local-cluster"):
            root = tempfile.mkdtemp(prefix="casekit-ckpt-")
            spark.conf.set("spark.checkpoint.dir", root)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the checkpoint root for one run."""
    return f"{checkpoint_root(spark)}/casekit/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def state_partitions(spark: SparkSession, n: int | None = None) -> Iterator[int]:
    """Number of state partitions for stateful streaming queries started inside.

    A streaming query takes its state partition count from
    ``spark.sql.shuffle.partitions`` when it first starts and keeps it in its
    checkpoint for good; size it to the state (cluster cores for large state,
    a handful for small).  Default: the default parallelism.
    """
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    if not n:
        try:
            n = spark.sparkContext.defaultParallelism
        except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect)
            n = int(old)
    spark.conf.set(key, str(n))
    try:
        yield n
    finally:
        spark.conf.set(key, old)
