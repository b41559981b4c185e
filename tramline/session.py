"""SparkSession construction and cluster-safe scratch locations.

The builder only fills settings that are still unset, so a cluster's own
configuration (shuffle partitions, checkpoint folder, memory) always wins.
"""

from __future__ import annotations

import itertools
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. ANSI stays on (bad casts raise; the
# operators use try_* functions where input may be dirty), AQE re-plans
# joins and coalesces small shuffle partitions at runtime, and skew-join
# splitting is on because one key may hold a large share of all rows.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "tramline",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    Library defaults only fill settings that are not set already (by
    spark-submit, the cluster's defaults or a running session); the explicit
    arguments ``master``, ``shuffle_partitions`` and ``extra`` always apply.
    """
    from pyspark import SparkConf

    explicit = dict(extra or {})
    if shuffle_partitions:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    active = SparkSession.getActiveSession()
    if active is not None:
        for key, value in DEFAULT_CONF.items():
            if active.conf.get(key, None) is None:
                _try_set(active, key, value)
        for key, value in explicit.items():
            _try_set(active, key, value)
        spark = active
    else:
        submitted = SparkConf()          # spark-submit / spark-defaults values
        builder = SparkSession.builder.appName(app_name)
        if master:
            builder = builder.master(master)
        for key, value in DEFAULT_CONF.items():
            if not submitted.contains(key):
                builder = builder.config(key, value)
        for key, value in explicit.items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _try_set(spark: SparkSession, key: str, value: str) -> None:
    try:
        spark.conf.set(key, value)
    except Exception:  # static settings cannot change on a running session
        pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, S3...)
    and is used as is. Only when it is unset (tests, local runs) do we pick a
    fresh local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tramline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A per-run path below the shared checkpoint folder (never machine-local
    on a cluster, since the folder comes from the cluster's configuration)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    # pid + counter + random part: unique even when a later run (or another
    # container) reuses the process id while the shared folder persists.
    return f"{base}/{name}-{os.getpid()}-{next(_COUNTER)}-{uuid.uuid4().hex[:12]}"


_COUNTER = itertools.count(1)   # safe to advance from several threads


def scale_settings(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20,
                   max_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a given input size and cluster.

    Shuffle partitions start at max(input / partition_bytes, 3 x cores) so a
    partition of the largest shuffle fits in an executor's memory share and
    every core has work; AQE then coalesces small partitions towards
    ``partition_bytes`` and splits skewed ones. For 100 TB on 1000 executors
    x 8 cores this gives about 400,000 initial partitions of 256 MB.
    """
    n = max(input_bytes // partition_bytes, 3 * total_cores, 1)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(max_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def materialize(df, name: str):
    """Write ``df`` as parquet below the shared checkpoint folder and read it
    back: lineage is cut (a lost executor does not recompute the upstream
    plan) and, unlike ``checkpoint()``'s serialized rows, later passes read
    only the columns they use."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
