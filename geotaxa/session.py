"""Session helpers.

The library never changes an existing session's SQL settings on its own; these
helpers are for scripts, tests and the bench.  On a cluster the checkpoint
directory must be a shared folder named by ``spark.checkpoint.dir``; only when
it is unset (local tests) do we pick a local one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for the operators in this package.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "geotaxa", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.

    It comes from the session (``setCheckpointDir`` or ``spark.checkpoint.dir``).
    Only a local-mode session (tests, one machine) with none configured gets a
    folder of its own; on a cluster a missing setting is an error, because a
    machine-local folder is not visible to the other executors."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, only the session conf
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            return configured
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's "
                           "distributed file system) before running operators that checkpoint")
    local = tempfile.mkdtemp(prefix="geotaxa-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder below the cluster's shared checkpoint directory, for tables the
    jobs write and read back (never a machine-local temp folder on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def materialize(df, name: str):
    """Write ``df`` as a Parquet table in a new folder below the shared
    checkpoint directory and return the table read back.

    This cuts the lineage like ``checkpoint()`` but stays columnar: later
    reads prune columns and push filters.  The folder belongs to the returned
    frame; delete it with the rest of the checkpoint data."""
    import uuid

    spark = df.sparkSession
    path = shared_dir(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
