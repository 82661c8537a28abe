"""Session helpers.

The library never creates or stops a session inside an operator; callers own
the ``SparkSession``. The two helpers here are for scripts and tests:

* ``local_session`` builds the ``local[N]`` session used by tests and bench.
* ``checkpoint_dir`` returns the shared folder named in ``spark.checkpoint.dir``
  (set by the cluster); only a local session without the setting gets one of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quillon") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session, as ``spark.checkpoint.dir`` names it.

    Where the setting is absent, a session on one machine (local master, as in tests) gets a
    folder of its own; anywhere else it is an error, as other machines could not see one.
    """
    context = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="quillon-ckpt-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path


def staging_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/quillon-staging/{name}-{uuid.uuid4().hex[:12]}"


def reliable_checkpoint(df):
    """Cut lineage by a reliable checkpoint into the shared folder (never a local one)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
