"""Session-level helpers: the shared folder for checkpoints and written tables.

On a cluster the folder is named by ``spark.checkpoint.dir`` and must be a
shared file system (HDFS, object store, NFS).  Only when it is unset *and* the
session runs in local mode (tests, the bench) do we pick a local folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CONF_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root, making sure the context uses it."""
    sc = spark.sparkContext
    root = sc.getConf().get(_CONF_KEY, None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            # setCheckpointDir appends a per-application folder; keep its parent.
            root = current.rstrip("/").rsplit("/", 1)[0]
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"{_CONF_KEY} is not set: name a shared folder for checkpoints "
                "and intermediate tables before running on a cluster"
            )
        root = tempfile.mkdtemp(prefix="labelkit-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never reused)."""
    return f"{shared_dir(spark).rstrip('/')}/labelkit/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder through Spark's file system; False if there was none."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def local_session(cores: int = 8, app: str = "labelkit") -> SparkSession:
    """Session for tests and the bench: local mode, AQE on, UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark
