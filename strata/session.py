"""Session helpers: a local session for tests/bench, and the shared scratch folder.

On a cluster the scratch folder is whatever ``spark.checkpoint.dir`` names
(a shared filesystem every executor can reach). A machine-local temporary
folder is only ever used for a ``local[...]`` master where nothing is set.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "strata",
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a local session configured like the cluster profile."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        # local runs only: keep the (empty) default warehouse out of the cwd
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="strata-warehouse-"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset
    and the master is local does it fall back to a fresh temporary folder
    (tests); on a cluster an unset value is an error, because a node-local
    folder would not survive the loss of that node.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS/NFS) reachable by every executor"
            )
        configured = tempfile.mkdtemp(prefix="strata-checkpoint-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/strata/{name}-{uuid.uuid4().hex}"
