"""Session defaults and the shared scratch location.

On a cluster the session is built by the platform; ``build_session`` is only a
convenience for local runs, tests and the benchmark.  ``scratch_dir`` reads the
shared folder the cluster names in ``spark.checkpoint.dir`` and falls back to a
fresh local folder only when the session has none (local mode, tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tickreport", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set one only where unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # remote (Connect) session: the server owns the folder
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("set spark.checkpoint.dir on the server for checkpoint()")
        return root
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tickreport-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, never reused sub-folder of the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")


def materialize(df):
    """Write an expensive intermediate once, as Parquet, under the shared
    checkpoint folder and read it back (lineage cut, survives executor loss,
    columns stay pruned).  Used where one table feeds two branches of a plan."""
    path = scratch_dir(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
