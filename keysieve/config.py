"""Where jobs may write intermediate data.

Intermediate tables go to the shared folder the cluster names in
``spark.checkpoint.dir``. A session without one gets a local folder only where
driver and executors share it (a local master); on a cluster that is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint directory; a local one is set only if it has
    none and everything runs in one process."""
    d = spark.sparkContext.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if d:
            spark.sparkContext.setCheckpointDir(d)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="keysieve-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint directory."""
    return f"{checkpoint_dir(spark)}/keysieve/{name}-{uuid.uuid4().hex}"
