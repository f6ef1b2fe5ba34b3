"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the folder named by ``spark.checkpoint.dir``.

    Only a local master may go without that setting; a cluster's executors share no local disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="gustline-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
