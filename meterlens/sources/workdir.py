from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for written results and stream state.

    It lies in the shared folder named by ``spark.checkpoint.dir``. Only a local
    session without that setting gets a temporary folder.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    shared = shared or spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
