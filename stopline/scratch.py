"""Where intermediate tables are written."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def run_folder(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, in the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local session, where driver and executors are one
    machine, may do without it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="stopline-")
    return f"{base.rstrip('/')}/{label}-{uuid4().hex}"
