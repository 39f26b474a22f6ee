"""Where jobs put data that only has to outlive one run."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def new_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory name under the shared folder the cluster names.

    Without that setting a local temporary folder serves, but only on a local
    master: executors on other machines could not see it.
    """
    shared = spark.conf.get(SETTING, None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder that all executors can reach")
        shared = tempfile.mkdtemp(prefix="forecourt-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
