"""Fresh folders for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Kept so that local folders live until the interpreter exits and go with it.
_LOCAL_FOLDERS: list[tempfile.TemporaryDirectory] = []


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder path under ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a temporary folder; a cluster has
    no folder its executors share by default, so there it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.TemporaryDirectory(prefix=f"siltbed-{label}-", ignore_cleanup_errors=True)
    _LOCAL_FOLDERS.append(folder)
    return folder.name
