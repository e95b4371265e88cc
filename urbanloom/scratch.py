"""Working folders on storage that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


@cache
def _test_root() -> str:
    return tempfile.mkdtemp(prefix="urbanloom-")


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only where none is
    named, as in tests."""
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if not named and not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError(f"{CHECKPOINT_SETTING} must name a folder that all executors share")
    return (named or _test_root()).rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_root(spark)}/urbanloom/{label}-{uuid.uuid4().hex}"
