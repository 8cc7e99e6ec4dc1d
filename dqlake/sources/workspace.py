"""Where jobs put their written tables and stream checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session (tests) gets a temporary folder; a
    cluster must name one, because a folder of one machine would be lost with it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.gettempdir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for one run; nothing is created or cleared."""
    return f"{work_root(spark)}/dqlake/{name}-{uuid.uuid4().hex}"
