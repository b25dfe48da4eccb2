"""Folders for intermediate tables, in the shared place that the session names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share; it goes when the session ends.

    Only where the setting is missing in a session of one machine, as in tests, a local folder takes its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir is not set, and executors share no local folder")
        root = "file://" + tempfile.mkdtemp(prefix="spark-scratch-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(jvm_path)
    return path
