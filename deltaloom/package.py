"""Sends this package to the executors, whose Python need not have it installed."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession | None = None) -> None:
    """Adds the package to the Spark context's files, once; to be called before a Python function of it is used."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None or getattr(spark.sparkContext, "_deltaloom_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="deltaloom-")) / "deltaloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    spark.sparkContext._deltaloom_shipped = True


def scratch(spark: SparkSession) -> str:
    """A fresh path in the folder that the cluster shares (spark.checkpoint.dir), deleted when the driver's JVM ends. Only
    where that is unset and the master is local, as in tests, it is a temporary folder."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="deltaloom-"))
        root = context.getCheckpointDir()
    path = context._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/deltaloom-{uuid.uuid4().hex}")
    path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
    return str(path)
