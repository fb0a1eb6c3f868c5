"""What the operators of this subpackage share: scratch tables, packed arrays and column hygiene."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import threading
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from deltaloom import package

#: Separators of words: space and the ASCII controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")


#: Rows in a batch between Spark and Python: ten thousand, the default, of long texts fill both sides' memory.
BATCH_ROWS, BATCH_KEY = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for as long as this lasts."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def ship(spark: SparkSession) -> None:
    """Makes the package known to the executors, and batches modest unless their size has been set."""
    package.ship(spark)
    if spark.conf.get(BATCH_KEY) == "10000" and not spark.sparkContext.getConf().contains(BATCH_KEY):
        spark.conf.set(BATCH_KEY, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own = threading.local()


def made_paths() -> list[str]:
    """Paths of this thread's scratch tables in the order of their making, for those who want them gone."""
    if not hasattr(_own, "paths"):
        _own.paths = []
    return _own.paths


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Deletes scratch tables, whose readers must be done."""
    for text in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch(spark: SparkSession) -> str:
    """A fresh path in the folder that the cluster shares (spark.checkpoint.dir).

    Only where that setting is absent and the master is local, as in tests, a temporary folder is set as the checkpoint
    folder. What is still there when the driver's JVM ends is deleted then."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="deltaloom-"))
        root = context.getCheckpointDir()
    made = f"{root.rstrip('/')}/deltaloom-{uuid.uuid4().hex}"
    made_paths().append(made)
    path = context._jvm.org.apache.hadoop.fs.Path(made)
    path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
    return made


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """The rows of df as a Parquet table in the shared folder, so that later steps neither compute them again nor
    lose them with an executor."""
    ship(df.sparkSession)
    path = path or scratch(df.sparkSession)
    with setting(df.sparkSession, CLEANUP_KEY, "true"):  # what the rows were shuffled by isn't needed once they are written
        df.write.mode("overwrite").option("parquet.block.size", 32 << 20).parquet(path)  # rows may be large: small row groups
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_parts(rows: DataFrame, parts: int, per_task: int = 16) -> GroupedData:
    """rows (with part, from 0) grouped by part, parts dealt out evenly: about per_task to a task, or fewer where the session has
    more shuffle partitions, so a task's share doesn't grow with the input."""
    tasks = max(1, min(parts, max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-parts // per_task))))
    return rows.withColumn("task", (F.col("part") % tasks).cast("int")).repartitionById(tasks, "task").groupBy("task", "part")


def learned_from(key: Column, mod: int, held: int) -> Column:
    """Whether crc32 of the key as text leaves another remainder than held; rows without a key are learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % mod != held, F.lit(True))


def crc_of(key: object) -> int:
    return zlib.crc32(str(key).encode())


def lower_ascii(raw: bytes) -> bytes:
    """A-Z to a-z and nothing else (bytes.lower leaves other bytes alone)."""
    return raw.lower()


def utf8(text: object) -> bytes:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def release() -> None:
    """Gives freed memory back to the system: Python workers stay, idle, for the next task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def chunks(frames: Iterator, rows: int = 256) -> Iterator:
    """Record batches cut into slices of at most so many rows, which bounds what one step holds in memory."""
    for batch in frames:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    release()



def starts_of(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out
