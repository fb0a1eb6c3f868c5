"""Texts in a folder that Hadoop's file systems reach: what stands beside a checkpoint or a table."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Store:
    """Texts by name in a folder that Hadoop's file systems reach."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _open(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def write(self, name: str, text: str) -> None:
        """Under another name first, so that a text is there in full or as it was."""
        (made, fs), (path, _) = self._open(f"_{name}"), self._open(name)
        out = fs.create(made, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        hadoop, gateway = self.spark.sparkContext._jvm.org.apache.hadoop.fs, self.spark.sparkContext._gateway
        over = gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
        over[0] = getattr(hadoop, "Options$Rename").OVERWRITE
        hadoop.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(made, path, over)

    def read(self, name: str) -> str | None:
        path, fs = self._open(name)
        if not fs.exists(path):
            return None
        source = fs.open(path)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def delete(self, name: str) -> None:
        path, fs = self._open(name)
        fs.delete(path, False)

    def names(self) -> list[str]:
        path, fs = self._open("")
        found = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(n for n in found if n[:1] not in "._")
