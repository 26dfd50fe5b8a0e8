"""Tables between steps of a loop, and where they are kept."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _shared(spark: SparkSession) -> str:
    """The checkpoint folder that the driver and all executors share; under a local master one of its own if none is set."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="stage-"))
    return sc.getCheckpointDir()


def saved(df: DataFrame) -> DataFrame:
    """df, written to the checkpoint folder and read back, so that plans don't grow."""
    _shared(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path below the checkpoint folder."""
    return f"{_shared(spark)}/{name}-{uuid.uuid4().hex}"


def merged(df: DataFrame) -> DataFrame:
    """df as a side of a join that is never broadcast, so that the driver doesn't get what grows with the data."""
    return df.hint("merge")


def spread(df: DataFrame, rows: int = 1000) -> DataFrame:
    """df over tasks of about `rows` rows, for work that follows the rows and not the bytes that a reader deals by. The rows
    are counted and moved: spread what is read, before it is made longer."""
    return df.repartition(max(1, -(-df.count() // rows)))


class Files:
    """Small files and folders of any file system that Spark reads."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._path = jvm.org.apache.hadoop.fs.Path
        self._bytes = jvm.org.apache.commons.io.IOUtils.toByteArray
        self._fs = self._path(root).getFileSystem(conf)

    def put(self, path: str, text: str) -> None:
        """A new file, there at once or not at all; an error if there is one already."""
        own = self._path(f"{path}.{uuid.uuid4().hex}.part")
        out = self._fs.create(own, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self._fs.exists(self._path(path)) or not self._fs.rename(own, self._path(path)):
            self._fs.delete(own, False)
            raise FileExistsError(path)

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(self._bytes(stream)).decode()
        finally:
            stream.close()

    def names(self, folder: str) -> list[str]:
        """The names in a folder; none if it isn't there."""
        at = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def size(self, path: str) -> int:
        """Bytes below a path; 0 if it isn't there."""
        at = self._path(path)
        return self._fs.getContentSummary(at).getLength() if self._fs.exists(at) else 0

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
