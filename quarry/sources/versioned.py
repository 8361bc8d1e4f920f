"""Parquet tables that are replaced as a whole, and never seen half written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class VersionedTable:
    """A table in numbered folders of which the highest finished one counts.

    A folder is finished when Spark has written its ``_SUCCESS`` file, so a job that dies
    leaves the version before it in force.  A new version may be computed from the one in
    force.  Old versions stay readable until ``clean_up``.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def exists(self) -> bool:
        return self._version() is not None

    def read(self) -> DataFrame:
        version = self._version()
        if version is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return self.spark.read.schema(self.schema).parquet(self._folder(version))

    def replace(self, table: DataFrame) -> None:
        # Past any folder that a dead job left; if another writer takes the same number, one of the two is told.
        following = max(self._numbers(), default=0) + 1
        table.select(*self.schema.names).write.mode("error").parquet(self._folder(following))

    def clean_up(self, keep: int = 1) -> None:
        """Delete all but the last ``keep`` versions; no reader may still be at work on them."""
        files, folder = self._files(self.path)
        force = self._version()
        for entry in files.listStatus(folder) if force is not None else ():
            name = entry.getPath().getName()
            if name.startswith("version=") and int(name.split("=")[1]) <= force - max(1, keep):
                files.delete(entry.getPath(), True)

    def clear(self) -> None:
        self.replace(self.spark.createDataFrame([], self.schema))

    def drop(self) -> None:
        files, folder = self._files(self.path)
        files.delete(folder, True)

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version:08d}"

    def _files(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def _numbers(self) -> list[int]:
        files, folder = self._files(self.path)
        names = [entry.getPath().getName() for entry in files.listStatus(folder)] if files.exists(folder) else []
        return [int(n.split("=")[1]) for n in names if n.startswith("version=")]

    def _version(self) -> int | None:
        files = self._files(self.path)[0]
        numbers = sorted(self._numbers(), reverse=True)
        finished = (n for n in numbers if files.exists(self._files(f"{self._folder(n)}/_SUCCESS")[1]))
        return next(finished, None)
