"""Parquet tables in buckets of a key: a batch rewrites the buckets it falls into, and no others."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
# Tries of a writer whose buckets another writer has changed meanwhile.
TRIES = 10
# Keys that are looked for by value inside the files.
MAX_LISTED_KEYS = 10_000


# The column that names a row's bucket, where it is asked for.
BUCKET = "_bucket"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class ConcurrentWrite(RuntimeError):
    """Another writer was faster."""


@dataclass(frozen=True)
class Manifest:
    """Which folder holds each bucket in one version of the table; None: the bucket is empty."""

    number: int
    folders: tuple[str | None, ...]


class BucketedTable:
    """A table of one row per key, its rows dealt to buckets by the hash of the key.

    ``data/<write>/_bucket=<n>`` holds what one write put into one bucket; ``manifest/<number>.json`` names the folder of
    every bucket.  Files are never changed.  A new manifest is created under a number that must not exist, so a version is
    seen as a whole or not at all, and of two writers one is told that it was late: it writes again only if the
    other changed a bucket of its own.  Readers keep the files of their manifest until ``clean_up``.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.buckets = key, buckets

    # -- reading ------------------------------------------------------------------

    def exists(self) -> bool:
        return self.manifest() is not None

    def read(self) -> DataFrame:
        return self._rows(self._present().folders)

    def read_with_bucket(self) -> DataFrame:
        """All rows with their bucket, a column by whose values folders are passed by.

        One part per write that is still in force; ``compact`` makes them one.
        """
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        by_write: dict[str, list[str]] = {}
        for folder in filter(None, self._present().folders):
            by_write.setdefault(folder.split("/")[0], []).append(f"{self.path}/data/{folder}")
        table = None
        for write, paths in sorted(by_write.items()):
            rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/data/{write}").parquet(*paths)
            table = rows if table is None else table.unionByName(rows)
        return self.spark.createDataFrame([], schema) if table is None else table

    def read_keys(self, keys: DataFrame) -> DataFrame:
        """The rows whose key is in the first column of ``keys``.

        Only the buckets of these keys are listed and read (their numbers come to the driver, no more than there are
        buckets); inside the files, which are sorted by key, few keys are looked for by value.
        """
        manifest = self._present()
        wanted = keys.select(F.col(keys.columns[0]).alias(self.key)).distinct()
        listed = wanted.limit(MAX_LISTED_KEYS + 1).withColumn("_bucket", self._bucket(len(manifest.folders))).collect()
        if len(listed) <= MAX_LISTED_KEYS:
            rows = self._rows(tuple(manifest.folders[b] for b in sorted({r["_bucket"] for r in listed})))
            return rows.filter(F.col(self.key).isin([r[self.key] for r in listed]))
        buckets = wanted.select(self._bucket(len(manifest.folders)).alias("b")).distinct().collect()
        rows = self._rows(tuple(manifest.folders[r["b"]] for r in buckets))
        return rows.join(wanted, self.key, "left_semi")

    def manifest(self) -> Manifest | None:
        """The last whole one."""
        for number in reversed(self._numbers()):
            found = self._load(number)
            if found is not None:
                return found
        return None

    # -- writing ------------------------------------------------------------------

    def clear(self) -> None:
        """An empty version; a new table if there is none."""
        self._commit(self._last_number(), (None,) * self.buckets)

    def replace(self, rows: DataFrame) -> None:
        """A version that holds just ``rows``, one of each key, in the number of buckets this table was opened with."""
        before = self._last_number()
        placed = rows.select(*self.schema.names).withColumn("_bucket", self._bucket(self.buckets))
        written = self._write(placed.repartition("_bucket").sortWithinPartitions("_bucket", self.key))
        self._commit(before, tuple(written.get(b) for b in range(self.buckets)))

    def compact(self) -> None:
        """All rows in new files, one write; also the way to another number of buckets."""
        self.replace(self.read())

    def merge(self, rows: DataFrame, order: list[Column]) -> list[int]:
        """Put rows in, for keys that are there in place of the old ones; of several with one key the last in ``order`` counts.

        Returns the buckets rewritten.  ``rows`` is looked at several times and should be a stored table.
        """
        for _ in range(TRIES):
            base = self._present()
            n = len(base.folders)
            bucket = self._bucket(n)
            touched = sorted(r["b"] for r in rows.select(bucket.alias("b")).distinct().collect())
            if not touched:
                return []
            old = self._rows(tuple(base.folders[b] for b in touched)).withColumns({"_new": F.lit(0), "_order": F.lit(0)})
            ranked = W.partitionBy(self.key).orderBy(*[c.desc() for c in order])
            new = rows.withColumn("_order", F.row_number().over(ranked)).filter("_order = 1").withColumn("_new", F.lit(1))
            columns = [*self.schema.names, "_new"]
            both = old.select(*columns).unionByName(new.select(*columns)).withColumn("_bucket", bucket)
            # One shuffle of the touched buckets; it also brings the rows of a key together.
            first = W.partitionBy("_bucket", self.key).orderBy(F.col("_new").desc())
            merged = both.repartition("_bucket").withColumn("_nth", F.row_number().over(first)).filter("_nth = 1")
            written = self._write(merged.drop("_new", "_nth"))
            try:
                self._commit_buckets(base, written)
            except ConcurrentWrite:
                continue
            return touched
        raise ConcurrentWrite(f"{self.path} was changed by others {TRIES} times")

    def clean_up(self, keep: int = 1) -> None:
        """Delete all but the last ``keep`` versions; no reader may still be at work on them."""
        numbers = self._numbers()
        kept = [m for m in map(self._load, numbers) if m is not None][-max(1, keep) :]
        if not kept:
            return
        used = {folder for m in kept for folder in m.folders}
        for number in numbers:
            if number < kept[0].number:
                self._delete(self._manifest_path(number))
        for write in self._names(f"{self.path}/data"):
            folders = [f"{write}/{name}" for name in self._names(f"{self.path}/data/{write}") if name.startswith("_bucket=")]
            unused = [f for f in folders if f not in used]
            for folder in [write] if len(unused) == len(folders) else unused:
                self._delete(f"{self.path}/data/{folder}")

    def recover(self) -> None:
        """Remove the manifest of a writer that died while it wrote it; none may still be at work."""
        last = self._last_number()
        if last and self._load(last) is None:
            self._delete(self._manifest_path(last))

    def drop(self) -> None:
        self._delete(self.path)

    # -- files --------------------------------------------------------------------

    def _bucket(self, n: int) -> Column:
        return bucket_of(self.key, n)

    def _rows(self, folders: tuple[str | None, ...]) -> DataFrame:
        paths = [f"{self.path}/data/{folder}" for folder in folders if folder]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _write(self, rows: DataFrame) -> dict[int, str]:
        """The folder of each bucket that has rows."""
        write = uuid.uuid4().hex
        rows.select(*self.schema.names, "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/data/{write}")
        names = [n for n in self._names(f"{self.path}/data/{write}") if n.startswith("_bucket=")]
        return {int(n.split("=")[1]): f"{write}/{n}" for n in names}

    def _commit_buckets(self, base: Manifest, written: dict[int, str]) -> None:
        """A manifest with these buckets new, unless one of them has changed since ``base``."""
        while True:
            now = self._present()
            if len(now.folders) != len(base.folders) or any(now.folders[b] != base.folders[b] for b in written):
                raise ConcurrentWrite(self.path)
            try:
                folders = tuple(written.get(b, folder) for b, folder in enumerate(now.folders))
                return self._commit(now.number, folders)
            except ConcurrentWrite:
                continue

    def _commit(self, before: int, folders: tuple[str | None, ...]) -> None:
        last = self._last_number()
        if last and self._load(last) is None:
            raise ConcurrentWrite(f"manifest {last} of {self.path} is not whole; if its writer died, call recover()")
        if last != before:
            raise ConcurrentWrite(self.path)
        files, path = self._files(self._manifest_path(before + 1))
        try:
            stream = files.create(path, False)
        except Py4JJavaError as error:
            if "AlreadyExists" in str(error.java_exception):
                raise ConcurrentWrite(self.path) from None
            raise
        stream.write(bytearray(json.dumps({"folders": folders}).encode()))
        stream.close()

    def _present(self) -> Manifest:
        found = self.manifest()
        if found is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return found

    def _load(self, number: int) -> Manifest | None:
        files, path = self._files(self._manifest_path(number))
        stream = files.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return Manifest(number, tuple(json.loads(text)["folders"]))
        except (ValueError, KeyError):
            return None

    def _manifest_path(self, number: int) -> str:
        return f"{self.path}/manifest/{number:010d}.json"

    def _numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names(f"{self.path}/manifest") if n.endswith(".json"))

    def _last_number(self) -> int:
        return max(self._numbers(), default=0)

    def _names(self, folder: str) -> list[str]:
        files, path = self._files(folder)
        return [e.getPath().getName() for e in files.listStatus(path)] if files.exists(path) else []

    def _delete(self, path: str) -> None:
        files, folder = self._files(path)
        files.delete(folder, True)

    def _files(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder
