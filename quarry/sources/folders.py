"""Folders of many files, listed and read by tasks, so that the driver holds nothing for a file."""

from __future__ import annotations

import os
import posixpath
import re
from collections.abc import Iterable, Iterator
from itertools import islice
from urllib.parse import quote

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import MAX_BATCH_BYTES, ship_package

# Spark's file sources hold about a KB for each file on the driver; a folder of more files is listed by a task.
MANY_FILES = 1_000
LISTED_ROWS = 10_000

LISTED = pa.schema([("filename", pa.string()), ("uri_name", pa.string()), ("length", pa.int64())])


def hidden(name: str) -> bool:
    """Whether Spark's file sources leave a file out when they list a folder."""
    if name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def uri_name(name: str) -> str:
    """A file name as it stands in a URI, and so in ``_metadata.file_name``: letters of all alphabets are kept."""
    return re.sub(r"[^A-Za-z0-9_.!~'()*:@&=+$,;\-\x80-\U0010ffff]|[\s\x7f-\x9f]", lambda sign: quote(sign[0], safe=""), name)


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def entries(files: fs.FileSystem, folder: str) -> Iterator[tuple[str, int]]:
    """Names and lengths of the files of a folder, not of those below it.

    A local folder is read entry by entry; of other stores the whole list is held by the task.
    """
    if isinstance(files, fs.LocalFileSystem):
        found: Iterable[tuple[str, int]] = _local_entries(folder)
    else:
        found = ((i.base_name, i.size) for i in files.get_file_info(fs.FileSelector(folder)) if i.is_file)
    for name, length in found:
        if not hidden(name):
            # Spark lists what begins like a Parquet summary, but never reads it.
            yield name, 0 if name.startswith("_") and "=" not in name else length


def _local_entries(folder: str) -> Iterator[tuple[str, int]]:
    with os.scandir(folder) as found:
        for entry in found:
            try:
                entry.name.encode()
                if entry.is_file():
                    yield entry.name, entry.stat().st_size
            except (UnicodeEncodeError, FileNotFoundError):  # Spark sees no file under a name that is not UTF-8, or gone since
                continue


class Folder:
    """A flat folder, as a path or URI that Spark knows."""

    def __init__(self, spark: SparkSession, folder: str):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        self.spark, self.files = spark, path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.folder = self.files.makeQualified(path)
        self.uri = self.folder.toUri().toString()

    @property
    def path(self) -> str:
        """What stands before the names in the paths of Spark's file sources."""
        return self.folder.toString().rstrip("/") + "/"

    def has_many(self) -> bool:
        """Whether it has more than ``MANY_FILES`` entries and tasks can list it themselves; only so many are looked at."""
        try:
            files, folder = opened(self.uri)
        except (OSError, pa.ArrowException):  # a store that only Spark reads
            return False
        if isinstance(files, fs.LocalFileSystem):
            if not os.path.isdir(folder):
                return False
            with os.scandir(folder) as found:
                return _more_than(MANY_FILES, found)
        try:
            return self.files.getFileStatus(self.folder).isDirectory() and _more_than(MANY_FILES, self._listed())
        except Py4JJavaError:  # a pattern, or nothing: left to Spark
            return False

    def _listed(self) -> Iterator[object]:
        found = self.files.listStatusIterator(self.folder)
        while found.hasNext():
            yield found.next()

    def list(self) -> DataFrame:
        """(filename, uri_name, length) of its files, listed by one task whenever the rows are asked for."""
        ship_package(self.spark)
        uri = self.uri

        def listed(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = entries(*opened(uri))
            while some := [(name, uri_name(name), length) for name, length in islice(found, LISTED_ROWS)]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), LISTED.types)], schema=LISTED)

        return self.spark.range(0, 1, 1, 1).mapInArrow(listed, "filename string, uri_name string, length long")

    def matching(self, pattern: str) -> Column:
        """Whether the file name has a pattern of Hadoop's."""
        compiled = self.spark._jvm.org.apache.hadoop.fs.GlobPattern.compile(pattern).pattern()
        return F.col("filename").rlike(rf"(?s)\A(?:{compiled})\z")

    def read(self, listed: DataFrame, wanted: Column) -> DataFrame:
        """Files of ``list`` with their ``content``, null where not ``wanted``; dealt by name to as many tasks as a shuffle has."""
        uri = self.uri
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = listed.withColumn("wanted", F.coalesce(wanted, F.lit(False))).repartition(tasks, "filename")
        schema = dealt.drop("wanted").schema.add("content", "binary")

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            files, folder = opened(uri)
            for batch in batches:
                yield from with_contents(files, folder, batch)

        return dealt.mapInArrow(read, schema)


def _more_than(n: int, found: Iterable[object]) -> bool:
    return sum(1 for _ in islice(found, n + 1)) > n


def with_contents(files: fs.FileSystem, folder: str, batch: pa.RecordBatch, most: int = MAX_BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch with ``content`` in place of ``wanted``, in batches of ``most`` bytes or one file."""
    given = batch.drop_columns("wanted")
    names, lengths, wanted = (batch.column(c).to_pylist() for c in ("filename", "length", "wanted"))
    begin, size, contents = 0, 0, []

    def made() -> pa.RecordBatch:
        return given.slice(begin, len(contents)).append_column("content", pa.array(contents, pa.binary()))

    for name, length, wants in zip(names, lengths, wanted):
        if wants:
            if size and size + length > most:
                yield made()
                begin, size, contents = begin + len(contents), 0, []
            with files.open_input_file(posixpath.join(folder, name)) as file:
                contents.append(file.read())
            size += len(contents[-1])
        else:
            contents.append(None)
    if contents:
        yield made()
