"""A data source that writes rows as whole files, one per file name, in a folder that all workers reach."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

TEMPORARY, DONE = "_temporary", "_SUCCESS"


@dataclass
class Written(WriterCommitMessage):
    files: int


class WholeFiles(DataSource):
    """Rows (file, content) that stand together by ``file``: their contents become that file.

    Options ``open``, ``between`` and ``close`` are written before, between and after the contents of a file.
    """

    @classmethod
    def name(cls) -> str:
        return "whole_files"

    def schema(self) -> str:
        return "file string, content binary"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return WholeFilesWriter(dict(self.options))


class WholeFilesWriter(DataSourceWriter):
    """Each task writes its files in a folder of its own and moves them when all are whole, so a repeated task does no harm.

    The folder is complete when it has a ``_SUCCESS`` file; a job that fails leaves none, and no temporary files.
    """

    def __init__(self, options: dict[str, str]):
        self.folder = options["path"].rstrip("/")
        self.open, self.between, self.close = (options.get(o, "").encode() for o in ("open", "between", "close"))

    def _place(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.folder)

    def write(self, iterator: Iterator[Row]) -> Written:
        files, folder = self._place()
        own = posixpath.join(folder, TEMPORARY, uuid.uuid4().hex)
        files.create_dir(own, recursive=True)
        names: list[str] = []
        out = None
        for file, content in iterator:
            if not names or names[-1] != file:
                self._finish(out)
                if not file or file.startswith(("_", ".")) or "/" in file:
                    raise ValueError(f"not a file name: {file!r}")
                names.append(file)
                out = files.open_output_stream(posixpath.join(own, file))
                out.write(self.open)
            else:
                out.write(self.between)
            out.write(bytes(content or b""))
        self._finish(out)
        if len(set(names)) < len(names):
            raise ValueError("the rows of a file must stand together")
        for name in names:
            files.move(posixpath.join(own, name), posixpath.join(folder, name))
        files.delete_dir(own)
        return Written(len(names))

    def _finish(self, out) -> None:
        if out is not None:
            out.write(self.close)
            out.close()

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, folder = self._place()
        self._clear(files, folder)
        files.create_dir(folder, recursive=True)
        with files.open_output_stream(posixpath.join(folder, DONE)) as done:
            done.write(b"")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files, folder = self._place()
        self._clear(files, folder)

    def _clear(self, files: fs.FileSystem, folder: str) -> None:
        temporary = posixpath.join(folder, TEMPORARY)
        if files.get_file_info(temporary).type == fs.FileType.Directory:
            files.delete_dir(temporary)


def write_files(rows: DataFrame, folder: str, order: list[Column] | None = None, **marks: str) -> None:
    """Write (file, content): the contents of a file in ``order``, with the marks ``open``, ``between``, ``close``.

    A file is written by one task, row by row.  ``folder`` is a path or URI that all workers reach.
    """
    rows.sparkSession.dataSource.register(WholeFiles)
    ordered = rows.repartition("file").sortWithinPartitions("file", *(order or []))
    contents = ordered.select("file", F.col("content").cast("binary").alias("content"))
    contents.write.format("whole_files").mode("append").options(path=folder, **marks).save()
