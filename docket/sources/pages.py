"""Landed pages as a data source: spark.read, df.write and spark.readStream by format("landed").

    folder/{committee_slug}/{date}/{file}.html

Rows are (committee_slug, date, file, html). Filters on body and date choose folders, so that the pages of others aren't
opened. The driver lists folders of meetings; tasks list the files in them. As a stream, files come in the order of their
modification times, and the offset is the last one's time and path.
"""

from __future__ import annotations

import operator
import re
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, StringStartsWith, WriterCommitMessage

SCHEMA = "committee_slug string, date string, file string, html string"
ARROW = pa.schema([(c.split()[0], pa.string()) for c in SCHEMA.split(", ")])
#: Folders of a task, files of a streaming task, and bytes of pages that are handed on at a time.
FOLDERS, FILES, BATCH = 256, 512, 4 << 20
SUFFIX = ".html"
_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")
_COMPARED: dict[type, Callable] = {EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le, StringStartsWith: str.startswith, In: lambda x, values: x in values}


def _at(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _listed(system: fs.FileSystem, path: str) -> list[fs.FileInfo]:
    return sorted(system.get_file_info(fs.FileSelector(path, allow_not_found=True)), key=lambda i: i.path)


def _name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def _files(system: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    """A meeting's pages; files that are still being written begin with a point."""
    return [i for i in _listed(system, folder) if i.type == fs.FileType.File and i.path.endswith(SUFFIX) and not _name(i.path).startswith(".")]


def _read(system: fs.FileSystem, paths: Iterable[str]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for path in paths:
        with system.open_input_stream(path) as f:
            html = f.read().decode("utf-8", "replace")
        slug, date, file = path.split("/")[-3:]
        rows.append((unquote(slug), date, unquote(file), html))
        size += len(html)
        if size >= BATCH:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], schema=ARROW)


@dataclass
class Paths(InputPartition):
    """Folders or files of one task."""

    paths: list[str]


def _dealt(paths: list[str], most: int) -> list[Paths]:
    return [Paths(paths[k : k + most]) for k in range(0, len(paths), most)]


class _Reader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path, self.asked = path, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        """Comparisons of body and date are answered by the folders' names; others stay Spark's."""
        for f in filters:
            column = getattr(f, "attribute", ())
            if len(column) == 1 and column[0] in ("committee_slug", "date") and (type(f) in _COMPARED or isinstance(f, IsNotNull)):
                if type(f) in _COMPARED:  # no name is null
                    self.asked.append((column[0], type(f), f.value))
            else:
                yield f

    def _wanted(self, column: str, value: str) -> bool:
        return all(_COMPARED[kind](value, other) for c, kind, other in self.asked if c == column)

    def partitions(self) -> list[InputPartition]:
        system, root = _at(self.path)
        bodies = [i.path for i in _listed(system, root) if i.type == fs.FileType.Directory and self._wanted("committee_slug", unquote(_name(i.path)))]
        meetings = [i.path for b in bodies for i in _listed(system, b) if _DATE.fullmatch(_name(i.path)) and self._wanted("date", _name(i.path))]
        return _dealt(meetings, FOLDERS)

    def read(self, partition: InputPartition | None) -> Iterator[pa.RecordBatch]:
        if partition is not None:  # where no folder is asked for, Spark still asks for one task
            system, _ = _at(self.path)
            yield from _read(system, (i.path for folder in partition.paths for i in _files(system, folder)))


class _Stream(DataSourceStreamReader):
    """Files after an offset (time in ns, path). The last moments' files wait, so that what lands at the same time is ordered by path first.

    A page that is written again comes again. Files have to land with the time of their landing, as those do that are written or moved
    by a writer of this source.
    """

    def __init__(self, path: str, settle: float) -> None:
        self.path, self.settle = path, settle

    def _after(self, start: tuple[int, str], end: tuple[int, str]) -> list[tuple[int, str]]:
        system, root = _at(self.path)
        infos = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        found = ((i.mtime_ns, i.path) for i in infos if i.type == fs.FileType.File and i.path.endswith(SUFFIX) and not _name(i.path).startswith("."))
        return sorted(x for x in found if start < x <= end and _DATE.fullmatch(x[1].split("/")[-2]))

    def initialOffset(self) -> dict:  # noqa: N802
        return {"time": 0, "path": ""}

    def latestOffset(self) -> dict:  # noqa: N802
        files = self._after((0, ""), (int((time.time() - self.settle) * 1e9), ""))
        return {"time": files[-1][0], "path": files[-1][1]} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        files = self._after((start["time"], start["path"]), (end["time"], end["path"]))
        return _dealt([path for _, path in files], FILES)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        yield from _read(_at(self.path)[0], partition.paths)


class _Writer(DataSourceWriter):
    """A file per row, written aside and moved: a task that is run again writes the same files."""

    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        system, root = _at(self.path)
        for row in iterator:
            if row.committee_slug is None or row.file is None or not _DATE.fullmatch(row.date or ""):
                raise ValueError(f"a page needs a body, a date and a file name: {row.committee_slug}, {row.date}, {row.file}")
            folder = f"{root.rstrip('/')}/{quote(row.committee_slug, safe='')}/{row.date}"
            system.create_dir(folder, recursive=True)
            aside = f"{folder}/.{uuid.uuid4().hex}"
            with system.open_output_stream(aside) as out:
                out.write((row.html or "").encode("utf-8"))
            system.move(aside, f"{folder}/{quote(row.file.removesuffix(SUFFIX), safe='')}{SUFFIX}")
        return WriterCommitMessage()


class LandedPages(DataSource):
    """Options: path; settle, seconds that a stream lets a file lie (1)."""

    @classmethod
    def name(cls) -> str:
        return "landed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001, ARG002
        return _Reader(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: ANN001, ARG002, N802
        return _Stream(self.options["path"], float(self.options.get("settle", 1)))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:  # noqa: ANN001
        if overwrite:
            raise ValueError("pages are added, a page at a time: write with mode append")
        if [f.name for f in schema.fields] != ARROW.names:
            raise ValueError(f"pages are written from {SCHEMA}")
        return _Writer(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LandedPages)


def landed(spark: SparkSession, folder: str) -> DataFrame:
    """(committee_slug, date, file, html) of the pages in a folder; none if it isn't there. Filters on body and date choose what is opened."""
    register(spark)
    return spark.read.format("landed").load(folder)


def arriving(spark: SparkSession, folder: str, settle: float = 1) -> DataFrame:
    """The same as a stream, which begins with the oldest page, or where its checkpoint says."""
    register(spark)
    return spark.readStream.format("landed").option("settle", settle).load(folder)


def land(pages: DataFrame, folder: str) -> None:
    """Write pages (committee_slug, date, file, html) into a folder that all tasks share; a page that is there is replaced."""
    register(pages.sparkSession)
    pages.select(*ARROW.names).write.format("landed").mode("append").save(folder)
