"""A folder of tables that change together: staged per run, visible by one file that is moved last.

    root/runs/{run id}/{table}/...   what a run has written, visible or not
    root/commits/{number}            a run's id, by the order of the commits

A run writes into its own folder, and its commit is one rename: whoever reads sees all of the run or nothing of it. The run's id is its
fence: a run that has committed does nothing when it comes again, and one that broke off starts its folder anew. Of two
runs that began from the same state only one can take the next number. State tables (the database, the seen-set) are those of the last
run that wrote them; logs are the rows of all committed runs.
"""

from __future__ import annotations

import re
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docket import schemas
from docket.sources.state import _exists, removed


class Taken(RuntimeError):
    """Another run has committed since this one began."""


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, at: str):  # noqa: ANN202
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)

    def _system(self, at: str):  # noqa: ANN202
        return self._path(at).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def committed(self) -> list[str]:
        """Ids of the committed runs, in their order; small files, one per run."""
        at = f"{self.root}/commits"
        if not _exists(self.spark, at):
            return []
        names = sorted(s.getPath().getName() for s in self._system(at).listStatus(self._path(at)))
        numbers = [n for n in names if re.fullmatch(r"\d{9}", n)]
        system, io = self._system(at), self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        out = []
        for n in numbers:
            stream = system.open(self._path(f"{at}/{n}"))
            try:
                out.append(io.toString(stream, "UTF-8"))
            finally:
                stream.close()
        return out

    def folder(self, run_id: str) -> str:
        return f"{self.root}/runs/{quote(run_id, safe='')}"

    def where(self, table: str) -> str | None:
        """The folder of a state table: that of the last committed run that wrote it."""
        return next((at for r in reversed(self.committed()) if _exists(self.spark, at := f"{self.folder(r)}/{table}")), None)

    def rows(self, table: str, schema: str) -> DataFrame:
        """A state table's rows; none if no run has written it."""
        return self._read([at] if (at := self.where(table)) else [], schema)

    def log(self, table: str, schema: str) -> DataFrame:
        """The rows that all committed runs have added to a log."""
        return self._read([at for r in self.committed() if _exists(self.spark, at := f"{self.folder(r)}/{table}")], schema)

    def _read(self, paths: list[str], schema: str) -> DataFrame:
        kind = schemas.struct(schema)
        return self.spark.read.schema(kind).json(paths) if paths else self.spark.createDataFrame([], kind)

    def begin(self, run_id: str) -> Run | None:
        """A run's stage; None if a run with this id has committed already."""
        done = self.committed()
        if run_id in done:
            return None
        removed(self.spark, self.folder(run_id))  # what an attempt that broke off has left
        return Run(self, run_id, len(done))


class Run:
    """The stage of one run: what it writes is seen by nobody before commit()."""

    def __init__(self, store: Store, run_id: str, number: int) -> None:
        self.store, self.run_id, self.number = store, run_id, number

    def write(self, df: DataFrame, table: str) -> int:
        """Write a table; its number of rows is counted by the write itself."""
        seen = Observation(f"rows of {table}")
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("ignoreNullFields", "false").json(self.at(table))
        return seen.get["n"]

    def text(self, df: DataFrame, table: str) -> None:
        """Write the one row's column json as a document."""
        df.select(F.col("json").alias("value")).coalesce(1).write.mode("overwrite").text(self.at(table))

    def at(self, table: str) -> str:
        return f"{self.store.folder(self.run_id)}/{table}"

    def commit(self) -> None:
        """Make the run visible: its id is written aside, and moved to the next number, which must be free."""
        store, at = self.store, f"{self.store.root}/commits"
        context = store.spark.sparkContext
        aside = f"{at}/_{uuid.uuid4().hex}"
        out = store._system(at).create(store._path(aside))
        try:
            out.write(bytearray(self.run_id.encode()))
        finally:
            out.close()
        of = context._jvm.org.apache.hadoop.fs.FileContext
        files = of.getFileContext(store._system(aside).getUri(), context._jsc.hadoopConfiguration())
        none = context._gateway.new_array(context._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(store._path(aside), store._path(f"{at}/{self.number:09d}"), none)  # fails if the number is taken
        except Exception as e:
            removed(store.spark, aside)
            if _exists(store.spark, f"{at}/{self.number:09d}"):
                raise Taken(f"{self.run_id}: another run has committed since it began") from e
            raise
