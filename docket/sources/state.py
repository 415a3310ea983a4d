"""State between runs, and lineage cut in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docket import schemas


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local folder of our own in local mode only, where that is unset."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        found = context.getConf().get("spark.checkpoint.dir")
        if not found:
            if not context.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            found = tempfile.mkdtemp(prefix="docket-")
        context.setCheckpointDir(found)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


#: Setting under which what a writing has shuffled goes when it is done, not when the driver happens to collect garbage.
CLEANED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with these settings for what runs inside."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_SCOPES = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are kept inside go at the end, but for those that are kept to outlive it."""
    scopes = _SCOPES.__dict__.setdefault("open", [])
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            removed(spark, path)


def kept(df: DataFrame, name: str, outlive: bool = False) -> DataFrame:
    """df as a table in the shared folder, for what is read more than once; survives lost executors.

    It goes with the scratch() around it (with the one around that if it is to outlive), else when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    scopes = _SCOPES.__dict__.get("open", [])
    scopes = scopes[:-1] if outlive else scopes
    if scopes:
        scopes[-1].append(path)
    else:
        atexit.register(removed, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there; nothing happens once the session is gone."""
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def load_seen(spark: SparkSession, path: str) -> DataFrame:
    """(committee_slug, date) from a JSON object of lists; no rows if the file is missing or unreadable."""
    empty = spark.createDataFrame([], schemas.SEEN)
    if not _exists(spark, path):
        return empty
    text = spark.read.text(path, wholetext=True)
    kept = F.from_json("value", "map<string,array<string>>")
    return text.select(F.explode(kept).alias("committee_slug", "dates")).select("committee_slug", F.explode("dates").alias("date"))


def load_cases(spark: SparkSession, path: str) -> DataFrame:
    """The published cases with their position; no rows if there is no file."""
    kind = schemas.struct(schemas.CASE)
    if not _exists(spark, path):
        return spark.createDataFrame([], f"pos long, {schemas.CASE}")
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.posexplode(F.from_json("value", f"array<struct<{_inline(kind)}>>")).alias("pos", "c"))
    return rows.select(F.col("pos").cast("long"), "c.*")


def _inline(kind) -> str:
    return ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in kind.fields)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
