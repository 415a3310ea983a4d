"""What the operators share: tables, the shared folder, written stages, components."""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir of the session.

    Where it is unset a local folder is made, in local mode only.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = tempfile.mkdtemp(prefix="docket-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def _drop(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session is gone already: the cluster's own clean-up removes the folder
        pass


_SCOPES = threading.local()


def remove_later(spark: SparkSession, path: str) -> None:
    """Remove a folder when the driver ends."""
    atexit.register(_drop, spark, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is written inside is removed at the end, but for tables that are written to be kept."""
    scopes = _SCOPES.__dict__.setdefault("open", [])
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            _drop(spark, path)


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage, survives lost executors.

    The table is removed at the end of the scratch() that it is written in (of the one around that
    with keep), else when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/docket-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    scopes = _SCOPES.__dict__.get("open", [])
    scopes = scopes[:-1] if keep else scopes
    if scopes:
        scopes[-1].append(path)
    else:
        remove_later(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Bytes of an Arrow batch where the session doesn't set them: rows are whole texts, some of them very long.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by bytes, unless the session has its own bound."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def fits(df: DataFrame, rows: int) -> bool:
    """Whether df has at most so many rows; looks no further than that."""
    return df.limit(rows + 1).count() <= rows


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows, else as it is."""
    return F.broadcast(df) if fits(df, rows) else df


def components(edges: DataFrame, name: str = "cc", broadcast_rows: int = 200_000, at_once: int = 500_000) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node it reaches.

    Up to at_once different edges (a few megabytes) are followed by one task. Beyond
    that it takes rounds of joins, which give the same: alternating large-star and
    small-star steps until the edges stay the same.
    The smallest neighbours come from a grouped minimum (combined before the
    shuffle) and are joined back from a written table, so that a node with very
    many neighbours is split by the join rather than gathered in one task.
    Loops and repeated edges are allowed; no edges give no rows.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        u = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            u = u.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = written(u.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), f"{name}-low")
        low = bounded(low, broadcast_rows)
        j = u.join(low, "u")
        if large:
            out = j.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = j.select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        out = out.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        return written(out.where("a <> b").distinct(), f"{name}-star")

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), f"{name}-edges")
    if fits(e, at_once):
        kind = e.schema["a"].dataType.simpleString()
        return written(e.coalesce(1).mapInArrow(_follow, f"node {kind}, root {kind}"), f"{name}-roots")
    seen = mark(e)
    while seen[0]:
        e = star(star(e, True), False)
        now = mark(e)
        if now == seen:
            break
        seen = now
    leaves = e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return leaves.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over all edges of a task, in which the smaller root wins."""
    parent: dict = {}

    def root(x):  # noqa: ANN001, ANN202
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    types = None
    for b in batches:
        types = b.schema.field(0).type
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            parent.setdefault(x, x)
            parent.setdefault(y, y)
            p, q = root(x), root(y)
            if p != q:
                parent[max(p, q)] = min(p, q)
    if parent:
        nodes = list(parent)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, types), pa.array([root(x) for x in nodes], types)], ["node", "root"])


def tree_sum(df: DataFrame, column: str, kind: type = np.float64) -> np.ndarray | None:
    """The sum of arrays of numbers, a binary value per row, all as long; merged in a tree, so that the driver meets few of them. None without rows."""

    def add(a: np.ndarray | None, b: np.ndarray | None) -> np.ndarray | None:
        return b if a is None else a if b is None else a + b

    return df.select(column).rdd.map(lambda r: np.frombuffer(r[0], kind)).treeAggregate(None, add, add, depth=3)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """(key, rows) of each run of equal keys in a sorted partition; one run is held at a time."""
    held: list[pa.RecordBatch] = []
    key = None
    for b in batches:
        if not b.num_rows:
            continue
        values = list(zip(*(b.column(k).to_pylist() for k in keys), strict=True))
        start = 0
        for k in range(len(values) + 1):
            if k < len(values) and values[k] == key:
                continue
            if k > start:
                held.append(b.slice(start, k - start))
            start = k
            if k < len(values):
                if held:
                    yield key, pa.Table.from_batches(held)
                key, held = values[k], []
    if held:
        yield key, pa.Table.from_batches(held)


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """A column of lists of equal length, without nulls, as a matrix."""
    flat = column.combine_chunks()
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(flat), -1)
