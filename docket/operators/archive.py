"""Archive marking of steps from the raw files at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docket.functions.archive import filled, pending_marker

from .incremental import first_per_group


def file_hashes(raw_files: DataFrame) -> DataFrame:
    """(relative_path, sha256); of a path that comes twice the last counts."""
    hashed = raw_files.select("relative_path", "pos", F.sha2("content", 256).alias("sha256"))  # bytes don't travel
    return first_per_group(hashed, ["relative_path"], -F.col("pos")).select("relative_path", "sha256")


def file_of_url(raw_files: DataFrame) -> DataFrame:
    """(pdf_url, relative_path, repo): the last entry of each address."""
    return first_per_group(raw_files.select("pdf_url", "relative_path", "repo", "pos"), ["pdf_url"], -F.col("pos"))


def marked_steps(steps: DataFrame, raw_files: DataFrame) -> DataFrame:
    """steps (pdf_url, archive_url, ...) with a pending marker where the file is known, else as they are."""
    files = file_of_url(raw_files).select("pdf_url", "relative_path", "repo")
    joined = steps.join(files, "pdf_url", "left")
    marker = F.when(F.col("relative_path").isNotNull(), pending_marker(F.col("relative_path"), F.col("repo")))
    return joined.withColumn("archive_url", F.coalesce(marker, "archive_url")).drop("relative_path", "repo")


def _with_steps(cases: DataFrame, key: str, steps: DataFrame) -> DataFrame:
    back = steps.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("step_pos", "s"))).alias("_s"))
    return cases.join(back, key, "left").withColumn("steps", F.coalesce(F.transform("_s", lambda x: x["s"]), "steps")).drop("_s")


def marked(cases: DataFrame, raw_files: DataFrame, key: str = "case_pos") -> DataFrame:
    """cases whose steps have their markers."""
    steps = cases.select(key, F.posexplode("steps").alias("step_pos", "s")).withColumns({"pdf_url": F.col("s.source.pdf_url"), "archive_url": F.col("s.source.archive_url")})
    done = marked_steps(steps, raw_files).withColumn("s", F.col("s").withField("source.archive_url", F.col("archive_url")))
    return _with_steps(cases, key, done)


def with_snapshots(cases: DataFrame, snapshots: DataFrame, key: str = "case_pos") -> DataFrame:
    """cases whose steps have the outside archive's address, where there is one. snapshots: (pdf_url, wayback_url)."""
    steps = cases.select(key, F.posexplode("steps").alias("step_pos", "s")).withColumn("pdf_url", F.col("s.source.pdf_url"))
    done = steps.join(snapshots.dropDuplicates(["pdf_url"]), "pdf_url", "left")
    done = done.withColumn("s", F.col("s").withField("source.wayback_url", F.coalesce(F.col("wayback_url"), F.col("s.source.wayback_url"))))
    return _with_steps(cases, key, done)


def with_permalinks(cases: DataFrame, host: str, main_repo: str, main_sha: str, archive_repo: str, archive_sha: str | None) -> DataFrame:
    fill = lambda s: s.withField("source.archive_url", filled(s["source"]["archive_url"], host, main_repo, main_sha, archive_repo, archive_sha))
    return cases.withColumn("steps", F.transform("steps", fill))
