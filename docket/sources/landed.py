"""Landed inputs: pages, files and manifests that were fetched outside the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PLACE = r"([^/]+)/(\d{4}-\d{2}-\d{2})/[^/]+$"


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """(committee_slug, date, html) of {folder}/{slug}/{date}/*.html, a row per file."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.html").text(folder, wholetext=True)
    path = F.input_file_name()
    return files.select(F.regexp_extract(path, _PLACE, 1).alias("committee_slug"), F.regexp_extract(path, _PLACE, 2).alias("date"), F.col("value").alias("html"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("pdf_url string, relative_path string, repo string").json(path)


def raw_files(spark: SparkSession, folder: str, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files, missing): the manifest's files with their bytes, and entries without a readable file."""
    binary = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    root = F.concat(F.lit("^.*?"), F.lit(folder.rstrip("/").rsplit("/", 1)[-1]), F.lit("/"))
    found = binary.select(F.regexp_replace("path", root, "").alias("relative_path"), "content")
    joined = listed.withColumn("pos", F.monotonically_increasing_id()).join(found, "relative_path", "left")
    columns = ["pdf_url", "relative_path", "repo", "pos", "content"]
    return joined.where("content is not null").select(*columns), joined.where("content is null").select("pdf_url", "relative_path", "repo")


def real_pdfs(files: DataFrame) -> DataFrame:
    """Files that begin as a PDF does; saved error pages don't."""
    return files.where(F.substring("content", 1, 4) == F.lit(b"%PDF"))


def write_manifest(df: DataFrame, path: str, append: bool = True) -> None:
    df.select("pdf_url", "relative_path", "repo").write.mode("append" if append else "overwrite").json(path)
