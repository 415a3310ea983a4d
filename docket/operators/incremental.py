"""Incremental discovery: what is new, in which order, how much at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["committee_slug", "date"]


def confirmed(bodies: DataFrame) -> DataFrame:
    return bodies.where("confirmed")


def unseen(refs: DataFrame, seen: DataFrame, on: list[str] = KEY) -> DataFrame:  # noqa: B006
    return refs.join(seen.select(*on), on, "left_anti")


def in_range(refs: DataFrame, first: str, last: str, column: str = "date") -> DataFrame:
    """Both ends included; dates compare as text."""
    return refs.where(F.col(column).between(first, last))


def with_protocol(meetings: DataFrame, column: str = "protocol_pdf_url") -> DataFrame:
    """Meetings without approved minutes stay unseen and come again on a later run."""
    return meetings.where(F.col(column).isNotNull())


def newest(df: DataFrame, order: str, ties: list[str], n: int = 15) -> DataFrame:
    return df.orderBy(F.col(order).desc(), *ties).limit(n)


def oldest(df: DataFrame, order: str, ties: list[str], n: int = 10) -> DataFrame:
    return df.orderBy(F.col(order).asc(), *ties).limit(n)


def mark_seen(seen: DataFrame, more: DataFrame) -> DataFrame:
    """(committee_slug, dates): distinct and ascending; marking twice changes nothing."""
    both = seen.select(*KEY).unionByName(more.select(*KEY))
    return both.groupBy("committee_slug").agg(F.array_sort(F.collect_set("date")).alias("dates"))


def diagnostics(bodies: DataFrame, found: DataFrame, body: str, errors: DataFrame | None = None) -> DataFrame:
    """One row per body: how many were found (0 too), and the last error if there is one."""
    out = bodies.join(found.groupBy(body).agg(F.count("*").alias("found")), body, "left").withColumn("found", F.coalesce("found", F.lit(0)))
    if errors is not None:
        out = out.join(errors.groupBy(body).agg(F.max("error").alias("error")), body, "left")
    return out


def funnel(refs: DataFrame, seen: DataFrame, wanted: Column, on: list[str] = KEY) -> DataFrame:  # noqa: B006
    """One row: total, in_range, already_seen (of those), remaining."""
    marked = refs.join(seen.select(*on).distinct().withColumn("_seen", F.lit(True)), on, "left")
    known = F.coalesce(F.col("_seen"), F.lit(False))
    return marked.agg(
        F.count("*").alias("total"),
        F.count_if(wanted).alias("in_range"),
        F.count_if(wanted & known).alias("already_seen"),
        F.count_if(wanted & ~known).alias("remaining"),
    )


def first_per_group(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Of each key the row that comes first in the order; combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")
