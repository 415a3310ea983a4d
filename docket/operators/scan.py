"""Running sums and minima along an order, however many rows a key has.

A window by key sorts all of a key in one task. Here each key is cut into chunks of positions, so that a large key
lies in many tasks; each chunk is scanned alone, and what the chunks before add to it comes from a scan of
the chunks' totals, of which a key has one for WIDTH positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_HOW = {"sum": (F.sum, lambda a, b: a + b), "min": (F.min, F.least)}

#: Positions of a chunk.
WIDTH = 1 << 16


def running(df: DataFrame, keys: list[str], order: list[str], value: str, out: str, how: str = "sum", width: int = WIDTH) -> DataFrame:
    """df with the sum or the least of value over the rows of its key up to and with each row.

    The first column of order is a whole number; keys and order aren't null and tell rows apart, as far as their running values
    may differ. Null values don't count; before the first other one the result is null. df is read twice.
    """
    of, both = _HOW[how]
    cut = df.withColumn("_chunk", F.floor(F.col(order[0]) / width))
    so_far = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*keys, "_chunk").agg(of(value).alias("_t"))
    carried = totals.withColumn("_before", of("_t").over(before)).drop("_t")
    done = cut.withColumn("_own", of(value).over(so_far)).join(carried, [*keys, "_chunk"], "left")
    return done.withColumn(out, F.coalesce(both(F.col("_own"), F.col("_before")), "_own", "_before")).drop("_chunk", "_own", "_before")


def latest(df: DataFrame, asks: DataFrame, keys: list[str], at: str, value: str, out: str, how: str = "sum", width: int = WIDTH) -> DataFrame:
    """asks with the sum or the least of df's value over the rows of its key that come before it (at is smaller).

    df: (keys, at, value); asks: (keys, at, ...). Of asks, keys and at tell rows apart, or their further columns are equal.
    """
    rest = [c for c in asks.columns if c not in (*keys, at)]
    mine = asks.withColumn(value, F.lit(None).cast(df.schema[value].dataType)).withColumn("_asks", F.lit(0))
    theirs = df.select(*keys, at, value, *(F.lit(None).cast(asks.schema[c].dataType).alias(c) for c in rest), F.lit(1).alias("_asks"))
    done = running(mine.unionByName(theirs), keys, [at, "_asks"], value, out, how, width)  # at the same place the ask comes first
    return done.where("_asks = 0").drop("_asks", value)
