"""Positions in a seeded order without a global sort, by DataFrame functions alone.

Rows are ordered inside a group by the hex digits of ``md5(id:seed)``. Its first digits split a group into buckets
whose number follows the table's size, so a source that holds a third of all rows is ordered by many tasks.
What lies before a bucket comes from the bucket totals.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 4096


def seeded(id_col: str, seed: int, row_col: str) -> Column:
    """Hex text that orders rows at random, equal on every run; rows without an id go by their place in the table."""
    name = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("row "), F.col(row_col)))
    return F.md5(F.concat(name, F.lit(f":{seed}")).cast("binary"))


def digits_for(rows: int) -> int:
    """Hex digits that split ``rows`` rows into buckets of about ``ROWS_PER_BUCKET``."""
    return max(1, math.ceil(math.log(max(rows, 1) / ROWS_PER_BUCKET, 16))) if rows > ROWS_PER_BUCKET else 1


def before(df: DataFrame, group: str, bucket: str, order: list[str], size: Column, name: str) -> DataFrame:
    """``name``: sum of ``size`` over the rows that precede a row inside its group."""
    keyed = df.withColumn("__size", size)
    totals = keyed.groupBy(group, bucket).agg(F.sum("__size").alias("__total"))
    # one row per group and bucket; buckets hold about ROWS_PER_BUCKET rows each
    lead = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        F.col(group).alias("__group"),
        F.col(bucket).alias("__bucket"),
        F.coalesce(F.sum("__total").over(lead), F.lit(0)).alias("__start"),
    )
    inside = Window.partitionBy(group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        keyed.withColumn("__inside", F.coalesce(F.sum("__size").over(inside), F.lit(0)))
        .join(starts, (F.col(group) == F.col("__group")) & (F.col(bucket) == F.col("__bucket")))
        .withColumn(name, F.col("__inside") + F.col("__start"))
        .drop("__size", "__inside", "__group", "__bucket", "__start")
    )


def source_key(source: Column) -> Column:
    """Sorts like the source by code point, null last; never null."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))
