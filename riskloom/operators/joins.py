"""Keyed joins in place of positional alignment (JOI rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

SMALL_ROWS = 10_000


def salted_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "left", salts: int = 16) -> DataFrame:
    """Equi-join that spreads each key of ``big`` over ``salts`` tasks.

    ``small`` is replicated ``salts`` times, so use it for a side that has few
    rows per key but is too large to broadcast. Only joins that keep the big
    side are supported; a replicated side must never be the preserved one.

    The salt hashes the row and its input partition: identical copies of a row
    are spread too, and a retried task computes the same salts.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join cannot preserve the replicated side: {how}")
    hashable = [f.name for f in big.schema if isinstance(f.dataType, AtomicType)]
    spread = F.xxhash64(*[F.col(c) for c in hashable], F.spark_partition_id())
    salt = F.pmod(spread, F.lit(salts)).cast("int")
    left = big.withColumn("__salt", salt)
    right = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "__salt"], how).drop("__salt")


def join_small(
    big: DataFrame, small: DataFrame, on: list[str], how: str = "left", limit: int = SMALL_ROWS, salts: int = 16
) -> DataFrame:
    """Broadcast ``small`` only after checking that it has at most ``limit`` rows.

    The check fetches ``limit + 1`` rows; when they all fit, those rows *are*
    the broadcast side (no second evaluation). Beyond the limit the join is
    salted instead.
    """
    fetched = small.limit(limit + 1).toArrow()
    if fetched.num_rows <= limit:
        frozen = big.sparkSession.createDataFrame(fetched, schema=small.schema)
        return big.join(F.broadcast(frozen), on, how)
    return salted_join(big, small, on, how, salts)


def attach(df: DataFrame, other: DataFrame, key: list[str], how: str = "inner", salts: int = 0) -> DataFrame:
    """Re-attach a label table by key.

    Adaptive execution picks broadcast from the measured size and splits skewed
    partitions; ``salts`` forces an even spread when one key is known to be hot.
    """
    return salted_join(df, other, key, how, salts) if salts else df.join(other, key, how)


def attach_predictions(df: DataFrame, predictions: DataFrame, key: list[str], salts: int = 0) -> DataFrame:
    """Keep every row of ``df``; rows without a prediction get NULL."""
    return attach(df, predictions, key, "left", salts)


def tag_snapshots(ref: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    """Both snapshots in one frame with an ``is_ref`` 1/0 column."""
    left = ref.select(*cols, F.lit(1).alias("is_ref"))
    return left.unionByName(cur.select(*cols, F.lit(0).alias("is_ref")))


def compare_counts(tagged: DataFrame, by: list[str]) -> DataFrame:
    """Counts per group on both sides, 0 where one side lacks the group.

    One union and one aggregation with map-side combine give the full outer
    join of two histograms without joining anything.
    """
    return tagged.groupBy(*by).agg(
        F.sum("is_ref").cast("bigint").alias("n_ref"),
        F.sum(F.lit(1) - F.col("is_ref")).cast("bigint").alias("n_cur"),
    )
