"""Sinks (SNK rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import BATCH_LIMIT
from riskloom.operators.joins import join_small


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] = (), fmt: str = "parquet"
) -> str:
    """Write a directory of part files; a run stamp is a partition column, not a file name."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def write_summary(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON lines of a summary frame (a handful of rows)."""
    df.coalesce(1).write.mode(mode).json(path)
    return path


def run_stamp(ts: Column) -> Column:
    """``yyyyMMdd_HHmmss`` text of a timestamp, for partition values."""
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def to_batch_response(
    scored: DataFrame,
    batch_key: str,
    member: list[str],
    fields: list[str],
    summary: list[Column],
    limit: int = BATCH_LIMIT,
    salts: int = 16,
) -> tuple[DataFrame, DataFrame]:
    """(response documents, rejected batches).

    A response nests the members of a batch, so a batch must be small: the
    declared request limit applies and larger batches are returned as rejected
    with their size, like any other oversize request. Sizes come from a map-side
    combined count, and the oversize ids are removed by a broadcast or salted anti-join, so
    the members of a huge batch never meet in one task. ``batch_statuses`` lists both kinds.
    """
    sizes = scored.groupBy(batch_key).agg(F.count("*").alias("n_members"))
    oversize = sizes.where(F.col("n_members") > limit)
    legal = join_small(scored, oversize.select(batch_key), [batch_key], "left_anti", salts=salts)
    element = F.struct(*[F.col(c) for c in [*member, *fields]])
    docs = legal.groupBy(batch_key).agg(
        F.sort_array(F.collect_list(element)).alias("predictions"), F.struct(*summary).alias("summary")
    )
    return docs, oversize



def batch_statuses(responses: DataFrame, rejected: DataFrame, batch_key: str) -> DataFrame:
    """Every batch with its status: responses with their size, rejected ones with theirs and NULL elsewhere."""
    accepted = responses.select(
        batch_key, F.lit("accepted").alias("status"), F.size("predictions").cast("bigint").alias("n_members"), "predictions", "summary"
    )
    none = rejected.select(batch_key, F.lit("rejected").alias("status"), "n_members")
    return accepted.unionByName(none, allowMissingColumns=True)
