"""Streaming sinks: idempotent per micro-batch, all state in shared storage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.config import Bounds
from riskloom.operators.validation import quarantine

EPOCH = "epoch"


def _run(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str, wait: bool):
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    if wait:
        query.awaitTermination()
    return query


def run_windows(windows: DataFrame, out: str, checkpoint: str, mode: str = "update", wait: bool = True):
    """Write the changed windows of each micro-batch to ``out/epoch=<id>``.

    A replayed micro-batch overwrites its own folder, so a restart after a
    failure neither loses nor doubles a window. ``update`` lets the watermark
    drop closed windows from the state.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/{EPOCH}={epoch}")

    return _run(windows, write, checkpoint, mode, wait)


def latest_windows(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Final value of every window: the one from its newest micro-batch."""
    table = spark.read.parquet(out)
    rest = [c for c in table.columns if c not in (*keys, EPOCH)]
    newest = table.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(EPOCH)).alias("w"))
    return newest.select(*keys, "w.*")


def stream_validate(
    stream: DataFrame,
    bounds: Bounds,
    good: str,
    bad: str,
    checkpoint: str,
    null_policy: str = "fail",
    wait: bool = True,
):
    """Split each micro-batch into valid and quarantined rows, one folder per micro-batch."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            valid, rejected = quarantine(batch, bounds, null_policy)
            valid.write.mode("overwrite").parquet(f"{good}/{EPOCH}={epoch}")
            rejected.write.mode("overwrite").parquet(f"{bad}/{EPOCH}={epoch}")
        finally:
            batch.unpersist()

    return _run(stream, write, checkpoint, "append", wait)


def run_append(stream: DataFrame, out: str, checkpoint: str, wait: bool = True):
    """Append a stream without aggregation (scored rows, alerts) with the built-in exactly-once file sink."""
    query = (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .format("parquet")
        .option("path", out)
        .start()
    )
    if wait:
        query.awaitTermination()
    return query


def stream_respond(
    requests: DataFrame, answer: Callable[[DataFrame], tuple[DataFrame, DataFrame]], out: str, checkpoint: str, wait: bool = True
):
    """Answer a stream of nested requests: responses and messages of each micro-batch in folders of their own.

    ``answer`` maps the requests of a micro-batch to (responses, messages), as ``plans.respond`` does. A request is one row, so a
    batch never spans micro-batches and no state is kept; a replayed micro-batch overwrites its own folders.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            responses, messages = answer(batch)
            responses.write.mode("overwrite").parquet(f"{out}/responses/{EPOCH}={epoch}")
            messages.write.mode("overwrite").parquet(f"{out}/messages/{EPOCH}={epoch}")
        finally:
            batch.unpersist()

    return _run(requests, write, checkpoint, "append", wait)
