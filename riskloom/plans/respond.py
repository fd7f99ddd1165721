"""Request-to-response job: check every batch, score the legal ones, answer all of them."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.config import BATCH_LIMIT, Bounds
from riskloom.operators.prep import PrepModel
from riskloom.operators.profile import summary_measures
from riskloom.operators.validation import row_errors
from riskloom.plans.predict import score_table
from riskloom.session import as_datetime


def respond(
    requests: DataFrame,
    prep: PrepModel,
    model: PipelineModel,
    bounds: Bounds,
    run_ts,
    model_version: str = "1",
    batch_key: str = "batch_id",
    members: str = "patients",
    member_id: str = "patient_id",
    limit: int = BATCH_LIMIT,
) -> tuple[DataFrame, DataFrame]:
    """(one response per batch, one message per invalid member).

    A batch is accepted if it has 1 to ``limit`` members and all are valid; others come back rejected with their
    counts and no predictions. Messages carry the member's position in its batch, counted from 1. Members of a
    batch that is too large are counted where they are and never gathered. Batch ids are unique.
    """
    flat = requests.select(batch_key, F.posexplode(members).alias("position", "__member"))
    flat = flat.select(batch_key, (F.col("position") + 1).alias("position"), "__member.*")
    checked = row_errors(flat, bounds, out="__errors")
    errors = checked.where(F.col("__errors").isNotNull()).select(
        batch_key, "position", member_id, F.concat(F.lit("Patient "), "position", F.lit(": "), "__errors").alias("message")
    )
    invalid = errors.groupBy(batch_key).agg(F.count("*").alias("n_invalid"))
    size = F.greatest(F.coalesce(F.size(members), F.lit(0)), F.lit(0)).cast("bigint")
    batches = requests.select(batch_key, size.alias("n_members")).join(invalid, batch_key, "left")
    batches = batches.withColumn("n_invalid", F.coalesce("n_invalid", F.lit(0)).cast("bigint"))
    accepted = (F.col("n_invalid") == 0) & F.col("n_members").between(1, limit)
    batches = batches.withColumn("status", F.when(accepted, F.lit("accepted")).otherwise(F.lit("rejected")))

    legal = checked.drop("__errors").join(batches.where("status = 'accepted'").select(batch_key), batch_key, "left_semi")
    scored = score_table(legal, prep, model, closed="left")
    fields = ["position", member_id, "prediction", "probability", "confidence_score", "risk_category"]
    docs = scored.groupBy(batch_key).agg(  # at most ``limit`` members each
        F.sort_array(F.collect_list(F.struct(*fields))).alias("predictions"),
        F.struct(*summary_measures("prediction", "probability", inclusive=True)).alias("summary"),
    )
    responses = batches.join(docs, batch_key, "left").withColumns(
        {"model_version": F.lit(model_version), "processing_timestamp": F.lit(as_datetime(run_ts))}
    )
    return responses, errors
