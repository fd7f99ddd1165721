"""Nested requests in, answers out: as a batch job and on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.base import FEATURES, KEY, LINES, label, lines, query, workspace
from bindings.validating import BOUNDS, _bad_sql, _errors_sql
from riskloom.operators import models as L
from riskloom.operators.prep import PrepModel
from riskloom.plans import respond
from riskloom.streaming import stream_respond

LIMIT = 6
ROWS_PER_FILE = 500_000
RUN_TS = "2024-01-02 03:04:05"
RESPOND_SQL = f"""with l as (
    select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) as position
    from lineitem),
  checked as (select l_orderkey, position, case when {_bad_sql(BOUNDS)} then {_errors_sql(BOUNDS)} end as errors from l)
  select l_orderkey as batch_id, count(*) as n_members, count(errors) as n_invalid,
         case when count(errors) = 0 and count(*) <= {LIMIT} then 'accepted' else 'rejected' end as status,
         case when count(errors) = 0 and count(*) <= {LIMIT} then count(*) else 0 end as n_answers,
         coalesce(string_agg('Patient ' || position || ': ' || errors, ' | ' order by position), '') as messages
  from checked group by l_orderkey"""


def request_files(rows: int) -> int:
    """Four files or, of a large table, one for ``ROWS_PER_FILE`` lines."""
    return max(4, -(-rows // ROWS_PER_FILE))


def requests(spark, sf) -> DataFrame:
    """An order is a batch, its lines are the members."""
    members = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", *FEATURES)))  # an order's lines
    return lines(spark, sf).groupBy(F.col("l_orderkey").alias("batch_id")).agg(members.alias("patients"))


def answering(spark, sf):
    """The responder with a model fitted on the lines; a few steps are enough for the shape of the answers."""
    df = lines(spark, sf).select(*KEY, *FEATURES).withColumn("label", label().cast("double"))
    prep = PrepModel(LINES).fit(df)
    ready = prep.transform(df).select("label", *[F.col(c).cast("double").alias(c) for c in LINES.output]).persist()
    try:
        model = L.train(ready, "logistic_regression", LINES.output, "label", {"max_iter": 10})
    finally:
        ready.unpersist()
    return lambda batches: respond(batches, prep, model, BOUNDS, RUN_TS, member_id="l_partkey", limit=LIMIT)


def digest(responses: DataFrame, messages: DataFrame) -> DataFrame:
    texts = messages.groupBy("batch_id").agg(F.sort_array(F.collect_list(F.struct("position", "message"))).alias("m"))
    return responses.join(texts, "batch_id", "left").select(
        "batch_id",
        "n_members",
        "n_invalid",
        "status",
        F.size(F.coalesce("predictions", F.array())).cast("bigint").alias("n_answers"),
        F.coalesce(F.array_join("m.message", " | "), F.lit("")).alias("messages"),
    )


@query("respond", RESPOND_SQL)
def _(spark, sf):
    return digest(*answering(spark, sf)(requests(spark, sf)))


@query("stream_respond", RESPOND_SQL)
def _(spark, sf):
    """The same requests as files of a stream, answered in several micro-batches."""
    root = workspace(spark, "requests")
    files = request_files(lines(spark, sf).count())
    requests(spark, sf).repartition(files).write.parquet(f"{root}/in")
    schema = spark.read.parquet(f"{root}/in").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files // 2).parquet(f"{root}/in")
    stream_respond(stream, answering(spark, sf), f"{root}/out", f"{root}/state")
    return digest(spark.read.parquet(f"{root}/out/responses"), spark.read.parquet(f"{root}/out/messages"))
