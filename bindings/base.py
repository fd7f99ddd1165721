"""Query registry, shared table bindings and shared SQL fragments."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.config import Bin, FeatureConfig
from riskloom.session import shared_dir
from riskloom.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, when given, its SQL twin."""

    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet")


def workspace(spark: SparkSession, kind: str) -> str:
    """A new folder in the shared storage of the session."""
    return shared_dir(spark, kind, uuid.uuid4().hex)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round floating columns and drop the sign of a zero."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in floating}) if floating else df


# --- lineitem as the feature table ---------------------------------------------

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
ROW = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

LINES = FeatureConfig(
    features=tuple(FEATURES),
    zero_missing=("l_discount", "l_tax"),
    bins=(
        Bin("l_quantity", (0, 10, 25, 40, 50), ("tiny", "small", "medium", "large"), "quantity_band"),
        Bin("l_extendedprice", (0, 30000, 60000, 90000), ("low", "mid", "high"), "price_band"),
    ),
    products=(("l_extendedprice", "l_discount", "rebate"),),
    ratios=(("l_extendedprice", "l_quantity", "unit_price"),),
    flags=(("l_quantity", 25, "bulk"),),
    label="label",
    key=tuple(KEY),
)

PROBABILITY_SQL = "1 / (1 + exp(-((l_extendedprice - 52000) / 20000)))"
LABEL_SQL = "l_extendedprice * (1 - l_discount) + 400 * (l_quantity - 25.5::double) > 52000"
SCORED = f"""scored as (
  select *, {PROBABILITY_SQL} as probability,
         case when {PROBABILITY_SQL} > 0.5::double then 1 else 0 end as prediction,
         case when {LABEL_SQL} then 1 else 0 end as label
  from lineitem)"""
BAND_SQL = """case when l_quantity > 0 and l_quantity <= 10 then 'tiny'
       when l_quantity > 10 and l_quantity <= 25 then 'small'
       when l_quantity > 25 and l_quantity <= 40 then 'medium'
       when l_quantity > 40 and l_quantity <= 45 then 'large' end"""
SPLIT_DAY = "1998-06-01"


def probability() -> Column:
    return F.lit(1) / (F.lit(1) + F.exp(-((F.col("l_extendedprice") - F.lit(52000)) / F.lit(20000))))


def label() -> Column:
    worth = F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")) + F.lit(400) * (
        F.col("l_quantity") - F.lit(25.5)
    )
    return (worth > F.lit(52000)).cast("int")


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem")


def scored_lines(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem with a deterministic probability, prediction and label."""
    return (
        lines(spark, sf)
        .withColumn("probability", probability())
        .withColumns({"prediction": (F.col("probability") > F.lit(0.5)).cast("int"), "label": label()})
    )


def snapshots(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reference, current) by ship date."""
    day = F.expr(f"timestamp_ntz '{SPLIT_DAY}'")
    return df.where(F.col("l_shipdate") < day), df.where(F.col("l_shipdate") >= day)


REF_SQL = f"l_shipdate < timestamp '{SPLIT_DAY}'"
CUR_SQL = f"l_shipdate >= timestamp '{SPLIT_DAY}'"
