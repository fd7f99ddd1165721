"""Sources (SRC rows)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.config import RENAME_MAP
from riskloom.operators.projection import binary_label, nulls_for_nan, rename

REQUEST_SCHEMA = (
    "batch_id string, patients array<struct<patient_id: string, pregnancies: double, glucose: double, "
    "blood_pressure: double, skin_thickness: double, insulin: double, bmi: double, "
    "diabetes_pedigree_function: double, age: double>>, metadata map<string,string>"
)


def _missing_path(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(error)


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as error:
        if _missing_path(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return False
        raise


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    fmt: str = "parquet",
    nan_as_null: bool = True,
) -> DataFrame:
    """Read a table; a path that does not exist is a ``FileNotFoundError`` naming it.

    Text formats need an explicit schema (inference would scan the data twice).
    NaN becomes NULL on the way in; a table known to hold no NaN can skip that
    with ``nan_as_null=False``, so filters on floating columns reach the files.
    """
    if schema is None and fmt in ("csv", "json"):
        raise ValueError(f"an explicit schema is required for {fmt}")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    try:
        df = reader.load(path)
        return nulls_for_nan(df) if nan_as_null else df
    except AnalysisException as error:
        if _missing_path(error):
            raise FileNotFoundError(f"Input table not found: {path}") from error
        raise


def read_with_fallback(primary: Callable[[], DataFrame], fallback: Callable[[], DataFrame]) -> DataFrame:
    """The primary source, or the fallback when the primary path is missing."""
    try:
        return primary()
    except FileNotFoundError:
        return fallback()


def load_labeled(
    df: DataFrame, label_col: str, positive: str, out: str = "target", renames: dict[str, str] = RENAME_MAP
) -> DataFrame:
    """Standard column names and a 0/1 label."""
    labeled = binary_label(df, label_col, positive, "__label").drop(label_col)
    return rename(labeled, renames).withColumnRenamed("__label", out)


def parse_requests(df: DataFrame, col: str, schema: str = REQUEST_SCHEMA) -> DataFrame:
    """JSON request text to a nested request row."""
    return df.select(F.from_json(F.col(col), schema).alias("request")).select("request.*")


def explode_requests(df: DataFrame, batch_key: str = "batch_id", members: str = "patients") -> DataFrame:
    """One row per member of every request, with its batch key. No shuffle."""
    return df.select(batch_key, F.inline(members))
