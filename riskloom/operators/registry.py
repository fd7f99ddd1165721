"""Run log as append-only tables, model registry as one committed file a version (MOD-13..16)."""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import as_datetime

STAGE_ORDER = ("Production", "Staging", "None")
RUNS = "run_id string, run_name string, logged_at timestamp"
PARAMS = "run_id string, name string, value string"
METRICS = "run_id string, name string, value double"
VERSIONS = (
    "name string, version bigint, stage string, run_id string, model_path string, "
    "tags map<string,string>, created_at timestamp"
)


def log_run(spark: SparkSession, root: str, run_name: str, params: dict, metrics: dict, logged_at) -> str:
    """Append one run to the ``runs``, ``run_params`` and ``run_metrics`` tables."""
    run_id = uuid.uuid4().hex
    tables = {
        "runs": ([(run_id, run_name, as_datetime(logged_at))], RUNS),
        "run_params": ([(run_id, str(k), str(v)) for k, v in params.items()], PARAMS),
        "run_metrics": ([(run_id, str(k), None if v is None else float(v)) for k, v in metrics.items()], METRICS),
    }
    for name, (rows, schema) in tables.items():
        if rows:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/{name}")
    return run_id


def run_leaderboard(runs: DataFrame, metrics: DataFrame, names: list[str], order_by: str = "f1_score") -> DataFrame:
    """One row per run with its metrics side by side, best first.

    The pivot has a declared value list, so it is a single grouped aggregation.
    """
    wide = metrics.groupBy("run_id").pivot("name", list(names)).agg(F.max("value"))
    return runs.join(wide, "run_id", "left").orderBy(F.desc_nulls_last(order_by), F.asc("run_name"))


def latest_version(registry: DataFrame, stages=STAGE_ORDER, name: str = "name", version: str = "version") -> DataFrame:
    """Newest version per name in the most preferred stage.

    ``max_by`` keeps one candidate per name in every partition, so a name with
    any number of versions is never sorted in one task.
    """
    rank = None
    for i, stage in enumerate(stages):
        test = F.col("stage") == F.lit(stage)
        rank = F.when(test, F.lit(i)) if rank is None else rank.when(test, F.lit(i))
    known = registry.withColumn("__rank", rank).where(F.col("__rank").isNotNull())
    row = F.struct(*[F.col(c) for c in registry.columns if c != name])
    best = known.groupBy(name).agg(F.max_by(row, F.struct(-F.col("__rank"), F.col(version))).alias("__best"))
    return best.select(name, "__best.*")


def committed_versions(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The versions of a model, a row each; what a writer has not committed is no version."""
    path = f"{root}/model_versions/{name}"
    if not _file_system(spark, path).exists(_hadoop_path(spark, path)):
        return spark.createDataFrame([], VERSIONS)
    return spark.read.schema(VERSIONS).json(path)


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def commit_file(spark: SparkSession, text: str, target: str) -> bool:
    """Put ``text`` at ``target`` unless something is there; whether it was put. The file appears whole or not at all.

    The text is written beside it under a name that readers skip, and then moved without replacing: a hard link on a
    local disk, a rename that the file system refuses if the name is taken elsewhere.
    """
    fs, to = _file_system(spark, target), _hadoop_path(spark, target)
    beside = _hadoop_path(spark, f"{to.getParent().toString()}/_{uuid.uuid4().hex}")
    stream = fs.create(beside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            os.link(beside.toUri().getPath(), to.toUri().getPath())
        else:
            jvm = spark._jvm
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(beside, to, none)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        return False
    finally:
        fs.delete(beside, False)


def register(
    spark: SparkSession, root: str, name: str, run_id: str, model_path: str, tags: dict, created_at, stage: str = "None"
) -> int:
    """Commit the next version of a model and return its number.

    A version is one file named by its number, which only one writer can create. Who comes second takes the next
    number, so writers in parallel get different numbers without gaps.
    """
    row = {
        "name": name,
        "stage": stage,
        "run_id": run_id,
        "model_path": model_path,
        "tags": {k: str(v) for k, v in tags.items()},
        "created_at": as_datetime(created_at).isoformat(),
    }
    folder = f"{root}/model_versions/{name}"
    _file_system(spark, folder).mkdirs(_hadoop_path(spark, folder))
    version = committed_versions(spark, root, name).agg(F.max("version")).first()[0] or 0
    while True:
        version += 1
        if commit_file(spark, json.dumps({**row, "version": version}) + "\n", f"{folder}/{version:010d}.json"):
            return version


def _best_version(spark: SparkSession, root: str, name: str):
    return latest_version(committed_versions(spark, root, name)).first()


def load_champion(spark: SparkSession, root: str, name: str, fallback: str | None = None):
    """The preferred registered model, or the one at ``fallback`` when none is registered."""
    from riskloom.operators.models import load_model

    best = _best_version(spark, root, name)
    if best:
        return load_model(best["model_path"]), str(best["version"])
    if fallback is None:
        raise FileNotFoundError(f"no registered model named {name} and no fallback given")
    return load_model(fallback), "fallback"


def load_scorer(spark: SparkSession, root: str, name: str, fallback: str | None = None):
    """(preprocessing, model, version): all a new session needs to score raw rows.

    The training job saves both parts of a version in one folder, ``model`` beside ``prep``;
    ``fallback`` is such a model path.
    """
    from riskloom.operators.prep import PrepModel

    best = _best_version(spark, root, name)
    path = best["model_path"] if best else fallback
    model, version = load_champion(spark, root, name, fallback)
    return PrepModel.load(spark, f"{path.rstrip('/').rpartition('/')[0]}/prep"), model, version
