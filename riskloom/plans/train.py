"""Training job: split, prepare, baselines, search, gate, then register."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.config import DEPLOY_MINIMUMS, FeatureConfig
from riskloom.operators.metrics import gate, pick_best
from riskloom.operators.models import (
    FAMILIES,
    SEED,
    TRIALS,
    TrainedModel,
    baselines,
    evaluate,
    results_table,
    save_model,
    search,
    stable_layout,
)
from riskloom.operators.prep import PrepModel
from riskloom.operators.registry import log_run, register
from riskloom.operators.rollup import training_report
from riskloom.operators.split import written_split
from riskloom.sources.sinks import write_summary


class GateError(ValueError):
    """The candidate model is below the deployment minimums."""


@dataclass
class TrainResult:
    prep: PrepModel
    results: DataFrame
    champion: TrainedModel
    passed: bool
    failures: list[str] = field(default_factory=list)
    version: int | None = None


def train_job(
    df: DataFrame,
    cfg: FeatureConfig,
    root: str,
    run_ts,
    model_name: str = "champion",
    families: tuple[str, ...] = FAMILIES,
    params: dict[str, dict] | None = None,
    trials: int = TRIALS,
    test_share: float = 0.2,
    minimums: dict[str, float] = DEPLOY_MINIMUMS,
    seed: int = SEED,
    partitions: int | None = None,
    strict: bool = True,
) -> TrainResult:
    """Run the whole training flow and register the champion only if it passes the gate.

    ``root`` is a folder in shared storage that holds splits, models, run log and
    registry.
    """
    spark, key = df.sparkSession, list(cfg.key)
    train_raw, test_raw = written_split(df, cfg.label, test_share, seed, key, f"{root}/splits")
    prep = PrepModel(cfg).fit(train_raw)
    names = cfg.output

    def ready(part: DataFrame) -> DataFrame:
        columns = [F.col(c).cast("double").alias(c) for c in names]
        return prep.transform(part).select(*key, F.col(cfg.label).cast("double").alias(cfg.label), *columns)

    train_df = stable_layout(ready(train_raw), key, partitions, train_raw.count()).persist()
    test_df = ready(test_raw).persist()
    try:
        trained = baselines(train_df, test_df, names, cfg.label, families, params, seed)
        results = results_table(spark, trained)
        for t in trained:
            log_run(spark, root, f"baseline_{t.family}", t.params, t.metrics, run_ts)
        best = pick_best(results).first()
        if best is None:
            raise GateError("no family reached an F1 above 0")
        champion = next(t for t in trained if t.family == best["model"])
        tuned = search(train_df, champion.family, names, cfg.label, trials, seed=seed) if trials else None
        if tuned is not None:
            tuned.metrics = evaluate(tuned.model, test_df, cfg.label)
            champion = tuned
            log_run(spark, root, f"optimized_{tuned.family}", tuned.params, tuned.metrics, run_ts)
        verdict = gate(results_table(spark, [champion]), minimums).first()
        n_train, n_test = train_df.count(), test_df.count()
        report = training_report(
            spark, run_ts, n_train, n_test, len(cfg.features), champion.metrics, bool(verdict["passed"])
        )
        write_summary(report, f"{root}/reports", mode="append")
        if not verdict["passed"]:
            if strict:
                raise GateError(f"below deployment minimums: {list(verdict['failures'])}")
            return TrainResult(prep, results, champion, False, list(verdict["failures"]))
        run_id = log_run(spark, root, f"champion_{champion.family}", champion.params, champion.metrics, run_ts)
        path = f"{root}/models/{run_id}"
        save_model(champion.model, f"{path}/model")
        prep.save(spark, f"{path}/prep")
        tags = {"validation_status": "approved", "model_type": champion.family}
        version = register(spark, root, model_name, run_id, f"{path}/model", tags, run_ts)
        return TrainResult(prep, results, champion, True, [], version)
    finally:
        train_df.unpersist()
        test_df.unpersist()
