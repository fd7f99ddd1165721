"""Distributed training and scoring on lineitem. Model numbers have no SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.base import FEATURES, KEY, LINES, label, lines, query, rounded, table, workspace
from bindings.streams import with_scores
from riskloom.operators import models as L
from riskloom.operators.metrics import comparison, pick_best
from riskloom.operators.prep import PrepModel
from riskloom.operators.profile import prediction_summary
from riskloom.operators.split import written_split
from riskloom.plans.predict import score_table

NAMES = LINES.output


def labeled(spark, sf):
    return lines(spark, sf).select(*KEY, *FEATURES).withColumn("label", label())


def split_prepared(spark, sf):
    """(prep, raw train rows, raw test rows, rows to features): exact 80/20 split, fit on train only."""
    train, test = written_split(labeled(spark, sf), "label", 0.2, L.SEED, KEY, workspace(spark, "splits"))
    prep = PrepModel(LINES).fit(train)

    def ready(df):
        kept = [c for c in (*KEY, L.WEIGHT) if c in df.columns]
        columns = [F.col(c).cast("double").alias(c) for c in NAMES]
        return prep.transform(df).select(*kept, F.col("label").cast("double").alias("label"), *columns)

    return prep, train, test, ready


def prepared(spark, sf):
    """(prep, raw test rows, prepared train rows, prepared test rows)."""
    prep, train, test, ready = split_prepared(spark, sf)
    return prep, test, ready(train), ready(test)


def _trained(spark, sf, families):
    """Metrics of the families. Prepared rows are made anew for each pass; of a table only its distinct raw rows are held."""
    _prep, train, test, ready = split_prepared(spark, sf)
    distinct = None
    if any(f in L.LINEAR for f in families):
        distinct = L.laid_distinct(train, [*FEATURES, "label"], train.count()).persist()
    try:
        trained = L.baselines(
            ready(train), ready(test), NAMES, "label", families, key=KEY, distinct=ready(distinct) if distinct is not None else None
        )
    finally:
        if distinct is not None:
            distinct.unpersist()
    return L.results_table(spark, trained)


def _family(spark, sf, family):
    return rounded(_trained(spark, sf, (family,)))


@query("logistic_regression")
def _(spark, sf):
    return _family(spark, sf, "logistic_regression")


@query("random_forest")
def _(spark, sf):
    return _family(spark, sf, "random_forest")


@query("gradient_boosting")
def _(spark, sf):
    return _family(spark, sf, "gradient_boosting")


@query("svm")
def _(spark, sf):
    return _family(spark, sf, "svm")


@query("baselines")
def _(spark, sf):
    """Sweep over all families, best first, with the winner marked."""
    results = _trained(spark, sf, L.FAMILIES)
    best = pick_best(results).select(F.col("model").alias("winner"))
    ordered = comparison(results)
    return rounded(ordered.withColumn("is_best", F.col("model") == best.scalar()))


@query("hyperparameter_search")
def _(spark, sf):
    """Seeded random search over the forest ranges on the events, refit, test metrics of the refitted model."""
    names = ["value", "shift", "hour"]
    events = with_scores(table(spark, sf, "events")).select(
        "event_id",
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("shift"),
        F.hour("ts").cast("double").alias("hour"),
        F.col("label").cast("double").alias("label"),
    )
    train, test = written_split(events, "label", 0.2, L.SEED, ["event_id"], workspace(spark, "splits"))
    train, test = L.stable_layout(train, ["event_id"]).persist(), test.persist()
    try:
        tuned = L.search(train, "random_forest", names, "label")
        tuned.metrics = L.evaluate(tuned.model, test, "label")
    finally:
        train.unpersist()
        test.unpersist()
    return rounded(L.results_table(spark, [tuned]))


@query("feature_importances")
def _(spark, sf):
    _prep, _raw, train, _test = prepared(spark, sf)
    model = L.train(train, "random_forest", NAMES, "label", key=KEY)
    return rounded(L.importances(model, NAMES, spark))


@query(
    "scoring_facts",
    """select count(*) as n_rows, 0::bigint as n_lost, 0::bigint as n_outside, 0::bigint as n_inconsistent, true as beats_majority
       from lineitem""",
)
def _(spark, sf):
    """What must hold for scored lines whatever the model's weights are."""
    prep, raw, train, _test = prepared(spark, sf)
    model = L.train(train, "logistic_regression", NAMES, "label")
    everything = labeled(spark, sf)
    scored = score_table(everything, prep, model)
    lost = everything.select(*KEY).exceptAll(scored.select(*KEY)).count()
    share = raw.agg(F.avg("label")).first()[0]
    right = score_table(raw, prep, model).agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
    return scored.agg(
        F.count("*").alias("n_rows"),
        F.lit(lost).cast("bigint").alias("n_lost"),
        F.count_if(~F.col("probability").between(0, 1)).alias("n_outside"),
        F.count_if((F.col("probability") > 0.5) != (F.col("prediction") == 1)).alias("n_inconsistent"),
        F.lit(right >= max(share, 1 - share)).alias("beats_majority"),
    )


@query(
    "importance_facts",
    "select 12::bigint as n_features, 0::bigint as n_negative, 1::double as total where (select count(*) from lineitem) > 0",
)
def _(spark, sf):
    _prep, _raw, train, _test = prepared(spark, sf)
    found = L.importances(L.train(train, "gradient_boosting", NAMES, "label"), NAMES, spark)
    return found.agg(
        F.count("*").alias("n_features"),
        F.count_if(F.col("importance") < 0).alias("n_negative"),
        F.round(F.sum("importance"), 6).alias("total"),
    )


@query("batch_scoring")
def _(spark, sf):
    """Score every line from its raw columns and summarise per risk category."""
    prep, _raw, train, _test = prepared(spark, sf)
    model = L.train(train, "logistic_regression", NAMES, "label")
    scored = score_table(lines(spark, sf).select(*KEY, *FEATURES), prep, model)
    return rounded(prediction_summary(scored, keys=["risk_category"]))
