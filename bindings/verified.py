"""Fits whose numbers SQL can find again: optimum conditions, trees grown in SQL, calibration steps."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from bindings.base import FEATURES, KEY, LABEL_SQL, LINES, SCORED, label, lines, query, scored_lines, workspace
from bindings.fitting import NUMERIC, _prep_sql, _scaled
from bindings.projections import ENGINEERED_SQL
from riskloom.operators import calibration as C
from riskloom.operators import relations as R
from riskloom.operators.models import VECTOR, WEIGHT, distinct_rows, stable_layout, weighted_fit
from riskloom.operators.stage import fit_scoring

# --- one saved object, and the conditions that its fit must meet ---------------------------------

TARGET_SQL = f"case when {LABEL_SQL} then 1 else 0 end"
MOMENT_SQL = f"""with {ENGINEERED_SQL}, {_prep_sql("engineered")},
  labels as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, {TARGET_SQL} as y from lineitem),
  wide as (
    select count(*) as n, sum(y) as positives,
           {", ".join(f"sum(y * {_scaled(c)}) as {c}" for c in NUMERIC)},
           {", ".join(f"sum(y * {c}::int) as {c}" for c in LINES.dummies)}
    from engineered join labels using (l_orderkey, l_linenumber, l_partkey, l_suppkey), med, quart)
"""
MOMENT_ROWS = " union all ".join(
    [f"select '{c}' as feature, round({c} / n, 3) + 0::double as moment from wide" for c in LINES.output]
    + ["select 'intercept', round(positives / n, 3) + 0::double from wide"]
)
#: Tight enough for the conditions to hold to the digits shown.
EXACT = {"tol": 1e-12, "c": 1.0}


def labelled_lines(spark, sf):
    return lines(spark, sf).select(*KEY, *FEATURES).withColumn("label", label().cast("double"))


def _saved_pipeline(spark, sf):
    """(rows, the pipeline from raw rows to probabilities, saved and loaded again)."""
    df = labelled_lines(spark, sf).persist()
    path = f"{workspace(spark, 'models')}/pipeline"
    fit_scoring(df, LINES, "logistic_regression", EXACT).write().save(path)
    return df, PipelineModel.load(path)


@query("pipeline_scoring", MOMENT_SQL + MOMENT_ROWS)
def _(spark, sf):
    """Expected feature sums under the loaded pipeline's probabilities, a row; at the optimum they are the observed ones."""
    df, model = _saved_pipeline(spark, sf)
    names = LINES.output
    weights = R.coefficients(spark, model, names)
    penalty = weights.select(F.coalesce("feature", F.lit("intercept")).alias("feature"), F.when(F.col("feature").isNull(), 0.0).otherwise(F.col("weight")).alias("w"))
    scored = model.transform(df).select(vector_to_array(VECTOR).alias("x"), vector_to_array("probability")[1].alias("p"))
    sums = scored.agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col("x")[i] * F.col("p")).alias(c) for i, c in enumerate(names)], F.sum("p").alias("intercept")
    )
    long = sums.unpivot(["n"], [*names, "intercept"], "feature", "expected")
    return long.join(penalty, "feature").select(
        "feature", (F.round((F.col("expected") + F.col("w")) / F.col("n"), 3) + F.lit(0.0)).alias("moment")
    )


@query("fit_conditions", MOMENT_SQL + MOMENT_ROWS)
def _(spark, sf):
    """The same conditions from the table of coefficients alone, without the library that fitted them."""
    df, model = _saved_pipeline(spark, sf)
    prep = model.stages[0].prep
    ready = prep.transform(df).select("label", *[F.col(c).cast("double").alias(c) for c in LINES.output])
    conditions = R.linear_certificate(ready, R.coefficients(spark, model, LINES.output), "label", EXACT["c"])
    n = df.count()
    return conditions.select(
        F.coalesce("feature", F.lit("intercept")).alias("feature"), (F.round(F.col("explained") / n, 3) + F.lit(0.0)).alias("moment")
    )


# --- trees grown in SQL ---------------------------------------------------------------------------

SPLITS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def grown(name: str, source: str, target: str, depth: int) -> str:
    """CTEs of a regression tree over ``source``: ``{name}{depth}`` holds its rows with their node and ``{name}_leaf``.

    Greedy splits by variance (for 0/1 targets half the Gini impurity) at the midpoints of neighbouring values.
    """
    parts = [f"{name}0 as (select *, 1 as node, ({target})::double as goal from {source})"]
    for k in range(depth):
        values = " union all ".join(f"select node, {i} as f, {c}::double as v, goal from {name}{k}" for i, c in enumerate(SPLITS))
        goes = " ".join(f"when {i} then {c}" for i, c in enumerate(SPLITS))
        parts.append(f"""{name}{k}v as (
  select node, f, v, count(*) as n, sum(goal) as s, sum(goal * goal) as q from ({values}) where node >= {2**k} group by all)""")
        parts.append(f"""{name}{k}c as (
  select node, f, (v + lead(v) over w) / 2 as cut, sum(n) over (w rows unbounded preceding) as n, sum(s) over (w rows unbounded preceding) as s,
         sum(n) over (partition by node, f) as tn, sum(s) over (partition by node, f) as ts
  from {name}{k}v window w as (partition by node, f order by v))""")
        parts.append(f"""{name}{k}b as (
  select node, f, cut from (
    select *, row_number() over (partition by node order by round(gain, 12) desc, f, cut) as place
    from (select node, f, cut, (s * s / n + (ts - s) * (ts - s) / (tn - n) - ts * ts / tn) / tn as gain
          from {name}{k}c where cut is not null))
  where place = 1 and gain > 1e-12)""")
        parts.append(f"""{name}{k + 1} as (
  select r.* exclude (node), case when b.node is null then r.node
         when case b.f {goes} end <= cut then 2 * r.node else 2 * r.node + 1 end as node
  from {name}{k} r left join {name}{k}b b on b.node = r.node)""")
    return ",\n".join(parts)


def merged(name: str, depth: int) -> str:
    """CTEs that join sibling leaves of one class, from the deepest level up; ``{name}_m0`` holds the rows."""
    parts = [f"{name}_m{depth} as (select * from {name}{depth})"]
    for k in range(depth - 1, -1, -1):
        parts.append(f"""{name}_j{k} as (
  select node // 2 as parent from (select node, avg(goal) > 0.5 as positive from {name}_m{k + 1} group by node)
  where node >= {2 ** (k + 1)} and node < {2 ** (k + 2)}
  group by parent having count(*) = 2 and count(distinct positive) = 1)""")
        parts.append(f"""{name}_m{k} as (
  select r.* exclude (node), coalesce(j.parent, r.node) as node from {name}_m{k + 1} r left join {name}_j{k} j on j.parent = r.node // 2 and r.node >= {2 ** (k + 1)} and r.node < {2 ** (k + 2)})""")
    return ",\n".join(parts)


TREE_DEPTH, BOOST_DEPTH, ROUNDS, RATE = 4, 2, 3, 0.1


def _split_rows(spark, sf):
    """All lines as the distinct rows of what the trees see, each with its number of lines."""
    df = lines(spark, sf).withColumn("label", label().cast("double"))
    cells = distinct_rows(df, [*SPLITS, "label"]).persist()
    return stable_layout(cells, [*SPLITS, "label"]).persist()


def _leaf_sums(scored):
    return scored.groupBy(F.round("probability", 6).alias("probability")).agg(
        F.sum(WEIGHT).cast("bigint").alias("n"), F.sum(F.col(WEIGHT) * F.col("label")).cast("bigint").alias("positives")
    )


@query(
    "tree_leaves",
    f"""with rows0 as (select *, {TARGET_SQL} as label from lineitem),
        {grown("t", "rows0", "label", TREE_DEPTH)}, {merged("t", TREE_DEPTH)}
        select round(probability, 6) as probability, sum(n)::bigint as n, sum(positives)::bigint as positives
        from (select node, avg(goal) as probability, count(*) as n, sum(goal) as positives from t_m0 group by node) group by 1""",
)
def _(spark, sf):
    """A classification tree on all rows, exported as nodes and scored by a join: rows and positives per leaf value."""
    df = _split_rows(spark, sf)
    forest = RandomForestClassifier(
        featuresCol=VECTOR, labelCol="label", weightCol=WEIGHT, numTrees=1, maxDepth=TREE_DEPTH, maxBins=64, bootstrap=False, featureSubsetStrategy="all", seed=1
    )
    model = Pipeline(stages=[VectorAssembler(inputCols=SPLITS, outputCol=VECTOR), forest]).fit(df)
    scored = R.score_trees(df, SPLITS, R.tree_nodes(spark, model), TREE_DEPTH, boosted=False)
    return _leaf_sums(scored)


def _boosted_sql() -> str:
    parts, so_far, source = [], "", "rows0"
    for k in range(ROUNDS):
        target = "2 * label - 1" if k == 0 else f"4 * (2 * label - 1) / (1 + exp(2 * (2 * label - 1) * ({so_far})))"
        parts.append(grown(f"g{k}_", source, target, BOOST_DEPTH))
        parts.append(f"g{k} as (select * exclude (node, goal), avg(goal) over (partition by node) as f{k} from g{k}_{BOOST_DEPTH})")
        so_far += "f0" if k == 0 else f" + {RATE} * f{k}"
        source = f"g{k}"
    return f"""with rows0 as (select *, {TARGET_SQL} as label from lineitem), {", ".join(parts)}
        select round(1 / (1 + exp(-2 * ({so_far}))), 6) as probability, count(*) as n, sum(label)::bigint as positives
        from g{ROUNDS - 1} group by 1"""


@query("boosted_scores", _boosted_sql())
def _(spark, sf):
    """Boosting rounds on all rows, exported as nodes and scored by a join: rows and positives per probability."""
    df = _split_rows(spark, sf)
    boosted = GBTClassifier(featuresCol=VECTOR, labelCol="label", weightCol=WEIGHT, maxIter=ROUNDS, maxDepth=BOOST_DEPTH, maxBins=64, stepSize=RATE, seed=1)
    model = Pipeline(stages=[VectorAssembler(inputCols=SPLITS, outputCol=VECTOR), boosted]).fit(df)
    scored = R.score_trees(df, SPLITS, R.tree_nodes(spark, model), BOOST_DEPTH, boosted=True)
    return _leaf_sums(scored)


# --- calibration ------------------------------------------------------------------------------------

GRID = 256


@query(
    "isotonic_calibration",
    f"""with {SCORED},
        cells as (select floor(probability * {GRID}) as cell, min(probability) as low, max(probability) as high, count(*) as n, sum(label) as y
                  from scored group by 1),
        sums as (select *, row_number() over w as i, sum(n) over w as cn, sum(y) over w as cy from cells window w as (order by cell)),
        means as (select a.i as a, b.i as b, (b.cy - a.cy + a.y) / (b.cn - a.cn + a.n)::double as mean
                  from sums a join sums b on b.i >= a.i),
        ends as (select a, b, min(mean) over (partition by a order by b desc) as least from means),
        fitted as (select b as i, max(least) over (partition by b order by a) as value from ends qualify a = b)
        select round(value, 6) as value, round(min(low), 6) as low, round(max(high), 6) as high, sum(n)::bigint as n
        from sums join fitted using (i) group by 1""",
)
def _(spark, sf):
    """Isotonic steps of the line scores; in SQL by the max-min formula over all runs of cells."""
    steps = C.isotonic_steps(scored_lines(spark, sf), "probability", "label", GRID)
    return steps.groupBy(F.round("value", 6).alias("value")).agg(
        F.round(F.min("low"), 6).alias("low"), F.round(F.max("high"), 6).alias("high"), F.sum("n").alias("n")
    )


FOLD_SQL = f"""('0x' || substr(md5(concat_ws(';', '42', {", ".join(f"coalesce({k}::varchar, 'n')" for k in KEY)})), 1, 8))::bigint % {C.FOLDS}"""


@query(
    "held_out_folds",
    f"""with r as (select {FOLD_SQL} as fold, {TARGET_SQL} as y from lineitem)
        select fold::int as fold, count(*) as n, sum(y)::bigint as positives, round(sum(sum(y)) over (), 1)::double as expected
        from r group by fold""",
)
def _(spark, sf):
    """Rows and positives per fold of the cross-fitted SVM, and the positives that Platt's step expects over all folds."""
    df = labelled_lines(spark, sf)
    features = ["l_quantity", "l_extendedprice", "l_discount"]
    scaled = df.withColumns({"l_extendedprice": F.col("l_extendedprice") / 10_000, "l_quantity": F.col("l_quantity") / 10})
    margins = C.held_out_margins(scaled, features, "label", KEY, params={"max_iter": 100})
    sliced = VectorSlicer(inputCol="margins", outputCol="margin", indices=[1]).transform(margins)
    margin = vector_to_array("margin")[0]
    cells = distinct_rows(sliced.select("fold", "label", margin.alias("value")), ["fold", "label", "value"]).persist()
    platt = weighted_fit(cells, ["value"], "label", [LogisticRegression(featuresCol=VECTOR, labelCol="label", predictionCol="platt", tol=1e-12)])
    expected = platt.transform(cells).agg(F.round(F.sum(F.col(WEIGHT) * vector_to_array("probability")[1]), 1)).first()[0]
    return cells.groupBy("fold").agg(
        F.sum(WEIGHT).cast("bigint").alias("n"), F.sum(F.col(WEIGHT) * F.col("label")).cast("bigint").alias("positives"), F.lit(expected).alias("expected")
    )
