"""Seeded exact stratified split (FIT-1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.joins import join_small
from riskloom.session import cut_lineage
from riskloom.sources.sinks import write_table

#: Hex digits that a step adds to a class's boundary prefix, and digits in all.
STEP_DIGITS = 3
HASH_DIGITS = 32
_ABOVE = "g"  # sorts after every hex digit


def split_hash(seed: int, key: list[str]) -> Column:
    """md5 of the seed and the key: the same on every engine, run and partitioning.

    Every part is written with its length and a NULL with none, so different keys never read alike.
    """
    parts = [F.lit(f"{seed};")]
    for k in key:
        text = F.col(k).cast("string")
        parts.append(F.when(text.isNull(), F.lit("n;")).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text, F.lit(";"))))
    return F.md5(F.concat(*parts))


def _boundaries(rows: DataFrame, label: str, take: Column, at: int, digits: int) -> DataFrame:
    """Per class of ``rows``: the next digits of the prefix that holds the last wanted row.

    Returns (label, __prefix, __take, __n): rows wanted of that prefix, and rows in it. Counts of at most 16**digits prefixes a class
    are all that meets.
    """
    hist = rows.groupBy(label, F.substring("__h", 1, at + digits).alias("__p")).agg(
        F.count("*").alias("n"), F.first("__take").alias("__take")
    )
    cells = hist.groupBy(label).agg(
        F.sort_array(F.collect_list(F.struct("__p", "n"))).alias("cells"), F.sum("n").alias("__total"), F.first("__take").alias("__take")
    )
    cells = cells.withColumn("__take", take)

    def step(state: Column, cell: Column) -> Column:
        upto = state["upto"] + cell["n"]
        here = state["p"].isNull() & (upto >= F.col("__take"))
        return F.struct(
            F.when(state["p"].isNull(), upto).otherwise(state["upto"]).alias("upto"),
            F.when(here, cell["__p"]).otherwise(state["p"]).alias("p"),
            F.when(here, cell["n"]).otherwise(state["n"]).alias("n"),
        )

    nothing = F.lit(0).cast("bigint")
    start = F.struct(nothing.alias("upto"), F.lit(None).cast("string").alias("p"), nothing.alias("n"))
    found = cells.withColumn("__f", F.aggregate("cells", start, step))
    return found.select(
        label,
        F.col("__f.p").alias("__prefix"),
        (F.col("__take") - F.col("__f.upto") + F.col("__f.n")).alias("__take"),
        F.col("__f.n").alias("__n"),
    )


def class_cuts(slim: DataFrame, label: str, frac: float, digits: int = STEP_DIGITS) -> DataFrame:
    """(label, __cut) per class of ``slim(label, __h)``: the quota's rows are those with ``__h <= __cut``.

    A step counts prefixes of all classes at once and keeps the rows of each class's boundary prefix, one in
    16**digits; it ends when every boundary prefix is wanted whole.
    """
    rows = slim.withColumn("__take", F.lit(None).cast("bigint"))
    take = F.ceil(F.round(F.col("__total") * F.lit(float(frac)), 9)).cast("bigint")
    settled, at = [], 0
    while True:
        edges = cut_lineage(_boundaries(rows, label, take, at, digits))  # a row a class
        at = min(at + digits, HASH_DIGITS)
        whole = F.col("__take") >= F.col("__n")
        cut = F.when(F.col("__take") <= 0, F.lit("")).otherwise(F.concat("__prefix", F.lit(_ABOVE)))
        settled.append(edges.where(whole | (F.col("__take") <= 0)).select(label, cut.alias("__cut")))
        still = edges.where(~whole & (F.col("__take") > 0)).select(label, F.col("__prefix").alias("__p"), "__take")
        if not still.limit(1).count():
            return reduce(DataFrame.unionByName, settled)
        if at == HASH_DIGITS:
            raise ValueError("split key is not unique at the class boundary")
        inside = rows.drop("__take").withColumn("__p", F.substring("__h", 1, at))
        rows = cut_lineage(join_small(inside, still, [label, "__p"], "inner").select(label, "__h", "__take"))
        take = F.col("__take")


def mark_test(
    df: DataFrame,
    label: str,
    frac: float,
    seed: int,
    key: list[str],
    digits: int | None = None,
    out: str = "is_test",
) -> DataFrame:
    """Flag exactly ``ceil(frac * n)`` rows of every class as test rows.

    Rows are ordered by hash inside their class, but no class is ever sorted: ``class_cuts`` narrows the hash at which
    the quota is reached by counting prefixes. The result is one cut hash per class; marking the table is then a
    narrow comparison. ``key`` must identify a row. Rows without a label stay in the training part.
    """
    hashed = df.withColumn("__h", split_hash(seed, key))
    slim = hashed.select(label, "__h").where(F.col(label).isNotNull())
    marked = join_small(hashed, class_cuts(slim, label, frac, digits or STEP_DIGITS), [label], "left")
    test = F.coalesce(F.col("__h") <= F.col("__cut"), F.lit(False))
    return marked.withColumn(out, test).select(*df.columns, out)


def stratified_split(
    df: DataFrame, label: str, frac: float, seed: int, key: list[str], digits: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(train, test); see :func:`mark_test`."""
    marked = mark_test(df, label, frac, seed, key, digits, "__is_test")
    return (
        marked.where(~F.col("__is_test")).drop("__is_test"),
        marked.where(F.col("__is_test")).drop("__is_test"),
    )


def written_split(
    df: DataFrame, label: str, frac: float, seed: int, key: list[str], path: str
) -> tuple[DataFrame, DataFrame]:
    """(train, test) read back from ``path`` in shared storage, partitioned by side.

    The table is hashed and marked once; every later pass prunes to its side and
    its columns, and no lineage reaches further back than the written table.
    """
    marked = mark_test(df, label, frac, seed, key, out="__is_test")
    part = F.when(F.col("__is_test"), F.lit("test")).otherwise(F.lit("train"))
    write_table(marked.withColumn("part", part).drop("__is_test"), path, partition_by=["part"])
    splits = df.sparkSession.read.parquet(path)
    train, test = (splits.where(F.col("part") == side).drop("part") for side in ("train", "test"))
    return train, test


def union_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.unionByName(test)
