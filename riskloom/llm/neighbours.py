"""Approximate nearest neighbours with a forest of random-projection trees.

Trees are grown on a bounded sample: a node splits its points by the plane half-way between two of them. Every vector of the
table is sent down every tree. A query walks all trees through one priority queue of planes, nearest plane
first, until the leaves it has reached hold enough vectors; those are reranked by their true distance.

Equal vectors are one entry that carries its few smallest ids (no query can return more of them), so a vector that a
third of the rows share neither fills a leaf nor is searched for again and again.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import query, slices, table
from riskloom.session import cut_lineage

TREES = 10
SAMPLE = 1 << 16  # distinct vectors the trees are grown on, at most
LEAF = 32  # sampled vectors in a leaf, at most
REACH = 10_000  # vectors in the leaves a query visits, repeats over trees counted, at least
REACH_SHARE = 0.8  # and at least this share of the table; recall of even noise in 64 dimensions needs it
SEED = 11
_GROUP_ROWS = 20_000  # index rows that are reranked together, about


class Tree:
    """Planes of one tree; a child below zero is leaf number -1 - child."""

    def __init__(self, points: np.ndarray, leaf: int, seed: int):
        self.normals: list[np.ndarray] = []
        self.offsets: list[float] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self.width = points.shape[1]
        dice = np.random.default_rng(seed)
        todo = [(np.arange(len(points)), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            split = self._split(points, rows, dice) if len(rows) > leaf else None
            if split is None:
                name, self.leaves = -1 - self.leaves, self.leaves + 1
            else:
                normal, offset, left = split
                name = len(self.normals)
                self.normals.append(normal)
                self.offsets.append(offset)
                self.children.append([0, 0])
                todo += [(rows[left], name, 0), (rows[~left], name, 1)]
            if parent >= 0:
                self.children[parent][side] = name

    @staticmethod
    def _split(points: np.ndarray, rows: np.ndarray, dice):
        for _ in range(8):
            a, b = points[dice.choice(rows, 2, replace=False)]
            normal = a - b
            size = float(np.linalg.norm(normal))
            if not np.isfinite(size) or size == 0:
                continue
            normal = normal / size
            offset = float(normal @ ((a + b) / 2))
            left = points[rows] @ normal > offset
            if 0.05 * len(rows) <= left.sum() <= 0.95 * len(rows):
                return normal, offset, left
        return None if len(rows) < 512 else Tree._median(points, rows, dice)

    @staticmethod
    def _median(points: np.ndarray, rows: np.ndarray, dice):
        normal = dice.normal(size=points.shape[1])
        normal /= np.linalg.norm(normal)
        along = points[rows] @ normal
        offset = float(np.median(along))
        left = along > offset
        return (normal, offset, left) if 0 < left.sum() < len(rows) else None

    def pack(self) -> tuple:
        return (
            np.array(self.normals, float).reshape(len(self.normals), self.width),
            np.array(self.offsets, float),
            np.array(self.children, np.int64).reshape(-1, 2),
            self.leaves,
        )


def leaf_of(tree: tuple, vectors: np.ndarray) -> np.ndarray:
    """The leaf each vector ends in."""
    normals, offsets, children, _ = tree
    at = np.zeros(len(vectors), np.int64) if len(normals) else np.full(len(vectors), -1)
    while (inner := np.flatnonzero(at >= 0)).size:
        node = at[inner]
        left = np.einsum("ij,ij->i", vectors[inner], normals[node]) > offsets[node]
        at[inner] = children[node, np.where(left, 0, 1)]
    return -1 - at


def visit(forest: list[tuple], sizes: list[np.ndarray], vector: np.ndarray, reach: int) -> list[tuple[int, int]]:
    """(tree, leaf) in the order of the shared queue until ``reach`` vectors are met and every tree was entered."""
    queue = [(-np.inf, t, 0 if len(tree[0]) else -1) for t, tree in enumerate(forest)]
    heapq.heapify(queue)
    margins = [tree[0] @ vector - tree[1] if len(tree[0]) else None for tree in forest]
    out, met = [], 0
    while queue and (met < reach or queue[0][0] == -np.inf):
        far, t, node = heapq.heappop(queue)
        children = forest[t][2]
        while node >= 0:
            m = margins[t][node]
            near = 0 if m > 0 else 1
            heapq.heappush(queue, (max(far, abs(m)), t, int(children[node, 1 - near])))
            node = int(children[node, near])
        out.append((t, -1 - node))
        met += sizes[t][-1 - node]
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _index(shared, groups: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2000):
            vectors = _matrix(batch.column("vector"))
            for t, tree in enumerate(shared.value):
                leaf = leaf_of(tree, vectors)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((leaf * len(shared.value) + t) % groups),
                        pa.array(np.full(len(leaf), t, np.int32)),
                        pa.array(leaf),
                        batch.column("vid"),
                        batch.column("vector"),
                    ],
                    names=["part", "tree", "leaf", "vid", "vector"],
                )

    return run


def _probe(shared, sizes, groups: int, reach: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, counts = shared.value, sizes.value
        for batch in slices(batches, 200):
            vectors = _matrix(batch.column("vector"))
            found = [visit(forest, counts, v, reach) for v in vectors]
            tree = np.array([t for x in found for t, _ in x], np.int64)
            leaf = np.array([k for x in found for _, k in x], np.int64)
            owner = np.repeat(np.arange(len(found)), [len(x) for x in found])
            part = (leaf * len(forest) + tree) % groups
            order = np.lexsort((part, owner))
            owner, part, keys = owner[order], part[order], (tree << 40 | leaf)[order]
            # one row per query and part, with the leaves to look at there
            starts = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (part[1:] != part[:-1])][: len(keys)])
            lists = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(keys)], pa.int32()), pa.array(keys))
            at = pa.array(owner[starts])
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[starts]), batch.column("vid").take(at), lists, batch.column("vector").take(at)],
                names=["part", "qid", "keys", "vector"],
            )

    return run


_FOUND = pa.schema([("qid", pa.int64()), ("vid", pa.int64()), ("score", pa.float64())])


def _rerank(keep: int):
    def run(queries: pa.Table, index: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if queries.num_rows and index.num_rows:
            place = {}
            keys = index.column("tree").to_numpy().astype(np.int64) << 40 | index.column("leaf").to_numpy()
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            points = _matrix(index.column("vector").combine_chunks())[order]
            names = index.column("vid").to_numpy()[order]
            vectors = _matrix(queries.column("vector").combine_chunks())
            wanted = queries.column("keys").combine_chunks()
            for i, qid in enumerate(queries.column("qid").to_numpy()):
                leaves = wanted[i].values.to_numpy()
                starts, ends = np.searchsorted(keys, leaves), np.searchsorted(keys, leaves + 1)
                rows = np.concatenate([np.arange(a, b) for a, b in zip(starts, ends)])
                score = np.sqrt(((points[rows] - vectors[i]) ** 2).sum(1))
                near, at = np.unique(names[rows], return_index=True)
                score = score[at]
                if len(score) > keep:
                    best = np.flatnonzero(score <= np.partition(score, keep - 1)[keep - 1])
                else:
                    best = np.arange(len(score))
                out[0].append(np.full(len(best), qid))
                out[1].append(near[best])
                out[2].append(score[best])
        columns = [np.concatenate(c) if c else np.empty(0) for c in out]
        return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)

    return run


def nearest(
    df: DataFrame,
    is_query,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    trees: int = TREES,
    sample: int = SAMPLE,
    leaf: int = LEAF,
    reach: int = REACH,
    reach_share: float = REACH_SHARE,
) -> DataFrame:
    """query_id, rank, id, score (Euclidean, on the original vectors) of the ``k`` nearest rows found per query row.

    Vectors that are null, zero, or hold a null or non-finite component take no part, nor do those of another length than
    most. Rows with a null id are candidates but no queries. A row is never its own neighbour; another row with the same id
    may be. Ties go to the smaller id. Tables of at most ``reach / trees`` vectors are searched
    whole.
    """
    spark = df.sparkSession
    rows = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), is_query.alias("asks"), F.col(vector_col).alias("vector")
    )
    sound = (
        "vector is not null and forall(vector, x -> x is not null and not isnan(x) and abs(x) < 'infinity')"
        " and exists(vector, x -> x <> 0)"
    )
    rows = rows.where(F.expr(sound))
    common = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, id bigint, score double")
    if common is None:
        return empty
    rows = cut_lineage(rows.where(F.size("vector") == common.n))
    # equal vectors: the k + 1 smallest ids are all a query can need
    few = Window.partitionBy("vector").orderBy(F.col("id").asc_nulls_last(), "row")
    kept = rows.withColumn("place", F.row_number().over(few)).where(F.col("place") <= k + 1)
    entries = kept.groupBy("vector").agg(F.collect_list(F.struct("id", "row")).alias("members"))
    entries = cut_lineage(entries.withColumn("vid", F.monotonically_increasing_id()))
    total = entries.count()
    chosen = entries.orderBy(F.xxhash64("vector", F.lit(SEED)), "vector").select("vector").limit(sample).toArrow()
    points = _matrix(chosen.column("vector").combine_chunks())
    forest = [Tree(points, leaf, SEED + t).pack() for t in range(trees)]
    shared = spark.sparkContext.broadcast(forest)  # at most sample / leaf planes a tree, whatever the table's size
    groups = max(1, trees * total // _GROUP_ROWS)
    kind = entries.schema["vector"].dataType.simpleString()
    reach = max(reach, int(reach_share * total))
    index = entries.mapInArrow(_index(shared, groups), f"part bigint, tree int, leaf bigint, vid bigint, vector {kind}")
    counted = index.groupBy("tree", "leaf").count().collect()  # one row a leaf
    sizes = [np.zeros(t[3], np.int64) for t in forest]
    for r in counted:
        sizes[r.tree][r.leaf] = r["count"]
    asked = rows.where("asks and id is not null").select("id", "row", "vector")
    asked = cut_lineage(asked.join(entries.select("vid", "vector"), "vector").select("id", "row", "vid"))
    distinct = asked.select("vid").distinct().join(entries.select("vid", "vector"), "vid")
    probe = _probe(shared, spark.sparkContext.broadcast(sizes), groups, reach)
    probes = distinct.mapInArrow(probe, f"part bigint, qid bigint, keys array<bigint>, vector {kind}")
    found = probes.groupBy("part").cogroup(index.groupBy("part")).applyInArrow(_rerank(k + 1), "qid bigint, vid bigint, score double")
    found = found.dropDuplicates(["qid", "vid"])
    members = found.join(entries.select("vid", "members"), "vid").select("qid", "score", F.inline("members"))
    order = Window.partitionBy("qid").orderBy("score", F.col("id").asc_nulls_last(), "row")
    best = members.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    lists = best.select("qid", "score", F.col("id").alias("found"), F.col("row").alias("found_row"))
    joined = asked.join(lists, asked.vid == lists.qid).where(F.col("row") != F.col("found_row"))
    final = Window.partitionBy("row").orderBy("score", F.col("found").asc_nulls_last(), "found_row")
    ranked = joined.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
    return ranked.select(F.col("id").alias("query_id"), "rank", F.col("found").alias("id"), "score")


@query("op9_projection_forest")
def op9_projection_forest(spark, sf):
    found = nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
