"""Exact dedup by deterministic block naming.

A text is cut into blocks of fixed size. All blocks are sorted, and a block's name is its rank among the
distinct ones. Adjacent names of a document are then paired and the pairs named in the same way, until one
name is left. Names are compared by content, so two documents share (block count, last name) exactly
when their texts are equal.

Rows go through one range shuffle on (hash, row), so the copies of a block that a third of the documents
hold are spread over many tasks. Each task numbers the distinct blocks of its sorted range; what it says about
its first and last block is all that reaches the driver, to carry the numbering over task borders.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Rows, identified, keep_rows, query, settled, slices, table, utf8
from riskloom.session import cut_lineage

BLOCK_BYTES = 4096

_BLOCKS = pa.schema(
    [
        ("row", pa.int64()),
        ("doc", pa.int64()),
        ("sha", pa.string()),
        ("n", pa.int64()),
        ("idx", pa.int64()),
        ("block", pa.binary()),
    ]
)
_NAMED = pa.schema(
    [
        ("part", pa.int32()),
        ("local", pa.int64()),
        ("row", pa.int64()),
        ("doc", pa.int64()),
        ("sha", pa.string()),
        ("n", pa.int64()),
        ("idx", pa.int64()),
        ("h1", pa.int64()),
        ("h2", pa.int64()),
        ("block", pa.binary()),
    ]
)
_NAMED_SQL = (
    "part int, local bigint, row bigint, doc bigint, sha string, n bigint, idx bigint, "
    "h1 bigint, h2 bigint, block binary"
)


def _cut(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(_BLOCKS)
        for batch in slices(batches, 512):
            rows, docs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, doc, text in zip(rows, docs, utf8(batch.column(2))):
                text = (text or b"").lower()  # of bytes: A to Z only
                n = max(1, -(-len(text) // size))
                sha = hashlib.sha256(text).hexdigest()
                for k in range(n):
                    block = text[k * size : (k + 1) * size]
                    if out.add((row, doc, sha if k == 0 else None, n, k, block), len(block)):
                        yield out.batch()
        yield out.batch()

    return run


def _number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the distinct keys of a sorted partition; the first and the last key follow as rows of their own."""
    part = TaskContext.get().partitionId()
    last, local, first = None, -1, None
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2 = (batch.column(c).to_numpy() for c in ("h1", "h2"))
        block = batch.column("block")
        same = np.zeros(batch.num_rows, bool)
        same[1:] = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
        same[0] = last is not None and (h1[0], h2[0]) == last[:2]
        for i in np.flatnonzero(same):
            before = last[2] if i == 0 else block[i - 1].as_py()
            if before != block[i].as_py():
                raise ValueError("two blocks share both hashes; run again with another block size")
        numbers = local + np.cumsum(~same)
        local = int(numbers[-1])
        if first is None:
            first = (int(h1[0]), int(h2[0]), block[0].as_py())
        last = (int(h1[-1]), int(h2[-1]), block[-1].as_py())
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, part, np.int32)),
                pa.array(numbers.astype(np.int64)),
                *(batch.column(c) for c in ("row", "doc", "sha", "n", "idx")),
                pa.nulls(n, pa.int64()),
                pa.nulls(n, pa.int64()),
                pa.nulls(n, pa.binary()),
            ],
            schema=_NAMED,
        )
    if first is not None:
        ends = Rows(_NAMED)
        ends.add((part, 0, None, None, None, None, None, *first))
        ends.add((part, local, None, None, None, None, None, *last))
        yield ends.batch()


def _name(keyed: DataFrame) -> DataFrame:
    """``name``: rank of (h1, h2, block) among the distinct keys, over the whole frame."""
    ordered = keyed.repartitionByRange("h1", "h2", "row", "idx").sortWithinPartitions("h1", "h2", "block", "row", "idx")
    done = cut_lineage(ordered.mapInArrow(_number, _NAMED_SQL))
    ends: dict[int, list] = {}
    for r in done.where("row is null").orderBy("part", "local").collect():  # two rows a task
        ends.setdefault(r.part, []).append(r)
    start, before, offsets = 0, None, []
    for part in sorted(ends):
        low, high = ends[part][0], ends[part][-1]
        key = (low.h1, low.h2, low.block)
        joins = before is not None and key == before
        if before is not None and key[:2] == before[:2] and not joins:
            raise ValueError("two blocks share both hashes; run again with another block size")
        offsets.append((part, start - joins))
        start, before = start - joins + high.local + 1, (high.h1, high.h2, high.block)
    shift = keyed.sparkSession.createDataFrame(offsets, "part int, shift bigint")
    return (
        done.where("row is not null")
        .join(F.broadcast(shift), "part")  # one row a task
        .select("row", "doc", "sha", "n", "idx", (F.col("local") + F.col("shift")).alias("name"))
    )


def text_identity(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(row, doc, sha, blocks, name) of every row; equal (blocks, name) means equal normalised texts.

    Null text counts as empty; an empty text is one empty block. Rows are told apart by their place in the stored
    table, so repeated or null ids do no harm.
    """
    source = identified(settled(df), doc=F.col(id_col).cast("bigint"), text=F.col(text_col).cast("binary"))
    blocks = source.mapInArrow(_cut(block_bytes), "row bigint, doc bigint, sha string, n bigint, idx bigint, block binary")
    named = _name(blocks.withColumns({"h1": F.xxhash64("block"), "h2": F.xxhash64("block", F.lit(1))}))
    named = named.withColumn("blocks", F.col("n"))
    heads = named.where("idx = 0").select("row", "doc", "sha", "blocks", "name")
    most = named.agg(F.max("n")).first()[0] or 1
    out = heads.where("blocks = 1")
    level = cut_lineage(named.where("n > 1").select("row", "n", "idx", "blocks", "name")) if most > 1 else None
    long_heads = heads.where("blocks > 1").drop("name")
    finals = None
    while most > 1:
        pairs = level.groupBy("row", F.expr("idx div 2").alias("idx")).agg(
            F.max(F.expr("(n + 1) div 2")).alias("n"),
            F.max("blocks").alias("doc"),
            F.max(F.expr("if(idx % 2 = 0, name, null)")).alias("h1"),
            F.coalesce(F.max(F.expr("if(idx % 2 = 1, name, null)")), F.lit(-1)).alias("h2"),
        )
        keyed = pairs.select(
            "row", "doc", F.lit(None).cast("string").alias("sha"), "n", "idx", "h1", "h2", F.lit(None).cast("binary").alias("block")
        )
        level = _name(keyed).select("row", "n", "idx", F.col("doc").alias("blocks"), "name")
        ready = level.where("n = 1").select("row", "name")
        finals = ready if finals is None else finals.unionByName(ready)
        level = level.where("n > 1")
        most = (most + 1) // 2
    if finals is not None:
        out = out.unionByName(long_heads.join(finals, "row"))
    return out


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: row, doc, sha, keep_id, group_size, kept.

    Of equal texts (A to Z lower-cased, null as empty) the row with the largest id stays; a null id counts as the
    smallest, and of repeated ids the first stored row stays. An empty table gives an empty result.
    """
    ident = cut_lineage(text_identity(df, id_col, text_col))
    pick = F.max(F.struct(F.col("doc"), (-F.col("row")).alias("first"))).alias("best")
    groups = ident.groupBy("blocks", "name").agg(pick, F.count(F.lit(1)).alias("group_size"))
    return ident.join(groups, ["blocks", "name"]).select(
        "row",
        "doc",
        "sha",
        F.col("best.doc").alias("keep_id"),
        "group_size",
        (F.col("best.first") == -F.col("row")).alias("kept"),
    )


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns."""
    df = settled(df)
    return keep_rows(df, exact_groups(df, id_col, text_col).where("kept"))


@query(
    "op10_exact_dedup",
    """
with d as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents)
select doc_id,
       max(doc_id) over (partition by t) as keep_id,
       count(*) over (partition by t) as group_size,
       doc_id = max(doc_id) over (partition by t) as kept,
       sha256(t) as text_sha256
from d
""",
)
def op10_exact_dedup(spark, sf):
    return exact_groups(table(spark, sf, "documents")).select(
        F.col("doc").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )
