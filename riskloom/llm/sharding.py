"""Proportional stratified interleaving.

Rows are shuffled inside their source by seed, their rank divided by the source's rows is a place between 0 and 1, and the
table sorted by place is cut into equal runs: every shard holds every source in the table's proportion and
row counts differ by at most one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import identified, query, settled, table
from riskloom.llm.order import ROWS_PER_BUCKET, before, digits_for, seeded, source_key
from riskloom.session import cut_lineage

SHARDS = 8
SEED = 23


def interleave(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    shards: int = SHARDS,
    seed: int = SEED,
) -> DataFrame:
    """Per row: row, id, size, text_crc32, shard (0 to shards - 1), slot (gapless in its shard).

    Size is the text's UTF-8 bytes plus 1; a null text has none and the check sum of an empty one. Null sources are one
    source. Rows that share an id are told apart by their place in the stored table, so reruns agree. An empty table gives an empty result.
    """
    text = F.col(text_col)
    rows = cut_lineage(
        identified(
            settled(df),
            id=F.col(id_col),
            src=source_key(F.col(source_col)),
            size=F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1,
            text_crc32=F.crc32(F.coalesce(text, F.lit("")).cast("binary")),
        ).withColumn("place", seeded("id", seed, "row"))
    )
    total = rows.count()
    bucketed = rows.withColumn("bucket", F.substring("place", 1, digits_for(total)))
    ranked = before(bucketed, "src", "bucket", ["place", "id", "row"], F.lit(1), "rank")
    counts = rows.groupBy(F.col("src").alias("__src")).agg(F.count(F.lit(1)).alias("in_source"))
    placed = ranked.join(counts, F.col("src") == F.col("__src")).withColumn(
        "fraction", (2 * F.col("rank") + 1) / (2 * F.col("in_source"))
    )
    runs = max(1, total // ROWS_PER_BUCKET)
    placed = placed.withColumns({"run": F.floor(F.col("fraction") * runs), "all": F.lit(0)})
    positions = before(placed, "all", "run", ["fraction", "src"], F.lit(1), "position")
    shard = F.expr(f"cast(position * {shards} div {max(total, 1)} as int)")
    first = F.expr(f"(shard * cast({total} as bigint) + {shards - 1}) div {shards}")
    return positions.withColumn("shard", shard).select(
        "row", "id", "size", "text_crc32", "shard", (F.col("position") - first).alias("slot")
    )


#: The check sum folds the text's bytes over the table of its rule.
_SQL = f"""
with crc as (
  select list(list_reduce([i::bigint, 0, 0, 0, 0, 0, 0, 0, 0],
              lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
  from range(256) r(i)),
d as (
  select doc_id, case when source is null then '1' else '0' || source end as src, octet_length(encode(coalesce(text, '')))::bigint + 1 as size,
         xor(list_reduce(list_concat([4294967295::bigint],
               list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::bigint)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as text_crc32
  from documents, crc),
ranked as (
  select *, (2 * (row_number() over (partition by src order by md5(doc_id::varchar || ':{SEED}'), doc_id) - 1) + 1)
            / (2 * count(*) over (partition by src)) as fraction, count(*) over () as total from d),
placed as (select *, row_number() over (order by fraction, src) - 1 as position from ranked),
dealt as (select *, position * {SHARDS} // total as shard from placed)
select doc_id, size, text_crc32::bigint as text_crc32, 'rows' as law, shard::int as shard,
       (position - (shard * total + {SHARDS - 1}) // {SHARDS})::bigint as slot, null::int as grown_shard
from dealt
"""


@query("op8_stratified_interleaving", _SQL)
def op8_stratified_interleaving(spark, sf):
    return interleave(table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
