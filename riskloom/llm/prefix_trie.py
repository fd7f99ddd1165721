"""Prefix trie of conversations by van Emde Boas recursion.

A sequence is cut at half depth, and each half again, down to single turns. From the bottom up every half gets a digest
made of the digests of its own halves. From the top down the cut prefixes are named: a prefix's name is the
smallest sequence that starts with it, and two prefixes are one when the name up to the last cut and the digest behind
it agree. A depth is named once, at the largest power of two that divides it, so the upper trie and all lower forests of
a level are named in one parallel step, and a sequence of ``d`` turns needs about log2 ``d`` steps.

Totals go the other way: the sum of each lower trie is grafted onto the cut node it hangs from and so added to the nodes of the
upper trie that lie above it. A level adds at most one row for each turn of a named sequence.

A sequence is never gathered into one row or task: rows are single turns, so one conversation may be a third of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import Rows, query, table
from riskloom.session import cut_lineage

#: Ids of a node's ends travel to their hash in pieces of about this many characters.
PIECE = 1 << 15
_STRETCH = 4096

_PIECES = pa.schema([("name", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
_HASHES = pa.schema([("name", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])


def positions(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``pos``: place of a row inside its group, from 0. Rows are dealt by ranges, so a large group is many tasks' work."""
    keyed = df.select("*", *(o.alias(f"__o{k}") for k, o in enumerate(order)), F.monotonically_increasing_id().alias("__last"))
    keys = [*(f"__o{k}" for k in range(len(order))), "__last"]
    ranged = cut_lineage(keyed.repartitionByRange(group, *keys).withColumn("__part", F.spark_partition_id()))
    sizes = ranged.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("__n"))
    # a row for each range that holds a part of the group
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(group, "__part").orderBy(*keys)
    return (
        ranged.withColumn("__at", F.row_number().over(inside) - 1)
        .join(starts, [group, "__part"])
        .withColumn("pos", (F.col("__start") + F.col("__at")).cast("bigint"))
        .drop("__part", "__at", "__start", *keys)
    )


def sequences(df: DataFrame, shared: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(turns, sizes) of the rebuilt conversations: turns(conv, pos, item, chars), sizes(conv, n).

    Conversation c takes the first h turns of c - c % ``shared``, h = crc32(c) % ``most``, and its own after its first h. Turns
    go by ``turn``, nulls first; equal ones by role and then by the digest of role and text. A null role or text is
    empty; rows without a conversation belong to none.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    item = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = df.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        item.alias("item"),
        F.length(text).cast("bigint").alias("chars"),
    )
    placed = positions(rows, "conv", [F.col("turn").isNotNull(), F.col("turn"), F.col("role"), F.col("item")])
    own = cut_lineage(placed.select("conv", "pos", "item", "chars"))
    convs = own.groupBy("conv").agg(F.count(F.lit(1)).alias("own")).select(
        "conv", "own", (F.col("conv") - F.col("conv") % shared).alias("base"), (F.crc32(F.col("conv").cast("string").cast("binary")) % most).alias("h")
    )
    convs = cut_lineage(convs)
    heads = own.where((F.col("pos") < most) & (F.col("conv") % shared == 0)).withColumnRenamed("conv", "base")
    taken = convs.join(heads, "base").where("pos < h").select("conv", "pos", "item", "chars")
    known = convs.select(F.col("conv").alias("base"), F.col("own").alias("base_own"))
    moved = cut_lineage(
        convs.join(known, "base", "left").select("conv", "own", "h", F.least("h", F.coalesce("base_own", F.lit(0))).alias("given"))
    )
    rest = own.join(moved, "conv").where("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "item", "chars")
    sizes = moved.select("conv", (F.col("given") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n"))
    return cut_lineage(taken.unionByName(rest)), sizes


def halves(turns: DataFrame, most: int) -> list[DataFrame]:
    """Per level k the complete stretches of 2^k turns, (conv, idx, item): a digest of the two halves' digests."""
    levels = [turns.select("conv", F.col("pos").alias("idx"), "item")]
    while 2 ** len(levels) <= most:
        pairs = levels[-1].groupBy("conv", F.expr("idx div 2").alias("idx")).agg(
            F.max(F.expr("if(idx % 2 = 0, item, null)")).alias("a"), F.max(F.expr("if(idx % 2 = 1, item, null)")).alias("b")
        )
        whole = pairs.where("a is not null and b is not null")
        levels.append(cut_lineage(whole.select("conv", "idx", F.unhex(F.sha2(F.concat("a", "b"), 256)).alias("item"))))
    return levels


def prefix_names(turns: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """(conv, depth, name) for every prefix of every sequence, the textless one included."""
    least = sizes.agg(F.min("conv")).first()[0]
    names = sizes.select("conv", F.lit(0).cast("bigint").alias("depth"), F.lit(least).cast("bigint").alias("name"))
    levels = halves(turns, most)
    for k in range(len(levels) - 1, -1, -1):
        width = 1 << k
        upper = levels[k].where("idx % 2 = 0").select("conv", (F.col("idx") * width).alias("depth"), "item")
        keyed = names.where(F.col("depth") % (2 * width) == 0).join(upper, ["conv", "depth"])
        cut = keyed.groupBy("name", "depth", "item").agg(F.min("conv").alias("first"))
        named = keyed.join(cut, ["name", "depth", "item"])
        names = names.unionByName(
            cut_lineage(named.select("conv", (F.col("depth") + width).alias("depth"), F.col("first").alias("name")))
        )
    return names


def _stretch(low: Column, high: Column) -> Column:
    return F.sequence(low, high, F.lit(_STRETCH).cast("bigint"))


def subtree_sums(names: DataFrame, values: DataFrame, columns: list[str], most: int) -> DataFrame:
    """(name, depth, *columns): sums over all nodes strictly below a node, from ``values(name, depth, parent, *columns)``.

    A level's lower tries, of height 2^k, hang from depths that 2^k divides and 2^(k+1) does not.
    """
    add = [F.sum(c).alias(c) for c in columns]
    hung = values.where("depth > 0").groupBy(F.col("parent").alias("name"), (F.col("depth") - 1).alias("depth")).agg(*add)
    sums, width = [], 1
    while width <= most:
        lower = hung.where(F.col("depth") % (2 * width) == width)
        above = (
            lower.withColumn("from", F.explode(_stretch(F.col("depth") - width, F.col("depth"))))
            .withColumn("up", F.explode(F.sequence("from", F.least(F.col("from") + _STRETCH - 1, F.col("depth")))))
            .select(F.col("name").alias("conv"), F.col("up").alias("depth"), *columns)
        )
        grafts = cut_lineage(above.join(names, ["conv", "depth"]).groupBy("name", "depth").agg(*add))
        upper = F.col("depth") % (2 * width) == 0
        sums.append(grafts.where(~upper))
        hung = cut_lineage(hung.where(upper).unionByName(grafts.where(upper)).groupBy("name", "depth").agg(*add))
        width *= 2
    out = hung
    for part in sums:
        out = out.unionByName(part)
    return out.groupBy("name", "depth").agg(*add)


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join the ids of one node in pieces; rows come sorted by (name, depth, conv)."""
    out, key, first, ids, size = Rows(_PIECES), None, None, [], 0
    for batch in batches:
        for name, depth, conv in zip(*(batch.column(c).to_pylist() for c in ("name", "depth", "conv"))):
            if ids and ((name, depth) != key or size >= PIECE):
                if out.add((*key, first, ",".join(ids)), size):
                    yield out.batch()
                ids, size = [], 0
            if not ids:
                key, first = (name, depth), conv
            ids.append(str(conv))
            size += len(ids[-1]) + 1
    if ids:
        out.add((*key, first, ",".join(ids)))
    yield out.batch()


def _hash(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash a node's pieces in order, without joining them; rows come sorted by (name, depth, first)."""
    out, key, sha = Rows(_HASHES), None, None
    for batch in batches:
        for name, depth, ids in zip(batch.column("name").to_pylist(), batch.column("depth").to_pylist(), batch.column("ids")):
            if (name, depth) == key:
                sha.update(b",")
            else:
                if key is not None and out.add((*key, sha.hexdigest())):
                    yield out.batch()
                key, sha = (name, depth), hashlib.sha256()
            sha.update(ids.as_py().encode())
    if key is not None:
        out.add((*key, sha.hexdigest()))
    yield out.batch()


def end_hashes(ends: DataFrame) -> DataFrame:
    """(name, depth, ends_sha256) of ``ends(name, depth, conv)``: of the ascending ids, joined by commas."""
    ordered = ends.repartitionByRange("name", "depth", "conv").sortWithinPartitions("name", "depth", "conv")
    pieces = ordered.mapInArrow(_pieces, "name bigint, depth bigint, first bigint, ids string")
    dealt = pieces.repartition("name", "depth").sortWithinPartitions("name", "depth", "first")
    return dealt.mapInArrow(_hash, "name bigint, depth bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """A row for each distinct prefix of the sequences.

    ``turns(conv, pos, item, chars)``: gapless from 0; ``sizes(conv, n)``: every sequence, also those without turns. Returns conv_id
    (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Without a sequence there is
    no node, not even the root.
    """
    most = sizes.agg(F.max("n")).first()[0]
    if most is None:
        most = 0
    names = prefix_names(turns, sizes, most)
    counted = names.groupBy("name", "depth").agg(F.count(F.lit(1)).alias("n_convs"))
    before = names.select(F.col("conv").alias("name"), (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    last = turns.select(F.col("conv").alias("name"), (F.col("pos") + 1).alias("depth"), "chars")
    nodes = cut_lineage(
        counted.join(before, ["name", "depth"], "left")
        .join(last, ["name", "depth"], "left")
        .select("name", "depth", F.when(F.col("depth") > 0, F.col("parent")).alias("parent"), "n_convs", ((F.col("n_convs") - 1) * F.coalesce("chars", F.lit(0))).alias("saved"))
    )
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("name"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = cut_lineage(
        nodes.join(children, ["name", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    )
    nodes = nodes.withColumn("leaves", F.expr("cast(n_children = 0 as bigint)"))
    below = subtree_sums(names, nodes, ["leaves", "saved"], most).select(
        "name", "depth", F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved")
    )
    ends = names.join(sizes.select("conv", F.col("n").alias("depth")), ["conv", "depth"])
    hashes = end_hashes(ends)
    return (
        nodes.join(below, ["name", "depth"], "left")
        .join(hashes, ["name", "depth"], "left")
        .select(
            F.col("name").alias("conv_id"),
            "depth",
            F.col("parent").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )


_SQL = """
with crc as (
  select list(list_reduce([i::bigint, 0, 0, 0, 0, 0, 0, 0, 0],
              lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
  from range(256) r(i)),
own as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''),
           sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) - 1 as pos
  from conversations where conv_id is not null),
convs as (
  select c, c - c % 100 as base, count(*) as n,
         xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(c::varchar, ''), lambda x: unicode(x)::bigint)),
             lambda a, b: xor(a >> 8, any_value(t)[(xor(a, b) & 255) + 1])), 4294967295) % 6 as h
  from own, crc group by c),
moved as (
  select a.c, a.base, a.h, least(a.h, coalesce(b.n, 0)) as given, greatest(a.n - a.h, 0) as kept
  from convs a left join convs b on b.c = a.base),
turns as (
  select m.c, o.pos, o.role, o.text from moved m join own o on o.c = m.base and o.pos < m.h
  union all
  select m.c, o.pos - m.h + m.given, o.role, o.text from moved m join own o on o.c = m.c and o.pos >= m.h),
paths as (
  select c, pos + 1 as depth, length(text) as chars,
         list(sha256(concat(length(role), ':', role, text))) over (partition by c order by pos) as path
  from turns
  union all
  select c, 0, 0, [] from moved),
keyed as (select c, depth, chars, sha256(array_to_string(path, ',')) as k from paths),
named as (select c, depth, min(c) over (partition by depth, k) as name, chars from keyed),
nodes as (
  select name, depth, count(*) as n_convs, (count(*) - 1) * any_value(chars) as saved from named group by name, depth),
linked as (
  select n.*, p.name as parent from nodes n left join named p on p.c = n.name and p.depth = n.depth - 1),
children as (select parent as name, depth - 1 as depth, count(*) as n_children from linked where depth > 0 group by all),
sums as (
  select a.name, a.depth, sum(n.saved) as saved, count(*) filter (where k.n_children is null) as leaves
  from nodes n left join children k on k.name = n.name and k.depth = n.depth
  join named a on a.c = n.name and a.depth <= n.depth
  group by a.name, a.depth),
ends as (
  select d.name, d.depth, string_agg(d.c::varchar, ',' order by d.c) as ids
  from named d join moved m on m.c = d.c and m.given + m.kept = d.depth group by all)
select l.name as conv_id, l.depth::bigint as depth, l.parent as parent_conv_id, n_convs,
       coalesce(n_children, 0)::bigint as n_children, s.leaves::bigint as n_leaves, s.saved::bigint as saved_tokens,
       sha256(coalesce(e.ids, '')) as ends_sha256
from linked l join sums s using (name, depth)
left join children k on k.name = l.name and k.depth = l.depth
left join ends e on e.name = l.name and e.depth = l.depth
"""


@query("op12_prefix_trie", _SQL)
def op12_prefix_trie(spark, sf):
    return prefix_trie(*sequences(table(spark, sf, "conversations")))
