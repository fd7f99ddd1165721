"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is made of equal blocks of words. Sources get whole blocks by highest quotient (target / (2k + 1)), and the blocks are dealt out
to shards, so every shard has an integer quota of blocks per source. A source's documents are laid end to end in seeded
order, three times over, and this stream is cut into blocks. A seeded permutation ranks the blocks that start in one pass; the first
ones in (pass, rank) are selected, and the rank also names the shard. What a source's target leaves below a block is
settled exactly by the next block in rank, so a source shorter than a block keeps its share beside huge ones.

``mix`` takes the words of the selected blocks, ``mixed_documents`` the whole documents that begin in them, shard by shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import free_name, identified, query, settled, table, with_row
from riskloom.llm.order import ROWS_PER_BUCKET, before, digits_for, seeded, source_key
from riskloom.session import cut_lineage

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
BLOCK_WORDS = 256
SHARDS = 8
SEED = 17
#: Takes of whole documents in a partition of a shard.
ROWS_PER_PARTITION = 8192
#: Factors of the block permutation; one of them at least does not divide a number of blocks below 2^41.
FACTORS = (786433, 1572869, 3145739)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source of ``sizes(src, size)``: src, source_size, rows, weight, target.

    Weights 1, 2, 3 repeat over the sources in order. Targets share all words by weight and stop at ``max_epochs``
    times their source; what is above goes to the others by weight until none is above: in the order
    of cap per weight, the sources that stop are the first ones.
    """
    totals = sizes.groupBy("src").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    # windows over one row a source
    named = totals.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(Window.orderBy("src")) - 1) % len(WEIGHTS) + 1).cast("int"))
    )
    everything = Window.partitionBy()
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), "src").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - max_epochs * F.coalesce(F.sum("source_size").over(by_cap), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_cap), F.lit(0))
    )
    leveled = named.withColumns({"level": level, "place": F.row_number().over(Window.orderBy(F.col("source_size") / F.col("weight"), "src"))})
    stays = F.when(F.col("level") * F.col("weight") <= max_epochs * F.col("source_size"), F.struct("place", "level"))
    # the first source that stays below its cap sets the level of all that follow it
    leveled = leveled.withColumn("open", F.min(stays).over(everything))
    stops = F.col("open").isNull() | (F.col("place") < F.col("open.place"))
    return leveled.select(
        "src",
        "source_size",
        "rows",
        "weight",
        F.when(stops, (max_epochs * F.col("source_size")).cast("double"))
        .otherwise(F.col("open.level") * F.col("weight"))
        .alias("target"),
    )


def apportion(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``quota`` (blocks) per source, by highest quotient target / (2k + 1), and ``wanted``, its words.

    Every quota lies within half a seat of its share of a total that is off by at most half a seat a source; only
    the quotients in that range are listed, about six rows a source.
    """
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything)
    shares = targets.withColumns({"all_words": total, "sources": F.count(F.lit(1)).over(everything)})
    shares = shares.withColumn("seats", F.round(F.col("all_words") / block_words).cast("bigint"))
    share = F.when(F.col("all_words") > 0, F.col("target") / F.col("all_words")).otherwise(F.lit(0.0))
    low = F.greatest(F.lit(0).cast("bigint"), F.floor(share * (F.col("seats") - F.col("sources") / 2) - 1.5))
    high = F.ceil(share * (F.col("seats") + F.col("sources") / 2) + 1.5)
    ranged = shares.withColumns({"low": low, "high": high})
    ranged = ranged.withColumn("open", F.col("seats") - F.sum("low").over(everything))
    quotients = ranged.where("target > 0").select("src", "open", F.explode(F.sequence("low", "high")).alias("k"), "target")
    best = Window.orderBy((F.col("target") / (2 * F.col("k") + 1)).desc(), "src", "k")
    won = quotients.withColumn("place", F.row_number().over(best)).where("place <= open")
    won = won.groupBy(F.col("src").alias("__src")).agg(F.count(F.lit(1)).alias("won"))
    wanted = F.least(F.floor(F.col("target") + 0.5), MAX_EPOCHS * F.col("source_size"))
    return (
        ranged.join(won, F.col("src") == F.col("__src"), "left")
        .withColumn("quota", F.col("low") + F.coalesce("won", F.lit(0)))
        .select("src", "source_size", "rows", "weight", "target", "quota", wanted.alias("wanted"))
    )


def shard_quotas(quotas: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Blocks per source and shard: (src, shard, first, blocks).

    The blocks of all sources, one source after the other, go round the shards; so shards differ by at most one block
    in all and by at most one block of a source. ``first`` counts a source's blocks in earlier shards.
    """
    ahead = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, -1)
    dealt = quotas.withColumn("__ahead", F.coalesce(F.sum("quota").over(ahead), F.lit(0))).select(
        "src", "quota", "__ahead", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    )
    count = F.expr(f"(quota + {shards - 1} - pmod(shard - __ahead, {shards})) div {shards}")
    dealt = dealt.withColumn("blocks", count)
    earlier = Window.partitionBy("src").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return dealt.select(
        "src", "shard", F.coalesce(F.sum("blocks").over(earlier), F.lit(0)).alias("first"), "blocks"
    )


def block_plan(quotas: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """What places a source's blocks: ``ahead`` (blocks of earlier sources) and the passes, (first, blocks, factor, shift) each.

    A pass holds the blocks that start in it; ``blocks`` whole ones in all, and the rest of the stream is a last, shorter one.
    """
    ahead = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, -1)
    whole = f"({MAX_EPOCHS} * source_size div {block_words})"
    passes = []
    for e in range(MAX_EPOCHS):
        first = f"least(({e} * source_size + {block_words - 1}) div {block_words}, {whole})"
        end = f"least(({e + 1} * source_size + {block_words - 1}) div {block_words}, {whole})"
        count = f"greatest({end} - {first}, 1)"
        factor = f"case when {count} % {FACTORS[0]} <> 0 then {FACTORS[0]} when {count} % {FACTORS[1]} <> 0 then {FACTORS[1]} else {FACTORS[2]} end"
        shift = f"cast(conv(substring(md5(concat(src, ':{e}:{seed}')), 1, 8), 16, 10) as bigint) % {count}"
        passes.append(f"named_struct('first', {first}, 'count', {count}, 'factor', cast({factor} as bigint), 'shift', {shift})")
    return quotas.withColumns(
        {
            "ahead": F.coalesce(F.sum("quota").over(ahead), F.lit(0)),
            "blocks": F.expr(whole),
            "passes": F.expr(f"array({', '.join(passes)})"),
        }
    )


def _place(j: Column, block_words: int) -> Column:
    """Place of block ``j`` of the stream in its source's selection."""
    begins = F.least(F.floor(j * block_words / F.col("source_size")), F.lit(MAX_EPOCHS - 1)).cast("int")
    own = F.element_at("passes", begins + 1)
    place = own["first"] + (own["factor"] * (j - own["first"]) + own["shift"]) % own["count"]
    return F.when(j < F.col("blocks"), place).otherwise(F.col("blocks"))


def _pieces(block_words: int, shards: int) -> Column:
    """Array of (block, place, shard, first, words): what the mix takes of a document, block by block.

    ``place`` is the block's place in its source's selection, ``first`` the piece's first word in the document.
    """
    epochs = F.sequence(F.lit(0), F.lit(MAX_EPOCHS - 1))

    def of_pass(e: Column) -> Column:
        low = e * F.col("source_size") + F.col("start")
        blocks = F.sequence(F.floor(low / block_words), F.floor((low + F.col("size") - 1) / block_words))

        def piece(j: Column) -> Column:
            place = _place(j, block_words)
            left = F.greatest(F.lit(0), F.least(F.lit(block_words), F.col("wanted") - place * block_words))
            first = F.greatest(low, j * block_words)
            words = F.least(low + F.col("size"), j * block_words + left) - first
            return F.struct(
                j.alias("block"),
                place.alias("place"),
                F.pmod(F.col("ahead") + place, F.lit(shards)).cast("int").alias("shard"),
                (first - low).alias("first"),
                words.alias("words"),
            )

        return F.filter(F.transform(blocks, piece), lambda x: x["words"] > 0)

    taken = F.flatten(F.transform(epochs, of_pass))
    return F.when(F.col("size") > 0, taken)


def _laid(df: DataFrame, id_col: str, text_col: str, source_col: str, block_words: int, seed: int) -> DataFrame:
    """Every row with its place in its source's stream and its source's plan."""
    sized = cut_lineage(
        identified(settled(df), id=F.col(id_col), src=source_key(F.col(source_col)), size=n_words(F.col(text_col)))
    )
    plan = block_plan(apportion(source_targets(sized), block_words), block_words, seed)
    digits = digits_for(sized.count())
    order = sized.withColumn("place", seeded("id", seed, "row")).withColumn("bucket", F.substring("place", 1, digits))
    laid = before(order, "src", "bucket", ["place", "id", "size"], F.col("size"), "start")
    return laid.drop("place").join(plan, "src")


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: int = SEED,
) -> DataFrame:
    """Per row: row, id, size, source_size, target, taken (words the mix takes, repeats counted), pieces.

    ``pieces`` lists what is taken block by block: (block, place, shard, first, words). A null text has size 0 and is never
    taken; null sources are one source, the last. Rows that share an id are ordered by size, so reruns agree. An empty
    table gives an empty result.
    """
    laid = _laid(df, id_col, text_col, source_col, block_words, seed).withColumn("pieces", _pieces(block_words, shards))
    taken = F.aggregate("pieces", F.lit(0).cast("bigint"), lambda s, x: s + x["words"])
    return laid.select("row", "id", "size", "source_size", "target", F.coalesce(taken, F.lit(0)).cast("bigint").alias("taken"), "pieces")


def shard_words(pieces: Column, shards: int = SHARDS) -> Column:
    """Words per shard, joined by commas."""

    def of_shard(k: Column) -> Column:
        own = F.filter(pieces, lambda x: x["shard"] == k)
        return F.coalesce(F.aggregate(own, F.lit(0).cast("bigint"), lambda s, x: s + x["words"]), F.lit(0)).cast("string")

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), of_shard), ",")


_SQL = f"""
with d as (
  select doc_id, case when source is null then '1' else '0' || source end as src,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size
  from documents),
s0 as (select src, sum(size)::bigint as source_size from d group by src),
s1 as (select *, 1 + (row_number() over (order by src) - 1) % 3 as weight from s0),
s2 as (select *, row_number() over (order by source_size / weight, src) as place,
              (sum(source_size) over () - 3 * coalesce(sum(source_size) over w, 0))
            / (sum(weight) over () - coalesce(sum(weight) over w, 0))::double as level
       from s1 window w as (order by source_size / weight, src rows between unbounded preceding and 1 preceding)),
s3 as (select *, case when level * weight <= 3 * source_size then place end as stays from s2),
s4 as (select *, min(stays) over () as first, min_by(level, stays) over () as open from s3),
s5 as (select src, source_size, case when first is null or place < first then 3.0::double * source_size else open * weight end as target,
              sum(source_size) over () as words, count(*) over () as sources from s4),
s6 as (select *, round(words / {BLOCK_WORDS})::bigint as seats, least(floor(target + 0.5)::bigint, 3 * source_size) as wanted from s5),
s7 as (select *, greatest(0, floor(target / words * (seats - sources / 2) - 1.5))::bigint as low,
              ceil(target / words * (seats + sources / 2) + 1.5)::bigint as high from s6),
s8 as (select *, seats - sum(low) over () as places from s7),
q as (select src, places, target / (2 * k + 1) as quotient, k
      from s8, lateral (select unnest(range(low, high + 1)) as k) where target > 0),
won as (select src, count(*) as won
        from (select *, row_number() over (order by quotient desc, src, k) as place from q) where place <= places
        group by src),
plan as (select src, source_size, target, wanted, 3 * source_size // {BLOCK_WORDS} as blocks,
                coalesce(sum(low + coalesce(won, 0)) over (order by src rows between unbounded preceding and 1 preceding), 0)::bigint as ahead
         from s8 left join won using (src)),
passes as (select *, greatest(last - first, 1) as n
           from (select src, e, least((e * source_size + {BLOCK_WORDS - 1}) // {BLOCK_WORDS}, blocks) as first,
                        least(((e + 1) * source_size + {BLOCK_WORDS - 1}) // {BLOCK_WORDS}, blocks) as last
                 from plan, range(3) r(e))),
perm as (select src, e, first, n,
                ('0x' || substr(md5(src || ':' || e || ':{SEED}'), 1, 8))::bigint % n as shift,
                case when n % {FACTORS[0]} <> 0 then {FACTORS[0]}
                     when n % {FACTORS[1]} <> 0 then {FACTORS[1]} else {FACTORS[2]} end as factor
         from passes),
laid as (select *, coalesce(sum(size) over (partition by src order by md5(doc_id::varchar || ':{SEED}'), doc_id, size
                  rows between unbounded preceding and 1 preceding), 0)::bigint as start from d),
met as (select doc_id, src, size, source_size, wanted, blocks, ahead, p * source_size + start as low,
               unnest(range((p * source_size + start) // {BLOCK_WORDS}, (p * source_size + start + size - 1) // {BLOCK_WORDS} + 1)) as j
        from laid join plan using (src), range(3) r(p) where size > 0),
placed as (select met.*, case when j < blocks then perm.first + (factor * (j - perm.first) + shift) % n else blocks end as place
           from met join perm on perm.src = met.src and perm.e = least(j * {BLOCK_WORDS} // source_size, 2)),
pieces as (select doc_id, (ahead + place) % {SHARDS} as shard,
                  least(low + size, j * {BLOCK_WORDS} + greatest(0, least({BLOCK_WORDS}, wanted - place * {BLOCK_WORDS})))
                  - greatest(low, j * {BLOCK_WORDS}) as words
           from placed),
shards as (select doc_id, shard, sum(words) as words from pieces where words > 0 group by doc_id, shard),
docs as (select doc_id, sum(words) as taken, list(words) as w, list(shard) as k from shards group by doc_id)
select doc_id, size, source_size, target, coalesce(taken, 0)::bigint as taken,
       array_to_string(list_transform(range({SHARDS}), lambda x: coalesce(w[list_position(k, x)], 0)::bigint), ',') as shard_words
from laid join plan using (src) left join docs using (doc_id)
"""


@query("op4_source_mixing", _SQL)
def op4_source_mixing(spark, sf):
    mixed = mix(table(spark, sf, "documents"))
    return mixed.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", shard_words(F.col("pieces")).alias("shard_words")
    )


def document_takes(laid: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(row, shard) a take: which documents the blocks' selection takes whole, and the shard that gets each.

    In each pass a document belongs to the block it begins in. Blocks follow their place in the selection, a block's documents
    the stream, up to the words wanted of the source; the document at the end is taken if more than half of it is wanted. The
    block's place also deals its documents to a shard, as ``mix`` does.
    """
    begun = F.explode(F.transform(F.sequence(F.lit(0), F.lit(MAX_EPOCHS - 1)), lambda e: e * F.col("source_size") + F.col("start")))
    copies = laid.where("size > 0").withColumn("low", begun).withColumn("block", F.floor(F.col("low") / BLOCK_WORDS))
    copies = copies.withColumn("place", _place(F.col("block"), BLOCK_WORDS))
    # the seeded places spread a source's documents, so so many blocks hold about ROWS_PER_BUCKET of them
    run = F.greatest(F.lit(1), F.floor(ROWS_PER_BUCKET * F.col("blocks") / (MAX_EPOCHS * F.col("rows"))))
    copies = copies.withColumn("bucket", F.floor(F.col("place") / run)).select("row", "src", "size", "low", "place", "bucket", "ahead", "wanted")
    copies = copies.repartition("src", "bucket")  # else the join by source keeps a whole source in one task
    ordered = before(copies, "src", "bucket", ["place", "low"], F.col("size"), "ahead_words")
    shard = F.pmod(F.col("ahead") + F.col("place"), F.lit(shards)).cast("int")
    return ordered.where("2 * (wanted - ahead_words) >= size").select("row", shard.alias("shard"))


def mixed_documents(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED
) -> DataFrame:
    """The mix by whole documents: a row for each take, with all columns as they are.

    Targets, quotas, blocks, their seeded selection and their shards are those of ``mix``; a block stands for the documents that begin in it
    (``document_takes``), so no text is cut, and a source's words come within half a document of its target. Every
    shard has partitions of its own, ``ROWS_PER_PARTITION`` takes each. Documents without words are not taken.
    """
    df = settled(df)
    laid = _laid(df, id_col, text_col, source_col, BLOCK_WORDS, seed)
    takes = cut_lineage(document_takes(laid))  # two numbers a take
    row, shard = free_name(df), free_name(df, "shard")
    plan = takes.select(F.col("row").alias(row), F.col("shard").alias(shard))
    parts = max(1, -(-takes.count() // (SHARDS * ROWS_PER_PARTITION)))
    part = F.col(shard) * parts + F.pmod(F.xxhash64(row), F.lit(parts)).cast("int")
    dealt = with_row(df, row).join(plan, row).repartitionById(SHARDS * parts, part)
    return dealt.select(*(F.col(f"`{c}`") for c in df.columns))
