"""SimHash near-dedup over a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of two bits; the vector of their bit counts embeds it in a small grid.
The Manhattan distance of two vectors is never above the Hamming distance of the fingerprints. So two fingerprints
within three bits agree, in one of the two halves of the vector, up to one step of the grid: a range join in which
every fingerprint meets the home cells at distance zero or one. Pairs that meet are verified on the fingerprints.

Equal fingerprints are one row from the start. In a cell of many fingerprints, each is first held against
the cell's most frequent one; only pairs that those links leave apart are joined, so a dense group of
near copies costs links in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import connected_components, identified, keep_rows, query, settled, slices, table, utf8
from riskloom.session import cut_lineage

BITS = 64
MAX_BITS = 3
SHINGLE = 3
SEED = 42
_CHUNK = 50_000  # shingles whose bits are counted at once
_EVEN = 0x5555555555555555


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Of a whole text: bit set where over half the shingle hashes set it; no word gives zero.

    ``text`` is UTF-8; A to Z are lower-cased; a text of fewer words than a shingle is one shingle.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    stops = (ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]).tolist()
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _CHUNK):
        part = zip(starts[at : at + _CHUNK], stops[at : at + _CHUNK])
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in part), np.uint64)
        counts += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def _fingerprints(shingle: int, seed: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            prints = np.fromiter(
                (fingerprint(t or b"", shingle, seed) for t in utf8(batch.column("text"))), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc"), pa.array(prints.view(np.int64))], names=["row", "doc", "fp"]
            )

    return run


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(row, doc, fp) of every row; null text counts as empty."""
    source = identified(settled(df), doc=F.col(id_col).cast("bigint"), text=F.col(text_col).cast("binary"))
    return source.mapInArrow(_fingerprints(shingle, seed), "row bigint, doc bigint, fp bigint")


def _cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every fingerprint its home cell in each half, and the cells one step from it where it looks around.

    A cell holds 16 counts of two bits. Neighbours differ in the parity of their sum; only odd cells look around,
    so two fingerprints in neighbouring cells meet once.
    """
    for batch in slices(batches, 20_000):
        fp = batch.column("fp").to_numpy().view(np.uint64)
        even, down = np.uint64(_EVEN), fp >> np.uint64(1)
        counts = ((fp ^ down) & even) | ((fp & down & even) << np.uint64(1))
        for half in (0, 1):
            cell = (counts >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
            mark = np.uint64(half << 40)
            odd = (np.bitwise_count(cell & np.uint64(0x55555555)) & 1).astype(bool)  # a count is 0, 1 or 2
            found, rows, look = [cell | mark], [np.arange(len(fp))], [np.zeros(len(fp), bool)]
            for k in range(0, 32, 2):
                digit, step = (cell >> np.uint64(k)) & np.uint64(3), np.uint64(1 << k)
                for may, there in ((digit < 2, cell + step), (digit > 0, cell - step)):
                    at = np.flatnonzero(odd & may)
                    found.append(there[at] | mark)
                    rows.append(at)
                    look.append(np.ones(len(at), bool))
            at = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(found).view(np.int64)),
                    pa.array(np.concatenate(look)),
                    batch.column("fp").take(at),
                    batch.column("root").take(at),
                ],
                names=["cell", "look", "fp", "root"],
            )


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def link_components(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root) of the distinct fingerprints of ``prints(fp, n)``: components of all links of at most 3 bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("one half agrees up to one step only for at most three bits")
    cells = "cell bigint, look boolean, fp bigint, root bigint"
    alone = prints.select("fp", "n", F.col("fp").alias("root"))
    homes = alone.select("fp", "root").mapInArrow(_cells, cells).where("not look")
    homes = homes.join(prints, "fp")
    pivots = homes.groupBy("cell").agg(F.max_by("fp", F.struct("n", "fp")).alias("pivot"), F.count(F.lit(1)).alias("k"))
    first = homes.join(pivots.where("k > 1"), "cell").where((F.col("fp") != F.col("pivot")) & (_apart("fp", "pivot") <= max_bits))
    stars = connected_components(first.select(F.col("fp").alias("a"), F.col("pivot").alias("b")))
    rooted = cut_lineage(
        prints.join(stars, prints.fp == stars.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))
    )
    around = rooted.mapInArrow(_cells, cells)
    homes = rooted.mapInArrow(_cells, cells).where("not look")
    a = around.select("cell", "look", F.col("fp").alias("fa"), F.col("root").alias("ra"))
    b = homes.select("cell", F.col("fp").alias("fb"), F.col("root").alias("rb"))
    met = a.join(b, "cell").where(
        (F.col("ra") != F.col("rb")) & (F.col("look") | (F.col("fa") < F.col("fb"))) & (_apart("fa", "fb") <= max_bits)
    )
    joined = connected_components(met.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    return rooted.join(joined, rooted.root == joined.node, "left").select(
        "fp", F.coalesce(joined.root, rooted.root).alias("root")
    )


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """Per row: row, doc, fp, component_id (smallest id reachable over links of at most ``max_bits`` bits).

    Null and wordless texts have fingerprint zero and link like any other. Null ids take part but name no component
    unless all of its ids are null. Repeated rows are rows of one component. An empty table gives an empty result.
    """
    prints = cut_lineage(fingerprints(df, id_col, text_col))
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min("doc").alias("low"), F.count(F.lit(1)).alias("n")))
    roots = cut_lineage(link_components(distinct.select("fp", "n"), max_bits))
    names = roots.join(distinct, "fp")
    low = names.groupBy("root").agg(F.min("low").alias("component_id"))
    named = names.join(low, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("row", "doc", "fp", "component_id")


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component stays, with all its columns: the smallest id, the first stored row of equal ids."""
    df = settled(df)
    groups = near_groups(df, id_col, text_col)
    first = groups.groupBy("component_id").agg(
        F.min_by("row", F.struct(F.col("doc").isNull(), F.col("doc"), F.col("row"))).alias("row")
    )
    return keep_rows(df, first)


@query("op1_simhash_near_dedup")
def op1_simhash_near_dedup(spark, sf):
    groups = near_groups(table(spark, sf, "documents"))
    return groups.select(
        F.col("doc").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
