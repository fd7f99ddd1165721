"""What several operators of this package share."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import cut_lineage, shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MAX_BITS = 1 << 28  # 32 MB, the most a row filter takes
BITS_PER_ROW = 16

WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    """Register a query of this package and, when given, its SQL twin."""

    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a folder of its own in the shared storage and read it back: cuts lineage like a checkpoint, but compressed."""
    path = shared_dir(df.sparkSession, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_ROWS_PER_FILE = 36  # bits of the place in a file
_SCHEME = r"^(\w+):/+"  # a path is written with one slash or three


def _has_places(df: DataFrame) -> bool:
    try:
        df.select(df.metadataColumn("_metadata").getField("row_index"))
    except AnalysisException:
        return False
    return True


def settled(df: DataFrame) -> DataFrame:
    """A frame whose rows have a place in a file: ``df`` itself if it scans Parquet files, else a stored copy."""
    return df if _has_places(df) else stored(df, "rows")


def free_name(df: DataFrame, base: str = "row") -> str:
    """A column name that no column of ``df`` has, whatever their case."""
    taken = {c.lower() for c in df.columns}
    while base in taken:
        base += "_"
    return base


def with_row(df: DataFrame, name: str) -> DataFrame:
    """``df``, which must be settled, with a bigint that identifies a row: number of its file, place in the file.

    It depends on the files alone, not on how a scan is split, so two scans agree even if executors come and go in
    between. The files are numbered by the listing that the driver holds for the scan.
    """
    meta = df.metadataColumn("_metadata")
    place = meta.getField("row_index")
    files = sorted({re.sub(_SCHEME, r"\1:/", f) for f in df.inputFiles()})
    if len(files) < 2:
        return df.withColumn(name, place)
    path, number = free_name(df, "file_path"), free_name(df, "file_number")
    own = f"{path}_of_row"
    while own in df.columns:
        own += "_"
    listed = df.sparkSession.createDataFrame(list(enumerate(files)), f"{number} bigint, {path} string")
    named = df.select("*", place.alias(name), F.regexp_replace(meta.getField("file_path"), _SCHEME, "$1:/").alias(own))
    joined = named.join(F.broadcast(listed), F.col(own) == F.col(path), "left")  # the driver's own list of files
    number = F.coalesce(F.col(number), F.raise_error(F.lit("a scanned file is not in the listing")).cast("bigint"))
    return joined.select(*(df[c] for c in df.columns), (F.shiftleft(number, _ROWS_PER_FILE) + F.col(name)).alias(name))


def identified(df: DataFrame, **columns: Column) -> DataFrame:
    """(row, *columns) of a settled frame."""
    name = free_name(df)
    return with_row(df, name).select(F.col(name).alias("row"), *(c.alias(k) for k, c in columns.items()))


def keep_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of a settled frame whose identity is in ``rows(row)``, with all their columns and no other."""
    name = free_name(df)
    kept = rows.select(F.col("row").alias(name))
    return with_row(df, name).join(kept, name, "left_semi").select(*(F.col(f"`{c}`") for c in df.columns))


def utf8(column: pa.Array) -> Iterator[bytes | None]:
    """The values of a binary column one at a time."""
    for value in column:
        yield value.as_py()


class Rows:
    """Collects output rows and hands them out in batches of bounded size."""

    def __init__(self, schema: pa.Schema, max_rows: int = 20_000, max_bytes: int = 8 << 20):
        self.schema, self.max_rows, self.max_bytes = schema, max_rows, max_bytes
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, row: tuple, weight: int = 0) -> bool:
        """True when it is time to hand out a batch."""
        self.rows.append(row)
        self.bytes += weight
        return len(self.rows) >= self.max_rows or self.bytes >= self.max_bytes

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [()] * len(self.schema)
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(columns, self.schema)], schema=self.schema
        )
        self.rows, self.bytes = [], 0
        return out


def slices(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that a task never holds many long texts in decoded form."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


ROWS_PER_TASK = 200_000  # of rows of a few numbers


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """A stored frame read by as many tasks as its rows need, so what follows leaves few files behind."""
    return df.coalesce(max(1, -(-rows // ROWS_PER_TASK)))


def compact(df: DataFrame) -> DataFrame:
    kept = cut_lineage(df)
    return few_tasks(kept, kept.count())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges(a, b)``; root is the smallest node of the component.

    Large-star and small-star steps over distributed edges, each round cut with a reliable checkpoint, until a round changes
    nothing. Neighbours are reduced to their minimum by aggregation, never gathered; nothing but a count and a
    checksum per round reaches the driver.
    """
    edges = cut_lineage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        edges = few_tasks(edges, state[0])
        if not state[0] or state == before:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        edges = cut_lineage(small.where("u <> v").distinct())
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _bits_of(rows: np.ndarray, bits: int) -> np.ndarray:
    mixed = rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(31))) % np.uint64(bits)).astype(np.int64)


def row_filter(rows: DataFrame, per_row: int = BITS_PER_ROW) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """Keeps the rows of a batch whose ``row`` may be among ``rows(row)``: a bit set of bounded size, for use in tasks."""
    spark = rows.sparkSession
    bits = int(min(MAX_BITS, max(64, per_row * rows.count())))

    def places(batches):
        for batch in batches:
            at = _bits_of(batch.column(0).to_numpy(), bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], names=["at", "bit"]
            )

    marks = rows.select("row").mapInArrow(places, "at bigint, bit bigint").groupBy("at").agg(F.bit_or("bit").alias("bits"))
    got = marks.toArrow()  # at most MAX_BITS / 64 rows
    filled = np.zeros(bits // 64 + 1, np.int64)
    filled[got.column("at").to_numpy()] = got.column("bits").to_numpy()
    shared = spark.sparkContext.broadcast(filled)

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = _bits_of(batch.column("row").to_numpy(), bits)
        hit = (shared.value[at >> 6].view(np.uint64) >> (at & 63).astype(np.uint64)) & np.uint64(1)
        return batch.filter(pa.array(hit.astype(bool)))

    return keep


def rows_among(source: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of ``source(row, doc, text)`` that may be among ``rows(row)``; keeps most others out of the join behind it."""
    keep = row_filter(rows)

    def pass_on(batches):
        for batch in batches:
            yield keep(batch)

    return source.mapInArrow(pass_on, "row bigint, doc bigint, text binary")
