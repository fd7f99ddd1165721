"""MinHash near-dedup with sequential Bayesian verification.

A document's set of word shingles is reduced to a signature of minimum hashes. Signatures are cut into bands, and documents
that share a band are candidates. A candidate pair's signatures are compared batch by batch: after m agreements in n values the
similarity has, from a uniform prior, the posterior Beta(m + 1, n - m + 1); as soon as the chance that it reaches the threshold falls
under the chosen miss probability, the pair is dropped. What survives is verified on the full sets.

Equal sets are one node from the start. Each member of a band that many documents share is first held against one pivot of the
band, first the member that shares most bands with others, then members drawn by hash, and links found so join documents
into one component. Pairs that no component joins then meet inside tasks, a band's members at a time (two tiles of them, where
they are many): signatures first; the sets are fetched, once for a band, only for members that a likely partner is left for.
No row is made for a pair, only for a member of a band and for links that join something.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import (
    Rows,
    compact,
    connected_components,
    few_tasks,
    identified,
    query,
    row_filter,
    settled,
    slices,
    stored,
    table,
    utf8,
)
from riskloom.session import cut_lineage

SHINGLE = 3
#: Linked: PARTS * shared shingles >= LEAST * shingles of either.
PARTS, LEAST = 100, 85
#: A pair at the threshold shares no band of four values with a chance of (1 - 0.85 ** 4) ** 32 = 6e-11.
BANDS, BAND = 32, 4
BATCH = 32
MISS = 1e-10
SEED = 11
#: A band of so many members is held against pivots first.
CROWD = 128
#: Members of a band, and hashes of their sets, that one side of a tile holds, about.
TILE, TILE_HASHES = 1024, 1 << 21
#: Bits a document of the filter that picks signatures and sets, before a join.
BODY_BITS = 32
#: Links a pivot verifies in one task.
PIVOT_PAIRS = 512
#: Pivots that a member is held against in one round.
PIVOTS = 4
#: Rounds of pivots drawn by hash, which end when a round joins less than one in WORTH of the components that are left.
ROUNDS, WORTH = 4, 50
_WORDS = 1 << 17
_CHUNK = 2048
_PAIRS = 1 << 16
_COLUMNS = 4096

_SKETCH = "row bigint, doc bigint, n bigint, digest binary, signature binary"
_SETS = pa.schema([("row", pa.int64()), ("hashes", pa.binary())])


def _odd(seed: int, n: int, kind) -> np.ndarray:
    info = np.iinfo(kind)
    return np.random.default_rng(seed).integers(0, info.max, n, dtype=kind, endpoint=True) | kind(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


class Shingles:
    """Distinct 64-bit hashes of a text's shingles, sorted."""

    def __init__(self, width: int = SHINGLE, seed: int = SEED):
        self.width = width
        self.factors = _odd(seed, width, np.uint64)
        self.known = _WordHashes()

    def hashes(self, text: bytes) -> np.ndarray:
        words = text.lower().split()  # of bytes: A to Z only, split at ASCII white space
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > _WORDS:
            known.clear()
        codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        mixed = np.full(len(words) - width + 1, width, np.uint64)  # a short text is no part of a longer one
        for k in range(width):
            mixed += codes[k : len(codes) - width + 1 + k] * self.factors[k]
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)


class Signer:
    """Minimum of each of many hash functions over a set, its low 16 bits: others of these agree once in 65,536 times."""

    def __init__(self, size: int = BANDS * BAND, seed: int = SEED):
        self.factors, self.shifts = _odd(seed + 1, size, np.uint32)[:, None], _odd(seed + 2, size, np.uint32)[:, None]

    def sign(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(self.factors), np.iinfo(np.uint32).max, np.uint32)
        high = (hashes >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(high), _CHUNK):
            out = np.minimum(out, (high[None, at : at + _CHUNK] * self.factors + self.shifts).min(1))
        return out.astype(np.uint16)


def least_agreements(n: int, threshold: float = LEAST / PARTS, miss: float = MISS) -> int:
    """Agreements in ``n`` values from which a pair goes on.

    With a uniform prior the chance that the similarity reaches ``threshold`` after m agreements is that of at most m successes
    in n + 1 draws of chance ``threshold``.
    """
    below = 0.0
    for m in range(n + 1):
        below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if below >= miss:
            return m
    return n


def _sketches(shingle: int, bands: int, band: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, signer = Shingles(shingle), Signer(bands * band)
        for batch in slices(batches, 512):
            sizes, digests, signatures = [], [], []
            for text in utf8(batch.column("text")):
                hashes = shingles.hashes(text or b"")
                sizes.append(len(hashes))
                digests.append(hashlib.md5(hashes.tobytes()).digest())
                signatures.append(signer.sign(hashes).tobytes() if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(signatures, pa.binary()),
                ],
                names=["row", "doc", "n", "digest", "signature"],
            )

    return run


def _band_keys(bands: int, band: int):
    """(rep, n, keys): a key for each band."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _odd(SEED + 3, band, np.uint64)
        for batch in slices(batches, 512):
            n = batch.num_rows
            if not n:
                continue
            signs = np.frombuffer(b"".join(utf8(batch.column("signature"))), np.uint16).reshape(n, -1)
            keys = (signs.reshape(n, bands, band) * factors).sum(2, dtype=np.uint64)
            keys = (keys ^ (keys >> np.uint64(29))) + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            offsets = np.arange(0, n * bands + 1, bands, dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("n"), lists], names=["rep", "n", "keys"])

    return run


def _sets(shingle: int, keep: Callable[[pa.RecordBatch], pa.RecordBatch]):
    """Sets of the rows that ``keep`` lets through, in the same worker."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, out = Shingles(shingle), Rows(_SETS)
        for batch in map(keep, slices(batches, 512)):
            for row, text in zip(batch.column("row").to_pylist(), utf8(batch.column("text"))):
                hashes = shingles.hashes(text or b"").tobytes()
                if out.add((row, hashes), len(hashes)):
                    yield out.batch()
        yield out.batch()

    return run


def _needed(batch_size: int, size: int, miss: float, threshold: float) -> list[tuple[int, int]]:
    return [(k, least_agreements(k, threshold, miss)) for k in [*range(batch_size, size, batch_size), size]]


def _compare(batch_size: int, size: int, miss: float, threshold: float):
    """Of rows (b, a, salt, lead, signature) sorted by pivot, the lead first: pairs that outlive every batch."""
    needed = _needed(batch_size, size, miss, threshold)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pivot = None, None
        for batch in slices(batches, 4096):
            n = batch.num_rows
            if not n:
                continue
            groups = list(zip(batch.column("a").to_pylist(), batch.column("salt").to_pylist()))
            lead = batch.column("lead").to_numpy(zero_copy_only=False)
            signs = np.frombuffer(b"".join(utf8(batch.column("body"))), np.uint16).reshape(n, -1)
            pivots = np.empty_like(signs)
            for i in range(n):
                if lead[i]:
                    key, pivot = groups[i], signs[i]
                elif groups[i] != key:
                    raise ValueError("a pair without its pivot")
                pivots[i] = pivot
            go, agreed, done = np.flatnonzero(~lead), np.zeros(n, np.int64), 0
            for seen, least in needed:
                agreed[go] += (signs[go, done:seen] == pivots[go, done:seen]).sum(1)
                go, done = go[agreed[go] >= least], seen
            at = pa.array(go)
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], names=["a", "b"])

    return run


def _verify(parts: int, least: int):
    """Of the same rows with sorted sets: pairs whose sets are similar enough."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pivot = None, None
        for batch in slices(batches, 512):
            found = []
            columns = (batch.column(c).to_pylist() for c in ("a", "salt", "lead", "b"))
            for i, (a, salt, lead, b) in enumerate(zip(*columns)):
                own = np.frombuffer(batch.column("body")[i].as_py(), np.uint64)
                if lead:
                    key, pivot = (a, salt), own
                    continue
                if (a, salt) != key:
                    raise ValueError("a pair without its pivot")
                small, large = (own, pivot) if len(own) < len(pivot) else (pivot, own)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                if parts * both >= least * (len(own) + len(pivot) - both):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

    return run


def _passing(keep: Callable[[pa.RecordBatch], pa.RecordBatch]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(keep, batches)

    return run


def bodies_of(reps: DataFrame, bodies: DataFrame) -> DataFrame:
    """Rows of ``bodies(rep, body)`` that may be among ``reps(rep)``: a join behind it shuffles few others."""
    keep = row_filter(reps.select(F.col("rep").alias("row")).distinct(), BODY_BITS)
    rows = bodies.select(F.col("rep").alias("row"), "body")
    return rows.mapInArrow(_passing(keep), "row bigint, body binary").withColumnRenamed("row", "rep")


def _beside_pivots(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """(a, salt, lead, b, body): each b of ``pairs(a, b)`` with its body, after a row with the body of its a.

    The pairs of a frequent a are dealt over several salts, each with the pivot's body in front.
    """
    leads, others = (bodies_of(pairs.select(F.col(c).alias("rep")), bodies) for c in ("a", "b"))
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PIVOT_PAIRS).alias("parts"))
    other = F.pmod(F.xxhash64("b"), F.col("parts"))
    dealt = pairs.join(parts, "a").select("a", other.alias("salt"), "b")
    follow = dealt.join(others.withColumnRenamed("rep", "b"), "b").select("a", "salt", F.lit(False).alias("lead"), "b", "body")
    heads = dealt.select("a", "salt").distinct().join(leads.withColumnRenamed("rep", "a"), "a")
    heads = heads.select("a", "salt", F.lit(True).alias("lead"), F.lit(None).cast("bigint").alias("b"), "body")
    return heads.unionByName(follow).repartition("a", "salt").sortWithinPartitions("a", "salt", F.desc("lead"))


_TILE = ("key", "p", "q")
_MEMBER = "key bigint, p int, q int, part int, band int, rep bigint, root bigint, n bigint, body binary"


def whole_groups(batches: Iterable[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of whole groups of rows that are sorted by ``names``, each with the groups' bounds."""
    held: list[pa.RecordBatch] = []

    def bounds(batch: pa.RecordBatch) -> np.ndarray:
        new = np.zeros(max(0, batch.num_rows - 1), bool)
        for name in names:
            values = batch.column(name).to_numpy()
            new |= values[1:] != values[:-1]
        return np.r_[0, np.flatnonzero(new) + 1, batch.num_rows]

    def made() -> tuple[pa.RecordBatch, np.ndarray]:
        batch = held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        held.clear()
        return batch, bounds(batch)

    for batch in batches:
        if not batch.num_rows:
            continue
        cut = int(bounds(batch)[-2])
        if held and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in names):
            yield made()
        if cut:
            held.append(batch.slice(0, cut))
            yield made()
        held.append(batch.slice(cut))
    if held:
        yield made()


def pairs_within(bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows i < j of one group, some at a time."""
    starts, sizes = bounds[:-1], np.diff(bounds)
    for size in np.unique(sizes[sizes > 1]).tolist():
        own = starts[sizes == size]
        if size * size <= _PAIRS:
            i, j = np.triu_indices(size, 1)
            step = max(1, _PAIRS // len(i))
            for at in range(0, len(own), step):
                first = own[at : at + step, None]
                yield (first + i).ravel(), (first + j).ravel()
        else:
            step = max(1, _PAIRS // size)
            for first in own.tolist():
                for at in range(0, size - 1, step):
                    i, j = np.arange(at, min(at + step, size - 1)), np.arange(at + 1, size)
                    i, j = np.repeat(i, len(j)), np.tile(j, len(i))
                    yield first + i[j > i], first + j[j > i]


class Likely:
    """Pairs of a tile that no component joins and whose signatures agree enough, each in the first band that it shares."""

    def __init__(self, bands: int, band: int, miss: float, parts: int, least: int):
        self.bands, self.band, self.parts, self.least = bands, band, parts, least
        self.needed = _needed(BATCH, bands * band, miss, least / parts)

    def __call__(self, batch: pa.RecordBatch, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        root, n, part, own = (batch.column(c).to_numpy() for c in ("root", "n", "part", "band"))
        inside = batch.column("p").to_numpy() == batch.column("q").to_numpy()
        signs = np.frombuffer(b"".join(utf8(batch.column("body"))), np.uint16).reshape(len(n), -1)
        for i, j in pairs_within(bounds):
            go = (root[i] != root[j]) & (inside[i] | (part[i] != part[j])) & (own[i] == own[j])
            i, j = i[go], j[go]
            go = self.parts * np.minimum(n[i], n[j]) >= self.least * np.maximum(n[i], n[j])
            i, j = i[go], j[go]
            agreed, done = np.zeros(len(i), np.int64), 0
            for seen, least in self.needed:
                agreed += (signs[i, done:seen] == signs[j, done:seen]).sum(1)
                go, done = agreed >= least, seen
                i, j, agreed = i[go], j[go], agreed[go]
            shared = (signs[i] == signs[j]).reshape(len(i), self.bands, self.band).all(2)
            go = shared[np.arange(len(i)), own[i]] & (shared.argmax(1) == own[i])
            if go.any():
                yield i[go], j[go]


def _left(likely: Likely):
    """The members of tiles that have a likely partner there."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bounds in whole_groups(batches, _TILE):
            left = np.zeros(batch.num_rows, bool)
            for i, j in likely(batch, bounds):
                left[i] = left[j] = True
            yield batch.filter(pa.array(left))

    return run


def shared_sizes(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Size of the intersection of each sets[i], sets[j]: what occurs in two sets or more is a column of a bit table."""
    _, codes, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    owner, codes = owner[counts[codes] > 1], codes[counts[codes] > 1]
    codes = (np.cumsum(counts > 1) - 1)[codes]
    out, width = np.zeros(len(i), np.int64), int((counts > 1).sum())
    for low in range(0, width, _COLUMNS):
        here = (codes >= low) & (codes < low + _COLUMNS)
        table = np.zeros((len(sets), -(-min(_COLUMNS, width - low) // 64) * 64), bool)
        table[owner[here], codes[here] - low] = True
        bits = np.packbits(table, axis=1).view(np.uint64)
        for at in range(0, len(i), _COLUMNS):
            both = bits[i[at : at + _COLUMNS]] & bits[j[at : at + _COLUMNS]]
            out[at : at + _COLUMNS] += np.bitwise_count(both).sum(1, dtype=np.int64)
    return out


class _Joins(dict):
    """Components among roots; a root that is not named is its own."""

    def top(self, x: int) -> int:
        while (up := self.get(x, x)) != x:
            self[x] = x = self.get(up, up)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.top(a), self.top(b)
        self[max(a, b)] = min(a, b)
        return a != b


def _links(likely: Likely):
    """(a, b) for tiles with the members' sets: links that join what no link before them in the tile does."""
    parts, least = likely.parts, likely.least

    def found(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
        reps, roots = batch.column("rep").to_pylist(), batch.column("root").to_pylist()
        n, sets = batch.column("n").to_numpy(), [np.frombuffer(x, np.uint64) for x in utf8(batch.column("hashes"))]
        joins = _Joins()
        for i, j in likely(batch, np.array([0, batch.num_rows])):
            if joins:
                tops = np.array([joins.top(r) for r in roots])
                i, j = i[tops[i] != tops[j]], j[tops[i] != tops[j]]
            both = shared_sizes(sets, i, j)
            for at in np.flatnonzero(parts * both >= least * (n[i] + n[j] - both)).tolist():
                a, b = int(i[at]), int(j[at])
                if joins.join(roots[a], roots[b]):
                    yield reps[a], reps[b]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bounds in whole_groups(batches, _TILE):
            out = [x for low, high in zip(bounds[:-1], bounds[1:]) for x in found(batch.slice(low, high - low))]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def in_tiles(members: DataFrame, tile: int, hashes: int) -> DataFrame:
    """``members(key, rep, n, ...)`` with (p, q, part): every two members of a key meet in one tile (key, p, q) with p <= q.

    Members are dealt over parts of about ``tile`` members and ``hashes`` in their sets; a tile with p < q holds two parts.
    """
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / tile), F.ceil(F.sum("n") / hashes)).cast("int")
    sizes = members.groupBy("key").agg(parts.alias("parts"))
    dealt = members.join(sizes, "key").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return dealt.withColumns({"p": F.least("part", "other"), "q": F.greatest("part", "other")}).drop("parts", "other")


class Links:
    """Verified links among the representatives of bands."""

    def __init__(self, signatures: DataFrame, sets: DataFrame, bands: int, band: int, parts: int, least: int, miss: float):
        self.signatures, self.sets = signatures, sets
        self.likely = Likely(bands, band, miss, parts, least)
        self.compare = _compare(BATCH, bands * band, miss, least / parts)
        self.verify = _verify(parts, least)

    def of(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of ``pairs``, distinct, that are linked."""
        likely = _beside_pivots(pairs, self.signatures).mapInArrow(self.compare, "a bigint, b bigint")
        return compact(_beside_pivots(compact(likely), self.sets).mapInArrow(self.verify, "a bigint, b bigint"))

    def among(self, members: DataFrame, tile: int = TILE, hashes: int = TILE_HASHES) -> DataFrame:
        """Links (a, b) among ``members(key, rep, band, root, n)`` of one key that join all that linked pairs would join."""

        def tiles(frame: DataFrame) -> DataFrame:
            return frame.repartition(*_TILE).sortWithinPartitions(*_TILE)

        signed = in_tiles(members, tile, hashes).join(self.signatures, "rep").select(*(c.split()[0] for c in _MEMBER.split(", ")))
        left = stored(tiles(signed).mapInArrow(_left(self.likely), _MEMBER), "left")
        with_sets = left.join(bodies_of(left, self.sets).withColumnRenamed("body", "hashes"), "rep")
        return compact(tiles(with_sets).mapInArrow(_links(self.likely), "a bigint, b bigint").distinct())


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(rep, n, root) after ``links`` between representatives join the components of ``roots``."""
    ends = links.join(roots.select(F.col("rep").alias("a"), F.col("root").alias("ra")), "a")
    ends = ends.join(roots.select(F.col("rep").alias("b"), F.col("root").alias("rb")), "b")
    joined = connected_components(ends.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    joined = joined.select("node", F.col("root").alias("joined"))
    return compact(
        roots.join(joined, roots.root == joined.node, "left").select("rep", "n", F.coalesce("joined", "root").alias("root"))
    )


def _near_in_size(a: Column, b: Column, parts: int, least: int) -> Column:
    return parts * F.least(a, b) >= least * F.greatest(a, b)


def _to_pivots(members: DataFrame, roots: DataFrame, rank: Column, parts: int, least: int) -> DataFrame:
    """(a, b): each member b with the pivots a of its bands that lie in other components; those it shares most bands with."""
    now = members.join(roots, "rep")
    pivots = now.groupBy("key").agg(
        F.max_by(F.struct("rep", "n", "root"), rank).alias("p"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    met = now.join(pivots.where("low < high"), "key").where(
        (F.col("root") != F.col("p.root")) & _near_in_size(F.col("n"), F.col("p.n"), parts, least)
    )
    shared = met.groupBy("rep", F.col("p.rep").alias("pivot")).agg(F.count(F.lit(1)).alias("k"))
    # at most a pivot for each band of a member
    best = shared.groupBy("rep").agg(F.slice(F.sort_array(F.collect_list(F.struct("k", "pivot")), asc=False), 1, PIVOTS).alias("best"))
    return best.select(F.explode("best.pivot").alias("a"), F.col("rep").alias("b"))


def open_keys(members: DataFrame) -> DataFrame:
    """(key) of ``members(key, rep, band, root)`` whose members lie in several components.

    Of keys with the same members, as near copies have many, only that of the first band is left: what their pairs share first.
    """
    seen = members.groupBy("key").agg(
        F.min("root").alias("low"),
        F.max("root").alias("high"),
        F.min("band").alias("band"),
        F.max("band").alias("last"),
        F.count(F.lit(1)).alias("k"),
        *(F.bit_xor(F.xxhash64("rep", F.lit(i))).alias(f"digest{i}") for i in range(2)),
    )
    alike = ["low", "high", "k", "digest0", "digest1", F.when(F.col("band") < F.col("last"), F.col("key")).alias("alone")]
    return seen.where("low < high").groupBy(*alike).agg(F.min_by("key", "band").alias("key")).select("key")


def linked_roots(
    members: DataFrame, nodes: DataFrame, links: Links, parts: int, least: int, rounds: int = ROUNDS, crowd: int = CROWD
) -> DataFrame:
    """(rep, n, root): components over all links between members (key, rep, band) of one band; ``nodes(rep, n)`` are all."""
    roots = compact(members.select("rep").distinct().join(nodes, "rep").select("rep", "n", F.col("rep").alias("root")))
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > crowd)
    crowded = compact(members.join(sizes, "key"))
    weights = compact(crowded.groupBy("rep").agg(F.sum("k").alias("weight")))
    before = weights.count()
    for turn in range(rounds + 1 if before else 0):
        rank = F.struct("weight", "rep") if turn == 0 else F.struct(F.xxhash64("rep", F.lit(turn)), F.col("rep"))
        pairs = _to_pivots(crowded.join(weights, "rep") if turn == 0 else crowded, roots, rank, parts, least)
        roots = _joined(roots, links.of(compact(pairs)))
        after = roots.join(weights, "rep", "left_semi").select("root").distinct().count()
        if turn and before - after <= before // WORTH:
            break
        before = after
    now = members.join(roots, "rep")
    return _joined(roots, links.among(now.join(open_keys(now), "key")))


def near_documents(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    parts: int = PARTS,
    least: int = LEAST,
    bands: int = BANDS,
    band: int = BAND,
    miss: float = MISS,
) -> DataFrame:
    """Per row: row, doc, n_shingles, component_id.

    Two rows are linked when ``parts`` * shared shingles >= ``least`` * shingles of either, and component_id is the smallest id reachable.
    Texts without a word, null ones included, are linked with nothing and keep their own id; equal sets are linked whatever their
    size. Null ids take part but name no component unless all its ids are null. Whole texts count, however long. An empty
    table gives an empty result.
    """
    df = settled(df)
    source = identified(df, doc=F.col(id_col).cast("bigint"), text=F.col(text_col).cast("binary"))
    sketches = stored(source.mapInArrow(_sketches(shingle, bands, band), _SKETCH), "sketches")
    worded = sketches.where("n > 0")
    nodes = cut_lineage(
        worded.groupBy("digest").agg(F.min("row").alias("rep"), F.min("doc").alias("low"), F.max("n").alias("n"))
    )
    signed = worded.select(F.col("row").alias("rep"), "n", "signature").join(nodes.select("rep"), "rep", "left_semi")
    attributes = stored(
        signed.mapInArrow(_band_keys(bands, band), "rep bigint, n bigint, keys array<bigint>"), "bands"
    )
    keyed = attributes.select("rep", F.posexplode("keys").alias("band", "key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("key")
    members = stored(keyed.join(shared, "key").select("key", "rep", "band"), "members")
    members = few_tasks(members, members.count())
    wanted = cut_lineage(members.select(F.col("rep").alias("row")).distinct())
    keep = row_filter(wanted, BODY_BITS)  # a few others pass, which no join below finds
    signatures = worded.select("row", F.col("signature").alias("body")).mapInArrow(_passing(keep), "row bigint, body binary")
    signatures = stored(signatures.withColumnRenamed("row", "rep"), "signatures")
    found = source.select("row", "text").mapInArrow(_sets(shingle, keep), "row bigint, hashes binary")
    sets = stored(found.select(F.col("row").alias("rep"), F.col("hashes").alias("body")), "sets")
    links = Links(signatures, sets, bands, band, parts, least, miss)
    roots = linked_roots(members, attributes.select("rep", "n"), links, parts, least)
    rooted = nodes.join(roots.select("rep", "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    names = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(names, "root").select("digest", "component_id")
    with_words = worded.select("row", "doc", "n", "digest").join(named, "digest").select("row", "doc", F.col("n").alias("n_shingles"), "component_id")
    without = sketches.where("n = 0").select("row", "doc", F.col("n").alias("n_shingles"), F.col("doc").alias("component_id"))
    return with_words.unionByName(without)


_SQL = r"""
with recursive
d as (
  select doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
  from documents),
g as (
  select distinct doc_id, array_to_string(words[i:i + 2], ' ') as gram
  from d, lateral (select unnest(range(1, greatest(len(words) - 2, least(len(words), 1)) + 1)) as i)),
sizes as (select doc_id, count(*) as n from g group by doc_id),
links as (
  select a.doc_id as a, b.doc_id as b
  from g a join g b on a.gram = b.gram and a.doc_id <> b.doc_id
  join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id
  having 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))),
reach(doc_id, other) as (
  select doc_id, doc_id from d
  union
  select r.doc_id, l.b from reach r join links l on l.a = r.other)
select doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(other) as component_id, doc_id = min(other) as kept
from reach left join sizes using (doc_id) group by doc_id
"""


@query("op11_minhash_bayes", _SQL)
def op11_minhash_bayes(spark, sf):
    found = near_documents(table(spark, sf, "documents"))
    return found.select(
        F.col("doc").alias("doc_id"), "n_shingles", "component_id", (F.col("doc") == F.col("component_id")).alias("kept")
    )
