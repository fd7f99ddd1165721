"""Substring dedup with repeated-phrase automata.

A window is 13 consecutive words. Every window names one anchor, the smallest hash among its five-word grams, so equal
windows name equal anchors and about one gram in five is an anchor. Anchors of a single document are put aside by one
aggregation. Around the others the texts are cut into fragments, which meet in shards by anchor. In a shard the windows
that recur are confirmed word by word and compiled into one Aho-Corasick automaton, and every fragment of
the shard is streamed through it to find all occurrences.

An anchor that very many documents share has its recurring windows confirmed by aggregation first; its fragments are
then spread over several tasks, each with those windows' automaton. Copies of a whole text are judged by their first
document alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import identified, query, settled, slices, stored, table, utf8
from riskloom.llm.common import rows_among as _row_filter
from riskloom.session import cut_lineage

WINDOW = 13
GRAM = 5
SHARD_PAIRS = 8_000  # (anchor, document) pairs a shard holds, about
HOT_DOCUMENTS = 8_000  # an anchor of more documents is spread over tasks


class Anchors:
    """Anchor hash of every window of a text's words.

    A word's hash is a polynomial in its bytes: the difference of two prefix sums over the text, moved to position 0.
    Equal words have equal hashes, and unequal words that share one only add candidates.
    """

    FACTOR = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64

    def __init__(self, window: int = WINDOW, gram: int = GRAM):
        self.window, self.gram = window, min(gram, window)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            for name, factor in (("up", self.FACTOR), ("down", pow(self.FACTOR, -1, 1 << 64))):
                table = np.full(size, factor, np.uint64)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))

    def codes(self, text: bytes) -> np.ndarray:
        """Hash of every word."""
        raw = np.frombuffer(text, np.uint8)
        self._powers(len(raw) + 1)
        gap = (raw == 32) | ((raw >= 9) & (raw <= 13))
        edge = np.flatnonzero(np.diff(gap, prepend=True, append=True))
        starts, ends = edge[::2], edge[1::2]
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(raw * self.up[: len(raw)], out=sums[1:])
        codes = (sums[ends] - sums[starts]) * self.down[starts]
        codes ^= codes >> np.uint64(32)
        return codes * np.uint64(0xD6E8FEB86659FD93)

    def grams(self, codes: np.ndarray) -> np.ndarray:
        """Hash of every run of ``gram`` words."""
        n = len(codes) - self.gram + 1
        grams = np.zeros(n, np.uint64)
        for j in range(self.gram):
            grams = (grams ^ codes[j : n + j]) * np.uint64(self.FACTOR)
            grams ^= grams >> np.uint64(29)
        return grams

    def hashes(self, codes: np.ndarray) -> np.ndarray:
        """Distinct anchors, sorted: minima over all windows, doubling the width covered."""
        low, covered, width = self.grams(codes), 1, self.window - self.gram + 1
        while covered < width:
            step = min(covered, width - covered)
            low = np.minimum(low[:-step], low[step:])
            covered += step
        return np.unique(low.view(np.int64))

    def __call__(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, hash) of each window's anchor."""
        grams = self.grams(codes)
        views = sliding_window_view(grams, self.window - self.gram + 1)
        at = views.argmin(1) + np.arange(len(views))
        return at, grams[at].view(np.int64)


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 512):
        count, sha = [], []
        for text in utf8(batch.column("text")):
            words = (text or b"").split()
            count.append(len(words))
            sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc"), pa.array(count, pa.int64()), pa.array(sha, pa.string())],
            names=["row", "doc", "n", "sha"],
        )


def _anchor_rows(window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(window)
        for batch in slices(batches, 256):
            rows, docs, found = [], [], []
            for row, doc, text in zip(batch.column("row").to_pylist(), batch.column("doc").to_pylist(), utf8(batch.column("text"))):
                codes = anchors.codes(text or b"")
                if doc is not None and len(codes) >= window:
                    own = anchors.hashes(codes)
                    found.append(own)
                    rows.append(np.full(len(own), row))
                    docs.append(np.full(len(own), doc))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64)) for x in (found, rows, docs)], names=["h", "row", "doc"]
                )

    return run


_FRAGMENTS = pa.schema(
    [("h", pa.int64()), ("n", pa.int64()), ("row", pa.int64()), ("doc", pa.int64()), ("start", pa.int64()), ("words", pa.binary())]
)
_BATCH = 20_000


def _fragments(window: int):
    """Runs of windows with the same recurring anchor, with all words they cover."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(window)
        columns: list[list] = [[] for _ in _FRAGMENTS]
        for batch in slices(batches, 64):
            lists = batch.column("anchors")
            shared = lists.flatten()
            every, counts = (shared.field(k).to_numpy() for k in ("h", "n"))
            edges = np.r_[0, np.cumsum(lists.value_lengths().to_numpy())]
            ids = zip(batch.column("row").to_pylist(), batch.column("doc").to_pylist(), utf8(batch.column("text")))
            for k, (row, doc, text) in enumerate(ids):
                own, n = every[edges[k] : edges[k + 1]], counts[edges[k] : edges[k + 1]]
                order = np.argsort(own)
                own, n = own[order], n[order]
                words = text.split()
                at, hashes = anchors(anchors.codes(text))
                starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                ends = np.r_[starts[1:], len(at)]
                place = np.minimum(np.searchsorted(own, hashes[starts]), len(own) - 1)
                wanted = own[place] == hashes[starts]
                starts, ends, place = starts[wanted], ends[wanted] + window - 1, place[wanted]
                columns[0] += own[place].tolist()
                columns[1] += n[place].tolist()
                columns[2] += [row] * len(starts)
                columns[3] += [doc] * len(starts)
                columns[4] += starts.tolist()
                columns[5] += [b" ".join(words[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                if len(columns[0]) >= _BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FRAGMENTS)], schema=_FRAGMENTS)
                    columns = [[] for _ in _FRAGMENTS]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FRAGMENTS)], schema=_FRAGMENTS)

    return run


_RANGES = pa.schema([("row", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])


def _code(words: list[bytes], codes: dict[bytes, int]) -> tuple[int, ...]:
    return tuple(codes.setdefault(w, len(codes) + 1) for w in words)


class Fragments:
    """The fragments of one group; equal ones are handled once."""

    def __init__(self, table: pa.Table, codes: dict[bytes, int]):
        coded = table.column("words").combine_chunks().dictionary_encode()
        self.texts = [_code(w.split(b" "), codes) for w in coded.dictionary.to_pylist()]
        text = coded.indices.to_numpy()
        self.doc = table.column("doc").to_numpy()
        order = np.lexsort((self.doc, text))
        self.row, self.start = (table.column(c).to_numpy()[order] for c in ("row", "start"))
        self.doc = self.doc[order]
        self.edges = np.searchsorted(text[order], np.arange(len(self.texts) + 1))

    def confirm(self, window: int) -> dict[tuple[int, ...], int]:
        """Windows of more than one document, with the smallest id that has them."""
        low: dict[tuple[int, ...], int] = {}
        many: dict[tuple[int, ...], int] = {}
        first, last = self.doc[self.edges[:-1]].tolist(), self.doc[self.edges[1:] - 1].tolist()
        for words, a, b in zip(self.texts, first, last):
            for k in range(len(words) - window + 1):
                key = words[k : k + window]
                known = low.setdefault(key, a)
                if known != a or a != b:
                    many[key] = low[key] = min(known, a)
        return many

    def locate(self, recurring: dict[tuple[int, ...], int], window: int) -> pa.Table:
        """Word ranges covered by windows that also start in a smaller id."""
        rows, firsts, lasts = [], [], []
        if recurring:
            machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
            docs = sorted(set(recurring.values()))
            place = {doc: k for k, doc in enumerate(docs)}  # ids need not fit an automaton's value
            for key, doc in recurring.items():
                machine.add_word(key, place[doc])
            machine.make_automaton()
            ids, numbers, starts = self.doc.tolist(), self.row.tolist(), self.start.tolist()
            edges = self.edges.tolist()
            for words, a, b in zip(self.texts, edges, edges[1:]):
                hits = [(end - window + 1, docs[k]) for end, k in machine.iter(words)]
                if not hits or ids[b - 1] <= (smallest := min(doc for _, doc in hits)):
                    continue
                largest = max(doc for _, doc in hits)
                whole = _merged([at for at, _ in hits], window)
                for k in range(a, b):
                    doc, start = ids[k], starts[k]
                    if doc > smallest:
                        for first, last in whole if doc > largest else _merged([at for at, d in hits if d < doc], window):
                            rows.append(numbers[k])
                            firsts.append(start + first)
                            lasts.append(start + last)
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (rows, firsts, lasts)], schema=_RANGES)


def _merged(begins: list[int], window: int) -> list[tuple[int, int]]:
    """Windows at ascending places as ranges that do not touch."""
    out: list[tuple[int, int]] = []
    for at in begins:
        if out and at <= out[-1][1]:
            out[-1] = (out[-1][0], at + window)
        else:
            out.append((at, at + window))
    return out


def _shard(window: int):
    def run(table: pa.Table) -> pa.Table:
        fragments = Fragments(table, {})
        return fragments.locate(fragments.confirm(window), window)

    return run


def _windows(window: int):
    """Windows of fragments, combined inside a batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4000):
            found: dict[tuple[int, bytes], tuple[int, int]] = {}
            for h, doc, text in zip(batch.column("h").to_pylist(), batch.column("doc").to_pylist(), utf8(batch.column("words"))):
                words = text.split(b" ")
                for k in range(len(words) - window + 1):
                    key = (h, b" ".join(words[k : k + window]))
                    low, high = found.get(key, (doc, doc))
                    found[key] = (min(low, doc), max(high, doc))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k[0] for k in found], pa.int64()),
                        pa.array([k[1] for k in found], pa.binary()),
                        pa.array([v[0] for v in found.values()], pa.int64()),
                        pa.array([v[1] for v in found.values()], pa.int64()),
                    ],
                    names=["h", "phrase", "low", "high"],
                )

    return run


def _hot_shard(window: int):
    def run(patterns: pa.Table, table: pa.Table) -> pa.Table:
        codes: dict[bytes, int] = {}
        keys = [_code(p.split(b" "), codes) for p in patterns.column("phrase").to_pylist()]
        recurring = dict(zip(keys, patterns.column("low").to_pylist()))
        return Fragments(table, codes).locate(recurring, window)

    return run


def _keep_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 128):
        removed, sha, kept = [], [], []
        for text, ranges in zip(utf8(batch.column("text")), batch.column("ranges").to_pylist()):
            words = text.split()
            gone = np.zeros(len(words) + 1, np.int64)
            for r in ranges:
                gone[r["first"]] += 1
                gone[r["last"]] -= 1
            stay = np.flatnonzero(np.cumsum(gone)[:-1] == 0)
            left = b" ".join([words[i] for i in stay.tolist()])
            removed.append(len(words) - len(stay))
            sha.append(hashlib.sha256(left).hexdigest())
            kept.append(left)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary())],
            names=["row", "removed", "left_sha", "left_text"],
        )


def _ranges(source: DataFrame, whole: DataFrame, window: int) -> DataFrame:
    """(row, first, last): word ranges to remove, copies of whole texts left out."""
    found = source.mapInArrow(_anchor_rows(window), "h bigint, row bigint, doc bigint")
    shared = found.groupBy("h").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count(F.lit(1)).alias("n"))
    shared = shared.where("low < high").select("h", "n")
    pairs = found.select("h", "row").join(shared, "h").groupBy("row").agg(F.collect_list(F.struct("h", "n")).alias("anchors"))
    wanted = cut_lineage(pairs.join(whole.where("not copy").select("row"), "row", "left_semi"))
    total = wanted.agg(F.sum(F.size("anchors"))).first()[0] or 0
    texts = _row_filter(source, wanted).join(wanted, "row")
    schema = "h bigint, n bigint, row bigint, doc bigint, start bigint, words binary"
    fragments = stored(texts.mapInArrow(_fragments(window), schema), "fragments")
    shards = max(1, total // SHARD_PAIRS)
    ranges = "row bigint, first bigint, last bigint"
    cold = fragments.where(F.col("n") <= HOT_DOCUMENTS).groupBy(F.pmod("h", F.lit(shards)).alias("shard"))
    out = cold.applyInArrow(_shard(window), ranges)
    hot = fragments.where(F.col("n") > HOT_DOCUMENTS)
    phrases = hot.mapInArrow(_windows(window), "h bigint, phrase binary, low bigint, high bigint")
    phrases = phrases.groupBy("h", "phrase").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high")
    salts = F.expr(f"cast(n div {HOT_DOCUMENTS} + 1 as int)")
    spread = hot.withColumn("salt", F.pmod(F.xxhash64("row"), salts))
    copies = hot.groupBy("h").agg(F.max("n").alias("n")).select("h", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    patterns = phrases.join(copies, "h").select("h", F.col("salt").cast("bigint").alias("salt"), "phrase", "low")
    found_hot = patterns.groupBy("h", "salt").cogroup(spread.groupBy("h", "salt")).applyInArrow(_hot_shard(window), ranges)
    return out.unionByName(found_hot)


def drop_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: row, doc, n_words, n_removed, kept_sha256, kept_text (null where the whole text stays or goes).

    A word goes if a window covers it whose words also start in a document with a smaller id. Null text has no words. Rows
    with a null id are left alone and count for no one; rows that share an id are one document to others and are
    not compared with each other. An empty table gives an empty result.
    """
    source = identified(settled(df), doc=F.col(id_col).cast("bigint"), text=F.col(text_col).cast("binary"))
    digests = cut_lineage(source.mapInArrow(_digest, "row bigint, doc bigint, n bigint, sha string"))
    firsts = digests.groupBy("sha", "n").agg(F.min("doc").alias("low"))
    copy = F.coalesce((F.col("doc") > F.col("low")) & (F.col("n") >= window), F.lit(False))
    whole = cut_lineage(digests.join(firsts, ["sha", "n"]).select("row", "doc", "n", "sha", copy.alias("copy")))
    ranges = _ranges(source, whole, window).groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    ranges = cut_lineage(ranges)
    cut = _row_filter(source, ranges).join(ranges, "row")
    cut = cut.mapInArrow(_keep_words, "row bigint, removed bigint, left_sha string, left_text binary")
    none = hashlib.sha256(b"").hexdigest()
    return whole.join(cut, "row", "left").select(
        "row",
        "doc",
        F.col("n").alias("n_words"),
        F.when(F.col("copy"), F.col("n")).otherwise(F.coalesce("removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(F.col("copy"), F.lit(none)).otherwise(F.coalesce("left_sha", "sha")).alias("kept_sha256"),
        F.col("left_text").cast("string").alias("kept_text"),
    )


@query(
    "op5_repeated_passages",
    r"""
with w as (
  select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as words from documents),
g as (
  select doc_id, i, array_to_string(words[i:i + 12], ' ') as gram
  from w, lateral (select unnest(range(1, len(words) - 11)) as i)),
f as (select doc_id, i from (select doc_id, i, min(doc_id) over (partition by gram) as low from g) where low < doc_id),
gone as (select distinct doc_id, i + k as p from f, (select unnest(range(13)) as k)),
flat as (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as p from w),
kept as (
  select doc_id, count(*) as n, string_agg(word, ' ' order by p) as text
  from flat anti join gone using (doc_id, p) group by doc_id)
select doc_id, len(words)::bigint as n_words, (len(words) - coalesce(n, 0))::bigint as n_removed,
       sha256(coalesce(kept.text, '')) as kept_sha256
from w left join kept using (doc_id)
""",
)
def op5_repeated_passages(spark, sf):
    judged = drop_passages(table(spark, sf, "documents"))
    return judged.select(F.col("doc").alias("doc_id"), "n_words", "n_removed", "kept_sha256")
