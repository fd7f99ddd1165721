"""Harmonic packing.

Documents stay whole where they can. A document of a length in (capacity / (k + 1), capacity / k] is of class k, and a
sequence of class k takes exactly k such documents, whatever the other classes do. So a worker fills its
sequences on its own while it reads its documents: no shuffle, and an open sequence holds at most k documents.

What k documents leave of a sequence would be padding. It takes short documents whole, those below the last class, and then
a cut of the one stream that is made to be cut: documents longer than a sequence. Only where that stream runs dry is
the worst filled of many waiting sequences taken apart into it. What is open at the end of a task is laid end to end and
closed as sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import json
import os
import re
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import chain, compress, count, repeat
from operator import add, is_

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from riskloom.llm.common import Rows, query, slices, table, utf8

CAPACITY = 2048
CLASSES = 16  # documents below capacity / 17 ids fill gaps
WAITING = 64  # full sequences of a task that wait for something to fill their gap
RESERVE = 16  # sequences' worth of the stream, and of short documents, that a task keeps for gaps
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
CACHED_WORDS = 1_300_000  # words whose ids a worker remembers, at most
GROUP_BYTES = 1 << 17  # of text whose new words are learned at once
#: the end of a pattern that takes runs of letters, single digits, and runs of anything else
_LETTERS_APART = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: letters that lower-case one by one, and punctuation without apostrophes or marks of special tokens
_LATIN = r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f]+)([.,;:!?%*#$&\"()\[\]+=@/_^~`{}\\-]*)"
#: the same punctuation
_MARKS = b".,;:!?%*#$&\"()[]+=@/_^~`{}\\-"
#: one word a line: its letters and its punctuation, or whatever else it is
_LINES = re.compile(rf"(?:{_LATIN}|([^\n]+))\n")
_END = END_ID.to_bytes(4, "little")
_PIECES = pa.schema(
    [
        ("doc", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
_PIECES_SQL = (
    "doc bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
)


def _keeps_letters(model: dict) -> bool:
    """Whether a run of the letters a to z reaches the model of such a tokenizer unchanged and in one piece."""

    def harmless(step: dict) -> bool:
        blanks = step["type"] == "Replace" and step["pattern"] == {"Regex": r"\s+"}
        return blanks or step["type"] in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase")

    normalizer, (split, *others) = model["normalizer"], model["pre_tokenizer"]["pretokenizers"]
    before = split["pattern"]["Regex"].removesuffix(_LETTERS_APART)
    return (
        all(map(harmless, normalizer.get("normalizers", [normalizer])))
        and all(x.startswith("'") for x in before.split("|") if x)
        and all(x["type"] == "ByteLevel" and not x["add_prefix_space"] and not x["use_regex"] for x in others)
        and not any(x["content"].isalpha() for x in model["added_tokens"])
    )


class WordIds:
    """Ids of whole texts for a tokenizer that never joins ids across ASCII white space.

    Texts are split there, and a distinct word is encoded once while it is remembered. The memory of words, and
    that of their parts, is bounded: when one half is full it becomes the old half, from which what is still in use comes back.

    Where the tokenizer lower-cases, splits letters from all else and marks the ends of words, a Latin word with
    punctuation behind it is its lower-case letters and its punctuation, and many such parts are encoded in one text and
    told apart at the end marks. Parts of the letters a to z alone go straight to the tokenizer's model, if its
    other steps leave them as they are. Other words, and all words of other tokenizers, are encoded one by one.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallel part
        self.tokenizer = Tokenizer.from_file(path)
        self.half = cached // 2
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.old_parts: dict[str, bytes] = {}
        model = json.loads(self.tokenizer.to_str())
        steps = (model["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        suffix = model["model"].get("end_of_word_suffix")
        self.by_parts = (
            bool(suffix)
            and "Lowercase" in json.dumps(model["normalizer"])
            and (steps[0].get("pattern") or {}).get("Regex", "").endswith(_LETTERS_APART)
        )
        if self.by_parts:
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[k for token, k in vocabulary.items() if token.endswith(suffix)]] = True
        self.plain = None
        if self.by_parts and _keeps_letters(model):
            self.plain = Tokenizer(self.tokenizer.model)  # the same model, without the steps before it
            self.plain.pre_tokenizer = WhitespaceSplit()

    def encode(self, words: list[str]) -> Iterator[bytes]:
        for at in range(0, len(words), 10_000):
            for coded in self.tokenizer.encode_batch_fast(words[at : at + 10_000], add_special_tokens=False):
                yield np.array(coded.ids, "<u4").tobytes()

    def learn_parts(self, parts: list[str]) -> None:
        if self.plain:
            letters = [part for part in parts if part.isascii() and part.isalpha()]
            self._learn_parts(letters, self.plain)
            parts = [part for part in parts if not (part.isascii() and part.isalpha())]
        self._learn_parts(parts, self.tokenizer)

    def _learn_parts(self, parts: list[str], tokenizer: Tokenizer) -> None:
        for at in range(0, len(parts), 200):  # a long text costs the tokenizer more a part
            some = parts[at : at + 200]
            ids = np.array(tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            stops = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(stops) == len(some):
                raw, start = ids.tobytes(), 0
                for part, stop in zip(some, stops.tolist()):
                    self.parts[part] = raw[start:stop]
                    start = stop
            else:
                self.parts.update(zip(some, self.encode(some)))

    def learn(self, words: Iterable[bytes]) -> None:
        if len(self.parts) > self.half:
            self.old_parts, self.parts = self.parts, {}
        known, old, parts, old_parts = self.known, self.old, self.parts, self.old_parts
        fresh = []
        for word in words:
            ids = old.get(word)
            if ids is None:
                fresh.append(word)
            else:
                known[word] = ids
        if not self.by_parts:
            known.update(zip(fresh, self.encode([w.decode() for w in fresh])))
            return
        lower = b"\n".join(fresh).lower().split(b"\n")  # a word has no line end
        stems = [word.rstrip(_MARKS) for word in lower]
        odd = [word for word, stem in zip(fresh, stems) if not stem.isalpha()]  # of bytes: a to z only
        if odd:
            even = [stem.isalpha() for stem in stems]
            lower, stems, fresh = (list(compress(x, even)) for x in (lower, stems, fresh))
        letters = b"\n".join(stems).decode().split("\n") if fresh else []
        rests = b"\n".join([word[len(stem) :] for word, stem in zip(lower, stems)]).decode().split("\n") if fresh else []
        found = _LINES.findall(b"\n".join([*odd, b""]).decode())
        letters += "\n".join([f[0] for f in found]).lower().split("\n") if found else []
        fresh += odd
        rests += [f[1] for f in found]
        new = set(letters).union(rests).difference(parts)
        new.discard("")
        back = [part for part in new if part in old_parts]
        parts.update(zip(back, map(old_parts.__getitem__, back)))
        self.learn_parts(sorted(new.difference(back)))
        parts[""] = b""
        ids_of = parts.__getitem__
        known.update(zip(fresh, map(add, map(ids_of, letters), map(ids_of, rests))))
        whole = [(word, other) for word, (_, _, other) in zip(odd, found) if other]
        known.update(zip((w for w, _ in whole), self.encode([t for _, t in whole])))

    def __call__(self, text: bytes) -> np.ndarray:
        return next(self.each([text]))

    def each(self, texts: Iterable[bytes]) -> Iterator[np.ndarray]:
        """Ids of one text after the other; new words of ``GROUP_BYTES`` of text are learned at once."""
        group, size = [], 0
        for text in texts:
            group.append(text.split())
            size += len(text)
            if size >= GROUP_BYTES:
                yield from self._ids(group)
                group, size = [], 0
        yield from self._ids(group)

    def _ids(self, group: list[list[bytes]]) -> Iterator[np.ndarray]:
        words = list(chain.from_iterable(group))
        ids = list(map(self.known.get, words))
        gaps = list(compress(count(), map(is_, ids, repeat(None))))
        if gaps:
            if len(self.known) > self.half:
                self.old, self.known = self.known, {}
            self.learn({words[i] for i in gaps})
            for i in gaps:
                ids[i] = self.known[words[i]]
        start = 0
        for own in group:
            yield np.frombuffer(b"".join(ids[start : start + len(own)]) + _END, "<u4")
            start += len(own)


class _Open:
    """Open sequences of one task. A piece is (document, start, ids, ids of the document)."""

    def __init__(self, capacity: int, classes: int, first_id: int):
        self.capacity, self.classes, self.next_id = capacity, classes, first_id
        self.waiting: list[list[tuple]] = [[] for _ in range(classes + 1)]
        self.full: list[tuple[int, list[tuple]]] = []  # (gap, pieces)
        self.short: deque[tuple] = deque()
        self.stream: deque[tuple] = deque()
        self.short_size = self.stream_size = 0

    def close(self, pieces: list[tuple]) -> list[tuple]:
        out, offset = [], 0
        for doc, start, ids, total in pieces:
            out.append((doc, start, len(ids), ids.tobytes(), total, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1
        return out

    def pour(self, piece: tuple) -> None:
        self.stream.append(piece)
        self.stream_size += len(piece[2])

    def cut(self, size: int) -> list[tuple]:
        """The first ``size`` ids of the stream."""
        taken, room = [], size
        while room:
            piece = self.stream.popleft()
            doc, start, ids, total = piece
            if len(ids) > room:
                self.stream.appendleft((doc, start + room, ids[room:], total))
                piece = (doc, start, ids[:room], total)
            taken.append(piece)
            room -= len(piece[2])
        self.stream_size -= size
        return taken

    def fill(self, gap: int, pieces: list[tuple]) -> bool:
        """Short documents that fit, then the stream; whether the sequence can be closed."""
        while gap and self.short and len(self.short[0][2]) <= gap:
            piece = self.short.popleft()
            self.short_size -= len(piece[2])
            pieces.append(piece)
            gap -= len(piece[2])
        if gap > self.stream_size:
            self.full.append((gap, pieces))
            return False
        pieces.extend(self.cut(gap))
        return True

    def settle(self) -> Iterator[tuple]:
        """Close what waits while the stream lasts."""
        while self.full and self.full[-1][0] <= self.stream_size:
            gap, pieces = self.full.pop()
            if self.fill(gap, pieces):
                yield from self.close(pieces)

    def put(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        size = len(ids)
        k = self.capacity // size
        piece = (doc, 0, ids, size)
        if k == 0:
            self.pour(piece)
        elif k > self.classes:
            self.short.append(piece)
            self.short_size += size
            while self.short_size > RESERVE * self.capacity:
                first = self.short.popleft()
                self.short_size -= len(first[2])
                self.pour(first)
        else:
            open_ = self.waiting[k]
            open_.append(piece)
            if len(open_) == k:
                self.waiting[k] = []
                if self.fill(self.capacity - sum(len(p[2]) for p in open_), open_):
                    yield from self.close(open_)
        if len(self.full) > WAITING:
            worst = max(range(len(self.full)), key=lambda i: self.full[i][0])
            for own in self.full.pop(worst)[1]:
                self.pour(own)
        if self.full:
            yield from self.settle()
        while self.stream_size > RESERVE * self.capacity:
            yield from self.close(self.cut(self.capacity))

    def end(self) -> Iterator[tuple]:
        for open_ in self.waiting:
            for piece in open_:
                self.pour(piece)
        self.full.sort(key=lambda x: -x[0])  # small gaps first, from the end
        yield from self.settle()
        for piece in self.short:
            self.pour(piece)
        self.short.clear()
        while self.full:
            yield from self.settle()
            if self.full:
                for piece in self.full.pop(0)[1]:
                    self.pour(piece)
        while self.stream_size >= self.capacity:
            yield from self.close(self.cut(self.capacity))
        while self.stream_size:
            yield from self.close(self.cut(1 << (self.stream_size.bit_length() - 1)))


def _pack(path: str, capacity: int, classes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordIds(path)
        open_ = _Open(capacity, classes, TaskContext.get().partitionId() << 33)
        out = Rows(_PIECES)
        for batch in slices(batches, 256):
            texts = (text or b"" for text in utf8(batch.column(1)))
            for doc, ids in zip(batch.column(0).to_pylist(), coder.each(texts)):
                for piece in open_.put(doc, ids):
                    if out.add(piece, len(piece[3])):
                        yield out.batch()
        for piece in open_.end():
            out.add(piece)
        yield out.batch()

    return run


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    classes: int = CLASSES,
) -> DataFrame:
    """Pieces: doc, start, length, ids (unsigned 32-bit, little-endian), doc_tokens, sequence_id, offset.

    Null text counts as empty, and an empty text is its end id alone. Repeated rows and repeated or null ids are packed
    like any other row. ``capacity`` is a power of two. An empty table gives an empty result. The numbering
    follows the partitions of the table read.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    source = df.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).cast("binary").alias("text"))
    return source.mapInArrow(_pack(path, capacity, classes), _PIECES_SQL)


def piece_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        F.col("doc").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query("op2_harmonic_packing")
def op2_harmonic_packing(spark, sf):
    return piece_digest(pack(table(spark, sf, "documents")))
