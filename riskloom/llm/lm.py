"""Gated recurrent language model in numpy, trained and applied by Spark tasks.

The output is factored by class: frequent words are classes of a learned softmax each; all other words are classes by
their ending, inside which a word has its smoothed share of the class's training tokens. So every text has a
probability, whatever its words.

Counts cover all training documents. The network starts from the counts, is warmed up on a bounded sample and then trained
once over all training documents, each task on its own partition; the mean of the tasks' weights, by tokens, is
the model. Training unrolls windows of fixed length and carries the state from window to window; scoring carries
it through the whole document.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import identified, query, settled, slices, stored, table, utf8
from riskloom.session import cut_lineage

HEAD_CLASSES = 16
CLASS_WORDS = 48
TAIL_CLASSES = 48
HIDDEN = 16
LANES = 256
STEPS = 32  # of an unrolled window
LISTED = 200_000  # most frequent words whose counts every task holds
WARM_DOCUMENTS = 2000
RATE = 0.1
SEED = 5
SMOOTH = 0.1
_FLUSH = 400_000
_SCORE_TOKENS = 1_000_000  # tokens that are scored side by side, about
_ROWS = 2048  # of the output layer at once
_TOP = np.float32(60)  # states lie between -1 and 1 and weights stay small; keeps exp finite
_LN10 = math.log(10)


@dataclass
class Words:
    """Counts of the listed words; ids 0 is the end of a text, 1 to head - 1 are frequent words, then tail classes."""

    counts: dict[bytes, int]
    head: dict[bytes, int]
    ends: int
    total: int
    distinct: int
    tail_tokens: np.ndarray  # per tail class
    tail_words: np.ndarray

    @property
    def n_head(self) -> int:
        return HEAD_CLASSES * CLASS_WORDS

    @property
    def start(self) -> int:
        return self.n_head + TAIL_CLASSES

    @cached_property
    def slots(self) -> Slots:
        """Made once by a worker."""
        return Slots(self)


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAIL_CLASSES


class Slots(dict):
    """The place of each listed word in tables of all listed words; words that are not listed share the places of their endings behind them."""

    def __init__(self, words: Words):
        super().__init__(zip(words.counts, range(len(words.counts))))
        self.listed = len(self)
        classes = np.array([tail_class(w) for w in words.counts], np.int32).reshape(-1)
        self.ids = np.concatenate([classes, np.arange(TAIL_CLASSES)]).astype(np.int32) + words.n_head
        heads = [(self[w], k) for w, k in words.head.items()]
        at = np.array([x[0] for x in heads], np.int64)
        self.ids[at] = [x[1] for x in heads]
        share = np.log10(words.tail_tokens + SMOOTH * (words.tail_words + 1))
        #: log10 of a listed word's smoothed count
        self.logs = np.zeros(len(self.ids))
        self.logs[: self.listed] = np.log10(np.fromiter(words.counts.values(), float, self.listed) + SMOOTH)
        #: log10 of a listed word's share in its tail class; of any other the class's part alone
        self.shares = self.logs - share[np.maximum(self.ids - words.n_head, 0)]
        self.shares[at] = 0

    def __missing__(self, word: bytes) -> int:
        return self.listed + tail_class(word)

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.int32, len(tokens))

    def coded(self, slots: np.ndarray) -> np.ndarray:
        """Input ids; the last is the end."""
        out = np.zeros(len(slots) + 1, np.int32)
        self.ids.take(slots, out=out[:-1])
        return out


def _logits(rows: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Logits of ``rows``, whose values lie between -1 and 1, kept below _TOP where the weights could pass it."""
    out = rows @ w
    out += b
    if (np.abs(w).sum(0) + b).max() > _TOP:
        np.minimum(out, _TOP, out=out)
    return out


class Network:
    """One gated recurrent layer and the factored output; all weights are float32."""

    NAMES = ("x", "u", "class_w", "class_b", "word_w", "word_b")

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights
        self.hidden = weights["u"].shape[0]

    @classmethod
    def shapes(cls) -> dict[str, tuple[int, ...]]:
        head, ids, classes = HEAD_CLASSES * CLASS_WORDS, HEAD_CLASSES * CLASS_WORDS + TAIL_CLASSES + 1, HEAD_CLASSES + TAIL_CLASSES
        return {
            "x": (ids, 3 * HIDDEN),
            "u": (HIDDEN, 3 * HIDDEN),
            "class_w": (HIDDEN, classes),
            "class_b": (classes,),
            "word_w": (head, HIDDEN),
            "word_b": (head,),
        }

    @classmethod
    def fresh(cls, words: Words) -> Network:
        """Small random weights; the biases are the training counts' logarithms."""
        dice = np.random.default_rng(SEED)
        w = {k: (dice.normal(size=s) * 0.1).astype(np.float32) for k, s in cls.shapes().items()}
        head = np.full(words.n_head, 1e-3)
        head[0] += words.ends
        for word, k in words.head.items():
            head[k] += words.counts[word]
        tail = words.tail_tokens + SMOOTH * (words.tail_words + 1)
        classes = np.concatenate([head.reshape(HEAD_CLASSES, -1).sum(1), tail])
        w["class_b"] = np.log(classes / classes.sum()).astype(np.float32)
        w["word_b"] = np.log(head).astype(np.float32)
        return cls(w)

    def blob(self) -> np.ndarray:
        return np.concatenate([self.w[k].ravel() for k in self.NAMES])

    @classmethod
    def of(cls, blob: np.ndarray) -> Network:
        out, at = {}, 0
        for name in cls.NAMES:
            shape = cls.shapes()[name]
            size = math.prod(shape)
            out[name] = np.array(blob[at : at + size], np.float32).reshape(shape)
            at += size
        return cls(out)

    def step(self, ids: np.ndarray, state: np.ndarray):
        """The gates and the next state."""
        n = self.hidden
        x, u = self.w["x"].take(ids, 0), state @ self.w["u"]
        gates = x[:, : 2 * n] + u[:, : 2 * n]
        np.exp(np.negative(gates, out=gates), out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        z, r, un = gates[:, :n], gates[:, n:], u[:, 2 * n :]
        new = r * un
        new += x[:, 2 * n :]
        new *= -2  # tanh, by the faster exponential
        np.exp(new, out=new)
        new += 1
        np.divide(2, new, out=new)
        new -= 1
        after = state - new
        after *= z
        after += new
        return z, r, new, un, after

    @staticmethod
    def classes(targets: np.ndarray) -> np.ndarray:
        head = targets < HEAD_CLASSES * CLASS_WORDS
        return np.where(head, targets // CLASS_WORDS, targets - HEAD_CLASSES * CLASS_WORDS + HEAD_CLASSES).astype(np.int16)

    def _of_classes(self, classes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """The rows with frequent words, sorted by class, and (class, start, stop) there."""
        order = np.argsort(classes, kind="stable")
        ends = np.searchsorted(classes[order], np.arange(HEAD_CLASSES + 1)).tolist()
        return order[: ends[-1]], [(c, ends[c], ends[c + 1]) for c in range(HEAD_CLASSES) if ends[c] < ends[c + 1]]

    def log_chance(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log of each target's chance: its class, and its word inside a class of frequent words."""
        w, classes = self.w, self.classes(targets)
        out = np.empty(len(targets), states.dtype)
        for at in range(0, len(targets), _ROWS):
            logits = _logits(states[at : at + _ROWS], w["class_w"], w["class_b"])
            out[at : at + _ROWS] = logits[np.arange(len(logits)), classes[at : at + _ROWS]]
            np.exp(logits, out=logits)
            out[at : at + _ROWS] -= np.log(logits @ np.ones(logits.shape[1], logits.dtype))
        order, spans = self._of_classes(classes)
        own, goals = states.take(order, 0), targets[order] - classes[order] * CLASS_WORDS
        ones, inside = np.ones(CLASS_WORDS, own.dtype), np.empty(len(order), out.dtype)
        for c, low, high in spans:
            span = slice(c * CLASS_WORDS, (c + 1) * CLASS_WORDS)
            inner = _logits(own[low:high], w["word_w"][span].T, w["word_b"][span])
            picked = inner[np.arange(high - low), goals[low:high]]
            np.exp(inner, out=inner)
            inside[low:high] = picked - np.log(inner @ ones)
        out[order] += inside
        return out

    def gradient(self, ids: np.ndarray, targets: np.ndarray, state: np.ndarray, start: int):
        """Of the mean loss over one window of (steps, lanes); also the state after it."""
        steps, lanes, n, w = *ids.shape, self.hidden, self.w
        kind = w["u"].dtype
        before, states, new, un = (np.empty((steps, lanes, n), kind) for _ in range(4))
        z, r = np.empty((2, steps, lanes, n), kind)
        begins = ids == start
        some = begins.any(1)
        for t in range(steps):
            if some[t]:
                state = np.where(begins[t][:, None], kind.type(0), state)
            before[t] = state
            z[t], r[t], new[t], un[t], state = self.step(ids[t], state)
            states[t] = state
        flat, goal = states.reshape(-1, n), targets.ravel()
        scale = kind.type(1 / len(goal))
        classes = self.classes(goal)
        every = np.ones(len(goal), kind)
        g = {k: np.zeros_like(w[k]) for k in ("class_w", "class_b", "word_w", "word_b")}
        back = np.empty((len(goal), n), kind)
        for at in range(0, len(goal), _ROWS):  # what fits a core's memory
            some_rows = flat[at : at + _ROWS]
            p = _logits(some_rows, w["class_w"], w["class_b"])
            np.exp(p, out=p)
            p *= (scale / (p @ np.ones(p.shape[1], kind)))[:, None]
            p[np.arange(len(p)), classes[at : at + _ROWS]] -= scale
            g["class_w"] += some_rows.T @ p
            g["class_b"] += every[: len(p)] @ p
            np.matmul(p, w["class_w"].T, out=back[at : at + _ROWS])
        order, spans = self._of_classes(classes)
        own, goals = flat.take(order, 0), goal[order] - classes[order] * CLASS_WORDS
        ones, inside = np.ones(CLASS_WORDS, kind), np.empty((len(order), n), kind)
        for c, low, high in spans:
            span = slice(c * CLASS_WORDS, (c + 1) * CLASS_WORDS)
            q = _logits(own[low:high], w["word_w"][span].T, w["word_b"][span])
            np.exp(q, out=q)
            q *= (scale / (q @ ones))[:, None]
            q[np.arange(high - low), goals[low:high]] -= scale
            g["word_w"][span] = q.T @ own[low:high]
            g["word_b"][span] = every[: high - low] @ q
            inside[low:high] = q @ w["word_w"][span]
        back[order] += inside
        back = back.reshape(steps, lanes, n)
        # what does not depend on later steps, for all steps at once
        rest = 1 - z
        to_z = (before - new) * z * rest
        rest *= 1 - new * new
        to_r = un * r * (1 - r)
        inner = np.empty((steps, lanes, 4 * n), kind)  # of the new state's part of u, of z, of r, of the new state
        dh, u = np.zeros((lanes, n), kind), np.concatenate([w["u"][:, 2 * n :], w["u"][:, : 2 * n]], axis=1).T.copy()
        for t in range(steps - 1, -1, -1):
            dh += back[t]
            here = inner[t]
            dn = dh * rest[t]
            np.multiply(dn, r[t], out=here[:, :n])
            np.multiply(dh, to_z[t], out=here[:, n : 2 * n])
            np.multiply(dn, to_r[t], out=here[:, 2 * n : 3 * n])
            here[:, 3 * n :] = dn
            dh *= z[t]
            dh += here[:, : 3 * n] @ u
            if some[t]:
                dh[begins[t]] = 0
        inner = inner.reshape(-1, 4 * n)
        g["u"] = np.roll(before.reshape(-1, n).T @ inner[:, : 3 * n], -n, axis=1)
        flat_ids = ids.ravel()
        order = np.argsort(flat_ids.astype(np.int16), kind="stable")  # a few hundred ids
        firsts = np.flatnonzero(np.r_[True, np.diff(flat_ids[order]) != 0])
        rows = flat_ids[order][firsts]
        return g, (rows, np.add.reduceat(inner[:, n:][order], firsts)), state


class Trainer:
    """AdaGrad over windows of a token stream that is laid in lanes."""

    def __init__(self, network: Network, start: int, rate: float = RATE):
        self.network, self.start, self.rate = network, start, rate
        self.grown = {k: np.full_like(v, 1e-6) for k, v in network.w.items()}
        self.tokens = 0

    def fit(self, documents: Iterable[np.ndarray], buffer: int = LANES * 8 * STEPS) -> None:
        """A stream of start, tokens, end ...; where a document begins the target is its first token.

        What does not fill the lanes of a buffer leads the next one; at the end it is laid in fewer lanes.
        """
        waiting, size, most = [], 0, 1
        for ids in documents:
            waiting.append((np.concatenate([[self.start], ids[:-1]]).astype(np.int32), ids))
            size += len(ids)
            if size >= buffer:
                most = max(most, self._lanes(size))
                waiting = [self._run(waiting)]
                size = len(waiting[0][0])
        while size:
            lanes = self._lanes(size)
            most = max(most, lanes)
            waiting = [self._run(waiting, lanes / most)]  # a token counts as in a window of all lanes
            size = len(waiting[0][0])

    @staticmethod
    def _lanes(size: int) -> int:
        return max(1, min(LANES, size // STEPS))

    def _run(self, stream: list[tuple[np.ndarray, np.ndarray]], weight: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """Train on the stream's inputs and targets, and return what is left over; gradients count ``weight``."""
        inputs, goals = map(np.concatenate, zip(*stream))
        lanes = self._lanes(len(inputs))
        length = len(inputs) // lanes
        used, weight = lanes * length, np.float32(weight)
        self.tokens += used
        ids, targets = (a[:used].reshape(lanes, length).T.copy() for a in (inputs, goals))
        state = np.zeros((lanes, self.network.hidden), np.float32)
        for t in range(0, length, STEPS):
            g, (rows, x), state = self.network.gradient(ids[t : t + STEPS], targets[t : t + STEPS], state, self.start)
            for name, value in g.items():
                value = value * weight
                self.grown[name] += value * value
                self.network.w[name] -= self.rate * value / np.sqrt(self.grown[name])
            x = x * weight
            self.grown["x"][rows] += x * x
            self.network.w["x"][rows] -= self.rate * x / np.sqrt(self.grown["x"][rows])
        return inputs[used:], goals[used:]


def score_documents(network: Network, documents: list[np.ndarray], start: int) -> np.ndarray:
    """Natural log chance of each whole document, ids with the end last.

    Documents are laid one after the other in lanes, the longest first; a lane's state is cleared where a document begins.
    """
    lanes = max(1, min(256, len(documents)))
    loads = [(0, k) for k in range(lanes)]
    held: list[list[int]] = [[] for _ in range(lanes)]
    for i in sorted(range(len(documents)), key=lambda i: -len(documents[i])):
        load, k = heapq.heappop(loads)
        held[k].append(i)
        heapq.heappush(loads, (load + len(documents[i]), k))
    held.sort(key=lambda own: -sum(len(documents[i]) for i in own))
    held = [own for own in held if own]
    order = [i for own in held for i in own]
    sizes = np.array([len(documents[i]) for i in order], np.int64)
    goals = np.concatenate([documents[i] for i in order]) if order else np.empty(0, np.int32)
    owners = np.repeat(order, sizes)
    inputs = np.empty(len(goals), np.int32)
    inputs[1:] = goals[:-1]
    inputs[np.cumsum(sizes) - sizes] = start
    lengths = np.array([sum(len(documents[i]) for i in own) for own in held], np.int64)
    firsts = np.cumsum(lengths) - lengths
    out = np.zeros(len(documents))
    state = np.zeros((len(held), network.hidden), np.float32)
    block = 64
    for t in range(0, int(lengths.max(initial=0)), block):
        active = int((lengths > t).sum())  # the longest lanes come first
        steps = min(block, int(lengths[0]) - t)
        at = np.arange(t, t + steps)[:, None]
        there = at < lengths[:active]
        places = np.where(there, firsts[:active] + at, 0)
        ids = np.where(there, inputs[places], start)
        states = np.empty((steps, active, network.hidden), np.float32)
        state = state[:active]
        begins = ids == start
        some = begins.any(1)
        for s in range(steps):
            if some[s]:
                state = np.where(begins[s][:, None], np.float32(0), state)
            states[s] = state = network.step(ids[s], state)[-1]
        chance = network.log_chance(states[there], goals[places[there]])
        out += np.bincount(owners[places[there]], chance, len(documents))
    return out


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def made() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"]
        )
        counts.clear()
        return out

    for batch in slices(batches, 512):
        for text in utf8(batch.column("text")):
            counts.update((text or b"").lower().split())
        if len(counts) >= _FLUSH:
            yield made()
    yield made()


def _encode(shared):
    """Per document its ids and its sums over listed words; words that no task lists follow as rows of their own."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Words = shared.value
        slots, end_log, known_end = words.slots, math.log10(words.ends + SMOOTH), int(words.ends > 0)
        for batch in slices(batches, 256):
            rows, found, rare = batch.column("row").to_pylist(), [], []
            for row, text in zip(rows, utf8(batch.column("text"))):
                tokens = (text or b"").lower().split()
                places = slots.of(tokens)
                others = np.flatnonzero(places >= slots.listed)
                rare.extend((row, word, c) for word, c in Counter(tokens[i] for i in others.tolist()).items())
                # the share of listed words of tail classes, of other words the class's part alone
                tail, listed = float(slots.shares.take(places).sum()), float(slots.logs.take(places).sum())
                ids = slots.coded(places).astype("<i2").tobytes()
                found.append((len(tokens) + 1, len(tokens) - len(others) + known_end, end_log + listed, tail, ids))
            docs, more = len(found), len(rare)
            made = [pa.concat_arrays([batch.column("row"), pa.array([x[0] for x in rare], pa.int64())])]
            made.append(pa.concat_arrays([batch.column("trains"), pa.nulls(more, pa.bool_())]))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
            made += [pa.concat_arrays([pa.array([x[k] for x in found], kind), pa.nulls(more, kind)]) for k, kind in enumerate(kinds)]
            for k, kind in ((1, pa.binary()), (2, pa.int64())):
                made.append(pa.concat_arrays([pa.nulls(docs, kind), pa.array([x[k] for x in rare], kind)]))
            yield pa.RecordBatch.from_arrays(made, names=["row", "trains", "n", "known", "listed", "tail", "ids", "word", "c"])

    return run


def _documents(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in slices(batches, 256):
        for ids in utf8(batch.column("ids")):
            yield np.frombuffer(ids, "<i2").astype(np.int32)


_PARTS = 64


def _train(start: int, blob):
    """Weights of this task's model, in parts that are averaged apart from each other."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(Network.of(np.frombuffer(blob.value, np.float32)), start)
        trainer.fit(_documents(batches))
        if trainer.tokens:
            pieces = np.array_split(trainer.network.blob(), _PARTS)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(_PARTS), pa.int32()),
                    pa.array([TaskContext.get().partitionId()] * _PARTS, pa.int32()),
                    pa.array([trainer.tokens] * _PARTS, pa.int64()),
                    pa.array([p.tobytes() for p in pieces], pa.binary()),
                ],
                names=["part", "task", "tokens", "weights"],
            )

    return run


def _mean(table: pa.Table) -> pa.Table:
    table = table.sort_by("task")  # the same sum on every run
    tokens = table.column("tokens").to_numpy().astype(float)
    total = None
    for n, weights in zip(tokens, table.column("weights").to_pylist()):
        value = np.frombuffer(weights, np.float32) * (n / tokens.sum())
        total = value if total is None else total + value
    return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int32()), "weights": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def _score(start: int, blob):
    """The network's log10 chance of each document, with what its words of tail classes add."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network.of(np.frombuffer(blob.value, np.float32))
        waiting: list[pa.RecordBatch] = []
        documents: list[np.ndarray] = []
        size = 0

        def made() -> Iterator[pa.RecordBatch]:
            chances, at = score_documents(network, documents, start) / _LN10, 0
            for batch in waiting:
                score = chances[at : at + batch.num_rows] + batch.column("tail").to_numpy()
                at += batch.num_rows
                columns = [batch.column(c) for c in ("row", "n", "known", "listed")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], names=["row", "n", "known", "listed", "score"])
            waiting.clear()
            documents.clear()

        for batch in slices(batches, 256):
            documents.extend(_documents([batch]))
            waiting.append(batch.drop_columns(["ids"]))
            size += sum(map(len, documents[-batch.num_rows :])) if batch.num_rows else 0
            if size >= _SCORE_TOKENS:
                yield from made()
                size = 0
        yield from made()

    return run


def learn_words(training: DataFrame, listed: int = LISTED) -> tuple[Words, DataFrame]:
    """Counts over all training texts: what every task holds, and the whole table (word, c)."""
    counts = cut_lineage(training.mapInArrow(_count, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c")))
    ends = training.count()
    # how many words have each count: a short table; it gives the least count of a listed word
    least, room = None, listed
    for r in counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).toLocalIterator():
        if r.n > room:
            break
        least, room = r.c, room - r.n
    top = counts.where(F.col("c") >= least).toArrow() if least is not None else counts.limit(0).toArrow()
    known = dict(zip(top.column("word").to_pylist(), top.column("c").to_pylist()))
    known = dict(sorted(known.items(), key=lambda x: (-x[1], x[0])))
    head = {w: k for k, w in enumerate(list(known)[: HEAD_CLASSES * CLASS_WORDS - 1], start=1)}
    total, distinct = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    tail = F.crc32(F.expr("substring(word, -2, 2)")) % TAIL_CLASSES
    sums = counts.groupBy(tail.alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect()  # a row a class
    tokens, words = np.zeros(TAIL_CLASSES), np.zeros(TAIL_CLASSES)
    for r in sums:
        tokens[r.k], words[r.k] = r.c, r.n
    for w in head:
        tokens[tail_class(w)] -= known[w]
        words[tail_class(w)] -= 1
    return Words(known, head, ends, (total or 0) + ends, distinct + (ends > 0), tokens, words), counts


def score_texts(
    df: DataFrame,
    training,
    id_col: str = "doc_id",
    text_col: str = "text",
    listed: int = LISTED,
    warm_documents: int = WARM_DOCUMENTS,
) -> DataFrame:
    """Per row: row, doc, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10).

    ``training`` is a boolean expression; null counts as false. Null text counts as empty, whose only token is its end.
    Without a training row every token has the chance of an unseen one in the base, and the network stays as it starts. An
    empty table gives an empty result.
    """
    spark = df.sparkSession
    source = identified(
        settled(df),
        doc=F.col(id_col),
        trains=F.coalesce(training, F.lit(False)),
        text=F.col(text_col).cast("binary"),
    )
    words, counts = learn_words(source.where("trains").select("row", "text"), listed)
    shared = spark.sparkContext.broadcast(words)  # LISTED words at most
    network = Network.fresh(words)
    columns = "row bigint, trains boolean, n bigint, known bigint, listed double, tail double, ids binary, word binary, c bigint"
    encoded = stored(source.select("row", "trains", "text").mapInArrow(_encode(shared), columns), "ids")
    train = encoded.where("trains").select("row", "ids")
    # at most warm_documents texts, chosen by hash
    first = train.select("row").orderBy(F.xxhash64("row", F.lit(SEED)), "row").limit(warm_documents)
    sample = train.join(F.broadcast(first), "row").repartition(1).sortWithinPartitions("row")

    def fitted(frame: DataFrame, network: Network) -> Network:
        blob = spark.sparkContext.broadcast(network.blob().tobytes())
        pieces = frame.mapInArrow(_train(words.start, blob), "part int, task int, tokens bigint, weights binary")
        mean = pieces.groupBy("part").applyInArrow(_mean, "part int, weights binary").orderBy("part").collect()
        return Network.of(np.concatenate([np.frombuffer(r.weights, np.float32) for r in mean])) if mean else network

    network = fitted(train, fitted(sample, network))
    blob = spark.sparkContext.broadcast(network.blob().tobytes())
    documents = encoded.where("ids is not null").select("row", "n", "known", "listed", "tail", "ids")
    scored = cut_lineage(documents.mapInArrow(_score(words.start, blob), "row bigint, n bigint, known bigint, listed double, score double"))
    rare = encoded.where("word is not null").select("row", "word", "c")
    found = rare.join(counts.withColumnRenamed("c", "seen"), "word", "left")
    log = F.log10(F.coalesce("seen", F.lit(0)) + SMOOTH)
    extra = found.groupBy("row").agg(
        F.sum(F.col("c") * log).alias("rare_log"), F.sum(F.when(F.col("seen").isNotNull(), F.col("c"))).alias("rare_known")
    )
    under = math.log10(words.total + SMOOTH * (words.distinct + 1))
    joined = scored.join(extra, "row", "left")
    joined = joined.join(source.select("row", "doc", "trains"), "row")
    more = F.coalesce("rare_log", F.lit(0.0))
    return joined.select(
        "row",
        "doc",
        (~F.col("trains")).alias("held_out"),
        F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("bigint").alias("train_tokens"),
        (F.col("listed") + more - F.col("n") * F.lit(under)).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )


@query("op6_recurrent_lm")
def op6_recurrent_lm(spark, sf):
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    scored = score_texts(table(spark, sf, "documents"), rest != 0)
    return scored.drop("row").withColumnRenamed("doc", "doc_id")
