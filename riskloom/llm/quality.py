"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on every whole text. Expectation-maximisation over the counts of vote
patterns (three outcomes a labeller, so their number is bounded) estimates how often each labeller is right; rows of
a reference table, where one is given, are held at their label. The posterior labels of a bounded sample train
a logistic scorer over hashed features, which scores every document. Toxic language is a second target of the same kind.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain, islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import identified, keep_rows, query, settled, slices, table, utf8
from riskloom.session import cut_lineage

BUCKETS = 1 << 16
MAX_TRAIN = 8192  # rows the scorer is trained on: labelled rows first, then rows by hash
UNLABELLED_TRUST = 0.2  # weight of a row without a reference label, where others have one
SEED = 7
TARGETS = ("junk", "toxic")
INSULTS = frozenset(
    b"bastard clown crap cretin damn disgusting dumb fool garbage hateful idiot idiotic imbecile jerk loser "
    b"lunatic moron moronic nasty pathetic pervert pig retard scum scumbag shit sick slut stupid sucker trash "
    b"ugly vermin worthless".split()
)

_SYMBOLS = re.compile(rb"[^\w\s.,;:'\"()!?\x80-\xff-]")
_PUNCTUATION = b".,;:!?'\"()[]"
_PROSE = re.compile(rb"(?:[A-Za-z\x80-\xff][a-z\x80-\xff'-]*|\d+)$")
_LETTER = re.compile(rb"[A-Za-z0-9\x80-\xff]")
_RUNS = re.compile(rb"(.)\1+", re.DOTALL)
_SHAPES = bytes(
    48 if chr(c).isdigit() and c < 128 else 65 if 65 <= c <= 90 else 97 if c >= 128 or 97 <= c <= 122 else c for c in range(256)
)
_STRIP = b".,;:!?'\"()[]{}*#%$&|"


def _from(value: float, bad_from: float) -> int:
    """1 bad, 2 no vote. A labeller that looks for one fault has no opinion where it finds none."""
    return 1 if value >= bad_from else 2


def votes(text: bytes) -> tuple[list[int], list[int]]:
    """What the labellers of both targets say about a whole text: 0 good, 1 bad, 2 nothing."""
    words = text.split()
    n = len(words)
    if not n:
        return [1] + [2] * 7, [0, 2, 2, 2]
    counts = Counter(words)
    again = sum(map(eq, words, islice(words, 1, None)))
    plain = bare = caps = hits = 0
    for word, c in counts.items():
        core = word.strip(_PUNCTUATION)
        if _PROSE.match(core):
            plain += c
        elif core.isupper():
            caps += c * (len(core) > 1)
        elif not _LETTER.search(word):
            bare += c
        if core.lower() in INSULTS:
            hits += c
    lines = [x for x in text.split(b"\n") if x.strip()]
    junk = [
        1 if plain < 0.6 * n else 0 if plain >= 0.85 * n and again < 0.05 * n else 2,
        _from(again / n, 0.2),
        _from(len(_SYMBOLS.findall(text)) / n, 0.3),
        _from(bare / n, 0.2),
        _from(caps / n, 0.4),
        _from(text.count(b"!") / n, 0.4),
        _from(1 - len(counts) / n, 0.75 if n > 40 else 2),
        _from(1 - len(set(lines)) / len(lines), 0.5),
    ]
    toxic = [2 if hits else 0, 1 if hits else 2, _from(hits / n, 0.01), _from(hits, 2)]
    return junk, toxic


_N = tuple(map(len, votes(b"")))


def _vote_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 512):
        said = [votes(t or b"") for t in utf8(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                batch.column("doc"),
                *(pa.array(["".join(map(str, s[k])) for s in said], pa.string()) for k in range(2)),
            ],
            names=["row", "doc", *TARGETS],
        )


def label_model(patterns: Counter, labellers: int, rounds: int = 60) -> dict[tuple[str, int | None], float]:
    """Posterior of bad for every (votes, reference label or None); ``patterns`` counts them.

    Labellers err independently, each with its own accuracy over the votes it casts; a labeller that says nothing is
    no evidence. The first guess is bad where any labeller says so, since each knows one kind of bad text.
    """
    keys = list(patterns)
    if not keys:
        return {}
    weight = np.array([patterns[k] for k in keys], float)
    cast = np.array([[int(v) for v in k[0]] for k in keys]).reshape(len(keys), labellers)
    bad, good = (cast == 1).astype(float), (cast == 0).astype(float)
    held = np.array([np.nan if k[1] is None else k[1] for k in keys], float)
    open_ = np.isnan(held)
    post = np.where(bad.any(1), 0.99, 0.01)
    for _ in range(rounds):
        post = np.where(open_, post, held)
        right = (weight * post) @ bad + (weight * (1 - post)) @ good
        accuracy = np.clip((right + 9) / (weight @ (bad + good) + 10), 0.5, 0.995)
        prior = np.clip((weight @ post + 1) / (weight.sum() + 2), 0.001, 0.999)
        odds = np.log(prior / (1 - prior)) + (bad - good) @ np.log(accuracy / (1 - accuracy))
        new = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        moved = np.abs(new - post)[open_].max(initial=0)
        post = new
        if moved < 1e-6:
            break
    post = np.where(open_, post, held)
    return dict(zip(keys, post.tolist()))


class Hasher:
    """Hashed features of a text's distinct words (word, beginnings, shape), and its share of repeats in a row.

    A feature's value is the number of distinct words that have it over the root of their number, so a text's score is a
    sum over its distinct words and a word's part of it is worked out once.
    """

    AGAIN, BIAS = (zlib.crc32(x) & (BUCKETS - 1) for x in (b"again", b"bias"))

    def __init__(self, weights: np.ndarray | None = None):
        self.weights = weights  # complex: one part a target
        self.known: dict[bytes, object] = {}

    @staticmethod
    def of(word: bytes) -> tuple[int, ...]:
        plain = word.strip(_STRIP).lower()
        shape = _RUNS.sub(rb"\1", word.translate(_SHAPES))
        return (
            zlib.crc32(plain) % BUCKETS,
            zlib.crc32(plain[:6], 5) % BUCKETS,
            zlib.crc32(plain[:7], 7) % BUCKETS,
            zlib.crc32(shape[:8], 1) % BUCKETS,
        )

    def _look(self, words: set[bytes], make) -> list:
        known = self.known
        new = [w for w in words if w not in known]
        if new:
            if len(known) + len(new) > 200_000:
                known.clear()
                new = list(words)
            known.update(zip(new, make(new)))
        return [known[w] for w in words]

    def _buckets(self, words: list[bytes]) -> list[tuple[int, ...]]:
        return [self.of(w) for w in words]

    def _parts(self, words: list[bytes]) -> list[complex]:
        """The scores of both targets, one as the imaginary part."""
        return self.weights[np.array([self.of(w) for w in words])].sum(1).tolist()

    @staticmethod
    def again(words: list[bytes]) -> float:
        return 4 * sum(map(eq, words, islice(words, 1, None))) / max(1, len(words))

    def features(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        words = text.split()
        distinct = set(words)
        at, count = np.unique(
            np.fromiter(chain.from_iterable(self._look(distinct, self._buckets)), np.int32), return_counts=True
        )
        value = count / np.sqrt(max(1, len(distinct)))
        return (
            np.concatenate([at, [self.AGAIN, self.BIAS]]).astype(np.int32),
            np.concatenate([value, [self.again(words), 1.0]]).astype(np.float32),
        )

    def score(self, text: bytes) -> complex:
        words = text.split()
        distinct = set(words)
        total = self.weights[self.BIAS] + self.weights[self.AGAIN] * self.again(words)
        return total + sum(self._look(distinct, self._parts)) / max(1, len(distinct)) ** 0.5


def _feature_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for batch in slices(batches, 256):
        made = [hasher.features(t or b"") for t in utf8(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                *(batch.column(t) for t in (*TARGETS, "trust")),
                pa.array([a.tobytes() for a, _ in made], pa.binary()),
                pa.array([v.tobytes() for _, v in made], pa.binary()),
            ],
            names=["row", *TARGETS, "trust", "at", "value"],
        )


def fit_scorer(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, trust: np.ndarray, epochs: int = 20, rate: float = 0.5
) -> np.ndarray:
    """Weights of a logistic scorer for soft labels, by AdaGrad over seeded batches; ``trust`` weighs the rows."""
    weights, grown = np.zeros(BUCKETS), np.full(BUCKETS, 1e-3)
    dice = np.random.default_rng(SEED)
    for _ in range(epochs):
        order = dice.permutation(len(rows))
        for k in range(0, len(order), 32):
            part = order[k : k + 32]
            at = np.concatenate([rows[i][0] for i in part])
            value = np.concatenate([rows[i][1] for i in part])
            owner = np.repeat(np.arange(len(part)), [len(rows[i][0]) for i in part])
            margin = np.bincount(owner, weights[at] * value, len(part))
            error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[part]
            error *= trust[part]
            touched, place = np.unique(at, return_inverse=True)
            gradient = np.bincount(place, error[owner] * value, len(touched)) / len(part) + 1e-6 * weights[touched]
            grown[touched] += gradient**2
            weights[touched] -= rate * gradient / np.sqrt(grown[touched])
    return weights.astype(np.float32)


def _train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task over the bounded sample."""
    rows, labels, order = [], [], []
    for batch in batches:
        for row, *known, at, value in zip(*(batch.column(c).to_pylist() for c in ("row", *TARGETS, "trust", "at", "value"))):
            rows.append((np.frombuffer(at, np.int32), np.frombuffer(value, np.float32)))
            labels.append(known)
            order.append(row)
    by_row = np.argsort(np.array(order, np.int64), kind="stable")
    rows, labels = [rows[i] for i in by_row], np.array(labels, float).reshape(-1, len(TARGETS) + 1)[by_row]
    fitted = [fit_scorer(rows, labels[:, k], labels[:, -1]).tobytes() if rows else np.zeros(BUCKETS, np.float32).tobytes() for k in range(len(TARGETS))]
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(len(TARGETS)), pa.int32()), pa.array(fitted, pa.binary())], names=["target", "weights"]
    )


def _scorer(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        junk, toxic = (np.frombuffer(w, np.float32).astype(float) for w in shared.value)
        hasher = Hasher(junk + 1j * toxic)
        for batch in slices(batches, 256):
            both = np.fromiter((hasher.score(t or b"") for t in utf8(batch.column("text"))), complex, batch.num_rows)
            scores = np.stack([both.real, both.imag], axis=1)
            chance = 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc"), *(pa.array(chance[:, k]) for k in range(len(TARGETS)))],
                names=["row", "doc", *TARGETS],
            )

    return run


def classify(
    df: DataFrame,
    labels: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_train: int = MAX_TRAIN,
    threshold: float = 0.5,
) -> DataFrame:
    """Per row: row, doc, junk, toxic (the scorer's chances), accepted (both below ``threshold``).

    ``labels(doc_id, quality, toxic)``, where given, holds some rows at their label while the labellers are judged;
    the smallest label of a repeated id counts. Null text counts as empty, and an empty text is judged
    like any other. Only training is bounded: votes, their model and the scores cover every row. An empty table
    gives an empty result.
    """
    spark = df.sparkSession
    source = identified(settled(df), doc=F.col(id_col).cast("bigint"), text=F.col(text_col).cast("binary"))
    said = source.mapInArrow(_vote_rows, "row bigint, doc bigint, junk string, toxic string")
    if labels is not None:
        known = labels.groupBy(F.col("doc_id").alias("doc")).agg(
            (1 - F.min("quality")).cast("int").alias("known_junk"), F.min("toxic").cast("int").alias("known_toxic")
        )
        said = said.join(known, "doc", "left")
    else:
        said = said.withColumns({f"known_{t}": F.lit(None).cast("int") for t in TARGETS})
    said = cut_lineage(said)
    posterior = []
    for k, target in enumerate(TARGETS):
        # at most 3 ** labellers patterns, three times
        counted = said.groupBy(target, f"known_{target}").count().collect()
        model = label_model(Counter({(r[0], r[1]): r[2] for r in counted}), _N[k])
        rows = [(p, label, chance) for (p, label), chance in model.items()]
        posterior.append(spark.createDataFrame(rows, f"{target} string, known_{target} int, post_{target} double"))
    chosen = (
        said.withColumn("order", F.xxhash64("row", F.lit(SEED)))
        .orderBy(F.col("known_junk").isNull(), "order", "row")
        .limit(max_train)
    )
    for target, post in zip(TARGETS, posterior):
        same = (chosen[target] == post[target]) & chosen[f"known_{target}"].eqNullSafe(post[f"known_{target}"])
        chosen = chosen.join(F.broadcast(post), same).select(chosen["*"], post[f"post_{target}"])
    trust = F.when(F.col("known_junk").isNull(), UNLABELLED_TRUST).otherwise(1.0).alias("trust")
    chosen = cut_lineage(chosen.select("row", *(F.col(f"post_{t}").alias(t) for t in TARGETS), trust))
    sample = source.join(F.broadcast(chosen), "row")  # max_train rows at most
    features = sample.mapInArrow(_feature_rows, "row bigint, junk double, toxic double, trust double, at binary, value binary")
    fitted = features.repartition(1).mapInArrow(_train, "target int, weights binary").orderBy("target").collect()
    shared = spark.sparkContext.broadcast([bytes(r.weights) for r in fitted])
    scored = source.mapInArrow(_scorer(shared), "row bigint, doc bigint, junk double, toxic double")
    return scored.withColumn("accepted", (F.col("junk") < threshold) & (F.col("toxic") < threshold))


def accepted(df: DataFrame, labels: DataFrame | None = None, **options) -> DataFrame:
    """The rows of ``df`` that the classifier accepts, with all their columns."""
    df = settled(df)
    return keep_rows(df, classify(df, labels, **options).where("accepted"))


@query("op3_weak_label_quality")
def op3_weak_label_quality(spark, sf):
    judged = classify(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return judged.select(
        F.col("doc").alias("doc_id"),
        F.round(1 - F.col("junk"), 6).alias("quality"),
        F.round("toxic", 6).alias("toxicity"),
        "accepted",
    )
