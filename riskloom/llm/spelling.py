"""Spelling variants over a frequency-vector trie.

A word's vector holds how many of its letters fall into each of a few letter groups. One inserted letter raises one
count by one, one deleted letter lowers one, a replaced letter does both or, inside a group, neither. Words are
arranged as a trie by successive counts; a word is looked up by a depth-first search that may spend a deficit of one
and a surplus of one, and the leaf words it reaches are verified letter by letter.

Every near pair is looked for once: from the word whose vector is larger at the first count that differs, so the
search spends the deficit first and the surplus after it. The counts of the first groups are the trie's upper levels
and name its cells; Spark deals the words of a cell, and the searches that enter it, to tasks. A cell of many words or many
searches is split in both ways, so that no task holds more than a part of it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Rows, query, slices, table, utf8
from riskloom.session import cut_lineage

#: Letters of a group have code points that are equal modulo this.
GROUPS = 12
#: Counts that name a cell.
TOP = 5
MIN_LENGTH = 6
MIN_COUNT = 5
#: A form occurs this many times as often as its variant.
RATIO = 5
#: Of words whose hash this divides, one letter goes.
DROP_EVERY = 199
#: Words of a cell that one task arranges, and searches it makes among them.
LEAF_WORDS = 8192
SEARCHES = 8192
#: Letters up to which words are compared by vector arithmetic.
WIDE = 64
_BLOCK = 1 << 14  # vectors compared at once in a leaf block

_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_PAIRS = pa.schema([("a", pa.string()), ("a_n", pa.int64()), ("b", pa.string()), ("b_n", pa.int64())])


def altered(run: str, doc: str, every: int = DROP_EVERY) -> str:
    """``run`` without one letter where ``every`` divides the hash of document and run."""
    h = zlib.crc32(f"{doc}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _words(every: int, min_length: int):
    pattern = r"[a-zÀ-ÿ]+"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = re.compile(pattern)
        total: Counter = Counter()
        size = 0

        def hand_out():
            out = Rows(_COUNTS)
            for word, n in total.items():
                if out.add((word, n), len(word)):
                    yield out.batch()
            yield out.batch()
            total.clear()

        for batch in slices(batches, 256):
            for doc, text in zip(batch.column("doc").to_pylist(), utf8(batch.column("text"))):
                if not text:
                    continue
                start = zlib.crc32(f"{doc}:".encode())
                runs = Counter(letters.findall(text.lower().decode(errors="replace")))  # lower() of bytes: A to Z only
                for word, n in runs.items():
                    if len(word) < min_length:
                        continue  # no shorter after a deletion
                    h = zlib.crc32(word.encode(), start)
                    if not h % every:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < min_length:
                            continue
                    if word not in total:
                        size += 64 + len(word)
                    total[word] += n
                if size > 32 << 20:
                    yield from hand_out()
                    size = 0
        yield from hand_out()

    return run


def word_counts(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    every: int = DROP_EVERY,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """(word, n): the frequent words of all texts, counted in every task before the shuffle.

    Null texts have no words; a null id is hashed as an empty one; repeated rows count again.
    """
    source = df.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc"), F.col(text_col).cast("binary").alias("text")
    )
    counts = source.mapInArrow(_words(every, min_length), "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def vectors(words: list[str], groups: int = GROUPS) -> np.ndarray:
    """Letter-group counts, a row for each word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    at = np.repeat(np.arange(len(words)), lengths) * groups + points % groups
    return np.bincount(at, minlength=len(words) * groups).reshape(len(words), groups).astype(np.int32)


def near(a: str, b: str) -> bool:
    """Exactly one letter inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


class Trie:
    """Words sorted by vector: a node is a run of rows that agree in the first counts."""

    def __init__(self, words: list[str], groups: int = GROUPS):
        counts = vectors(words, groups)
        order = np.lexsort(counts.T[::-1])
        self.counts = counts[order]
        self.rows = order

    def search(self, wanted: np.ndarray, spent: np.ndarray, level: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(searches, rows, spent) that agree within the budget, for ``wanted`` vectors of which ``level`` counts are compared.

        ``spent``: 0 nothing, 1 the deficit, 2 deficit and surplus. All searches that reach a node go on together.
        """
        stack = [(0, len(self.counts), level, np.arange(len(wanted)), spent)]
        while stack:
            low, high, level, who, spent = stack.pop()
            if level == wanted.shape[1] or (high - low) * len(who) <= _BLOCK:
                step = max(1, _BLOCK // max(1, high - low))
                for at in range(0, len(who), step):
                    yield self._leaves(low, high, level, who[at : at + step], spent[at : at + step], wanted)
                continue
            column = self.counts[low:high, level]
            starts = np.flatnonzero(np.r_[True, column[1:] != column[:-1]])
            for first, last in zip(starts, [*starts[1:], high - low]):
                off = column[first] - wanted[who, level]
                go = (off == 0) | ((off == -1) & (spent == 0)) | ((off == 1) & (spent == 1))
                if go.any():
                    stack.append((low + first, low + last, level + 1, who[go], spent[go] + (off[go] != 0)))

    def _leaves(self, low, high, level, who, spent, wanted):
        """The rest of the path at once, for few words or few searches: the same steps without nodes."""
        state = np.broadcast_to(spent[:, None], (len(who), high - low)).copy()
        alive = np.ones_like(state, bool)
        for k in range(level, wanted.shape[1]):
            off = self.counts[None, low:high, k] - wanted[who, k][:, None]
            alive &= (off == 0) | ((off == -1) & (state == 0)) | ((off == 1) & (state == 1))
            state += off != 0
        a, b = np.nonzero(alive)
        return who[a], self.rows[low + b], state[a, b]


class Letters:
    """Words as rows of code points, aligned at either end; longer words than ``WIDE`` are compared as text."""

    def __init__(self, words: list[str]):
        self.words = words
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        width = max(3, min(WIDE, int(self.lengths.max(initial=0))))
        self.fits = self.lengths <= width
        held = np.where(self.fits, self.lengths, 0)
        points = np.frombuffer("".join(w for w, fit in zip(words, self.fits) if fit).encode("utf-32-le"), np.uint32)
        row = np.repeat(np.arange(len(words)), held)
        at = np.arange(len(points)) - np.repeat(np.cumsum(held) - held, held)
        self.left = np.zeros((len(words), width), np.uint32)
        self.left[row, at] = points
        self.right = np.zeros((len(words), width), np.uint32)
        self.right[row, width - held[row] + at] = points


def near_rows(a: Letters, who: np.ndarray, b: Letters, rows: np.ndarray) -> np.ndarray:
    """``near`` of many pairs: one edit leaves the first or the last three letters as they are, those go on."""
    width = min(a.left.shape[1], b.left.shape[1])
    out = np.zeros(len(who), bool)
    long = ~(a.fits[who] & b.fits[rows])
    for i in np.flatnonzero(long):
        out[i] = near(a.words[who[i]], b.words[rows[i]])
    same = (a.left[who, :3] == b.left[rows, :3]).all(1) | (a.right[who, -3:] == b.right[rows, -3:]).all(1)
    go = np.flatnonzero(same & ~long)
    who, rows = who[go], rows[go]
    la, lb = a.lengths[who], b.lengths[rows]
    short = np.minimum(la, lb)
    fore = a.left[who, :width] == b.left[rows, :width]  # of two lengths one apart, the longer's last letter may lie beyond
    hind = a.right[who, -width:] == b.right[rows, -width:]
    head = np.minimum(np.logical_and.accumulate(fore, axis=1).sum(1), short)
    tail = np.minimum(np.logical_and.accumulate(hind[:, ::-1], axis=1).sum(1), short)
    out[go] = np.where(la == lb, head + tail == la - 1, (np.abs(la - lb) == 1) & (head + tail >= short))
    return out


def _cell(counts: np.ndarray) -> list[str]:
    return [",".join(map(str, row)) for row in counts.tolist()]


def _entries(groups: int, top: int):
    """Of every word the cell it lies in and the cells its search enters, with the budget spent on the way."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            words = batch.column("word").to_pylist()
            if not words:
                continue
            head = vectors(words, groups)[:, :top]
            every = np.arange(len(words))
            found = [(head, every, -1), (head, every, 0)]  # a leaf; a search with nothing spent
            for i in range(top):
                rows = np.flatnonzero(head[:, i] > 0)
                less = head[rows].copy()
                less[:, i] -= 1
                found.append((less, rows, 1))
                for j in range(i + 1, top):
                    both = less.copy()
                    both[:, j] += 1
                    found.append((both, rows, 2))
            for cells, rows, spent in found:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_cell(cells), pa.string()),
                        pa.array(np.full(len(rows), spent, np.int32)),
                        batch.column("word").take(pa.array(rows)),
                        batch.column("n").take(pa.array(rows)),
                    ],
                    names=["cell", "spent", "word", "n"],
                )

    return run


def _look_up(groups: int, top: int):
    """Of sorted rows (cell, s, r, spent, word, n): arrange the words of a part, then search it batch by batch."""

    def pairs(trie: Trie, leaves: Letters, counts: list[int], asked: list[tuple]) -> Iterator[tuple]:
        names = Letters([w for w, _, _ in asked])
        spent = np.array([s for _, _, s in asked], np.int32)
        for who, rows, state in trie.search(vectors(names.words, groups), spent, top):
            met = near_rows(names, who, leaves, rows)
            for q, row, s in zip(who[met].tolist(), rows[met].tolist(), state[met].tolist()):
                a, b = names.words[q], leaves.words[row]
                if s or b < a:  # two words of one vector meet twice
                    yield a, asked[q][1], b, counts[row]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(_PAIRS)
        key, words, counts, trie, leaves, asked = None, [], [], None, None, []

        def flush():
            nonlocal trie, leaves
            if asked and words:
                if trie is None:
                    trie, leaves = Trie(words, groups), Letters(words)
                for row in pairs(trie, leaves, counts, asked):
                    if out.add(row, len(row[0]) + len(row[2])):
                        yield out.batch()
            asked.clear()

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("cell", "s", "r", "spent", "word", "n"))
            for cell, s, r, spent, word, n in zip(*columns):
                if (cell, s, r) != key:
                    yield from flush()
                    key, words, counts, trie = (cell, s, r), [], [], None
                if spent < 0:
                    words.append(word)
                    counts.append(n)
                else:
                    asked.append((word, n, spent))
                    if len(asked) >= 4096:
                        yield from flush()
        yield from flush()
        yield out.batch()

    return run


def near_pairs(
    words: DataFrame, groups: int = GROUPS, top: int = TOP, leaf_words: int = LEAF_WORDS, searches: int = SEARCHES
) -> DataFrame:
    """(a, a_n, b, b_n): every unordered pair of near words of ``words(word, n)`` once; words are distinct, not null
    and of three letters or more."""
    entries = words.mapInArrow(_entries(groups, top), "cell string, spent int, word string, n bigint")
    entries = cut_lineage(entries)
    sizes = entries.groupBy("cell").agg(
        F.ceil(F.sum(F.expr("cast(spent < 0 as int)")) / leaf_words).alias("leaf_parts"),
        F.ceil(F.sum(F.expr("cast(spent >= 0 as int)")) / searches).alias("parts"),
    )
    sizes = sizes.where("leaf_parts > 0")  # a cell without words answers no search
    own = F.pmod(F.xxhash64("word"), F.when(F.col("spent") < 0, F.col("leaf_parts")).otherwise(F.col("parts")))
    others = F.when(F.col("spent") < 0, F.col("parts")).otherwise(F.col("leaf_parts"))
    dealt = (
        entries.join(sizes, "cell")
        .select("cell", "spent", "word", "n", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("bigint"), others - 1)).alias("other"))
        .select(
            "cell",
            F.when(F.col("spent") < 0, F.col("own")).otherwise(F.col("other")).alias("s"),
            F.when(F.col("spent") < 0, F.col("other")).otherwise(F.col("own")).alias("r"),
            "spent",
            "word",
            "n",
        )
    )
    parts = dealt.repartition("cell", "s", "r").sortWithinPartitions("cell", "s", "r", "spent")
    return parts.mapInArrow(_look_up(groups, top), "a string, a_n bigint, b string, b_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms(word, form)`` without cycles: every step doubles the way that is known."""
    known = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        on = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = known.join(on, "root", "left")
        known = cut_lineage(
            step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        )
        if not known.where("moved").limit(1).count():
            return known.select("word", "root")
        known = known.drop("moved")


def spelling_variants(words: DataFrame, ratio: int = RATIO, **kwargs) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``words(word, n)``.

    A word's form is its near word of the largest n, of equal ones the first by code point, where that n is at least
    ``ratio`` times the word's; forms are followed to the last for the root. An empty table gives an empty result.
    """
    if ratio < 2:
        raise ValueError("a form must occur more often than its variant")
    words = cut_lineage(words)
    pairs = cut_lineage(near_pairs(words, **kwargs))
    both = pairs.select("a", "b", "b_n").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    best = both.groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form"))).alias("best")
    )
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "best.form", (-F.col("best.less")).alias("form_n")
    )
    held = F.col("form_n") >= ratio * F.col("n")
    found = cut_lineage(
        found.withColumns({"form": F.when(held, F.col("form")), "form_n": F.when(held, F.col("form_n"))})
    )
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


#: Checksum of a list of bytes: the table by its rule, then a fold. Words hold letters below U+0100: one or two bytes.
_SQL = """
with crc as (
  select list(list_reduce([i::bigint, 0, 0, 0, 0, 0, 0, 0, 0],
              lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
  from range(256) r(i)),
runs as (
  select doc_id, w, count(*) as k
  from (select doc_id, unnest(regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[a-z\u00C0-\u00FF]+')) as w
        from documents)
  where length(w) >= 6
  group by 1, 2),
hashed as (
  select w, k, xor(list_reduce(
      list_concat([4294967295::bigint], flatten(list_transform(
        string_split(concat(doc_id, ':', w), ''),
        lambda x: case when unicode(x) < 128 then [unicode(x)::bigint]
                       else [(192 | (unicode(x) >> 6))::bigint, (128 | (unicode(x) & 63))::bigint] end))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as h
  from runs, crc),
altered as (
  select case when h % 199 = 0
              then concat(substr(w, 1, (h % length(w))::int), substr(w, (h % length(w))::int + 2)) else w end as w, k
  from hashed),
words as (
  select w, sum(k)::bigint as n from altered where length(w) >= 6 group by 1 having sum(k) >= 5),
met as (
  select a.w as a, b.w as b, b.n as m
  from words a join words b on substr(a.w, 1, 3) = substr(b.w, 1, 3)
  where (length(a.w) = length(b.w) and len(list_filter(range(1, length(a.w) + 1), lambda i: a.w[i] <> b.w[i])) = 1
         or length(a.w) = length(b.w) + 1
            and list_contains(list_transform(range(1, length(a.w) + 1), lambda i: concat(substr(a.w, 1, i - 1), substr(a.w, i + 1))), b.w)
         or length(b.w) = length(a.w) + 1
            and list_contains(list_transform(range(1, length(b.w) + 1), lambda i: concat(substr(b.w, 1, i - 1), substr(b.w, i + 1))), a.w))
  union
  select a.w, b.w, b.n
  from words a join words b on substr(a.w, length(a.w) - 2) = substr(b.w, length(b.w) - 2)
  where (length(a.w) = length(b.w) and len(list_filter(range(1, length(a.w) + 1), lambda i: a.w[i] <> b.w[i])) = 1
         or length(a.w) = length(b.w) + 1
            and list_contains(list_transform(range(1, length(a.w) + 1), lambda i: concat(substr(a.w, 1, i - 1), substr(a.w, i + 1))), b.w)
         or length(b.w) = length(a.w) + 1
            and list_contains(list_transform(range(1, length(b.w) + 1), lambda i: concat(substr(b.w, 1, i - 1), substr(b.w, i + 1))), a.w))),
best as (
  select a, count(*) as n_near, max(m) as top, arg_min(b, {'m': -m, 'b': encode(b)}) as form
  from met group by a),
formed as (
  select w as word, case when top >= 5 * n then form end as form, n, coalesce(n_near, 0) as n_near,
         case when top >= 5 * n then top end as form_n
  from words left join best on a = w),
chain as (
  with recursive c(word, here, step) as (
    select word, word, 0 from formed
    union all
    select c.word, f.form, step + 1 from c join formed f on f.word = c.here where f.form is not null)
  select word, arg_max(here, step) as root from c group by word)
select word, form, root, n, n_near::bigint as n_near, form_n from formed join chain using (word)
"""


@query("op13_spelling_variants", _SQL)
def op13_spelling_variants(spark, sf):
    return spelling_variants(word_counts(table(spark, sf, "documents")))
