"""MinHash near-dedup, the conversation trie and spelling variants."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import minhash, prefix_trie, spelling

# --- minhash -------------------------------------------------------------------


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def slow_components(rows, least=85):
    """rows: (id, text) with distinct ids, None allowed; (n, component) per row in order."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= least * len(a | b):
                parent[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return sorted(str((doc, len(sets[i]), low.get(find(i)))) for i, (doc, _) in enumerate(rows))


def fast_components(df, **options):
    return sorted(str((r.doc, r.n_shingles, r.component_id)) for r in minhash.near_documents(df, **options).collect())


def test_near_documents_on_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert fast_components(odd_docs) == slow_components(rows)
    assert minhash.near_documents(no_docs).count() == 0


def test_near_documents_of_a_table(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    assert fast_components(df) == slow_components([(r.doc_id, r.text) for r in df.collect()])


def test_a_hot_group_of_near_copies_with_chains(store):
    """Copies drift away from one text: many pairs of the group are no links, yet it is one component beside others."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(80)]
    rows = []
    for k in range(150):
        words = list(base)
        for _ in range(rng.randrange(5)):
            words[rng.randrange(80)] = f"x{rng.randrange(10_000)}"
        rows.append((k, " ".join(words)))
    chain = [f"c{i}" for i in range(60)]
    for k in range(40):  # each a few words from the one before, far from the first
        chain = chain[2:] + [f"n{k}a", f"n{k}b"]
        rows.append((1000 + k, " ".join(chain)))
    for k in range(60):  # half shared: candidates, not links
        rows.append((2000 + k, " ".join(base[:50] + [f"y{k}z{i}" for i in range(30)])))
    df = store(rows, "doc_id int, text string")
    assert fast_components(df) == slow_components(rows)


def test_similar_texts_that_are_no_links_make_no_rows_of_pairs(store, monkeypatch):
    rng = random.Random(5)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for k in range(160):
        words = list(base)
        for at in rng.sample(range(120), rng.choice([1, 6, 7, 8])):
            words[at] = f"x{rng.randrange(100_000)}"
        rows.append((k, " ".join(words)))
    handed = []
    of = minhash.Links.of
    monkeypatch.setattr(minhash.Links, "of", lambda self, pairs: handed.append(pairs.count()) or of(self, pairs))
    assert fast_components(store(rows, "doc_id bigint, text string", parts=4)) == slow_components(rows)
    assert max(handed, default=0) <= minhash.PIVOTS * len(rows)


def test_near_copies_are_handed_on_in_one_of_the_bands_they_share(store, monkeypatch):
    base = [f"w{i}" for i in range(300)]
    rows = [(k, " ".join([*base, f"end{k}"])) for k in range(2)]
    rows += [(k, " ".join(f"v{k}x{i}" for i in range(50))) for k in range(10, 40)]
    handed, among = [], minhash.Links.among
    monkeypatch.setattr(minhash.Links, "among", lambda self, members: handed.append(members.count()) or among(self, members))
    assert fast_components(store(rows, "doc_id bigint, text string")) == slow_components(rows)
    assert handed == [2]


def test_only_wanted_bodies_go_to_a_join(spark):
    bodies = spark.range(5000).selectExpr("id as rep", "cast('b' as binary) as body")
    passed = {r.rep for r in minhash.bodies_of(spark.range(0, 5000, 50).selectExpr("id as rep"), bodies).collect()}
    assert passed >= set(range(0, 5000, 50)) and len(passed) < 500


def test_tiles_let_every_two_members_meet_once(spark):
    members = spark.range(90).selectExpr("id % 2 as key", "id as rep", "id as n")
    met = minhash.in_tiles(members, 10, 10**9).collect()
    tiles = defaultdict(list)
    for r in met:
        tiles[r.key, r.p, r.q].append((r.rep, r.part))
    pairs = Counter()
    for (_, p, q), own in tiles.items():
        pairs.update((a, b) for a, x in own for b, y in own if a < b and (p == q or x != y))
    assert pairs == Counter({(a, b): 1 for a in range(90) for b in range(a + 2, 90, 2)})
    assert max(len(x) for x in tiles.values()) < 45


def test_groups_and_pairs_of_sorted_rows():
    rng = np.random.default_rng(4)
    keys = np.repeat(np.arange(40), rng.choice([1, 2, 5, 300], 40))
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[at : at + 97])], names=["k"]) for at in range(0, len(keys), 97)]
    found, seen = Counter(), []
    for batch, bounds in minhash.whole_groups(iter(batches), ("k",)):
        own = batch.column("k").to_numpy()
        assert (own[bounds[:-1]] == np.unique(own)).all()
        seen.extend(own.tolist())
        for i, j in minhash.pairs_within(bounds):
            assert (own[i] == own[j]).all() and (i < j).all() and len({*zip(i.tolist(), j.tolist())}) == len(i)
            found.update(own[i].tolist())
    assert seen == keys.tolist()
    assert found == Counter({k: n * (n - 1) // 2 for k, n in Counter(keys.tolist()).items() if n > 1})


def test_sizes_of_intersections():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 20_000, n).astype(np.uint64)) for n in (1, 500, 9000, 9000, 12_000)]
    i, j = np.triu_indices(len(sets), 1)
    assert minhash.shared_sizes(sets, i, j).tolist() == [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)]


def test_pruning_keeps_pairs_at_the_threshold():
    assert minhash.least_agreements(32) < minhash.least_agreements(64) < minhash.least_agreements(128) < 128 * 0.85
    for n in (32, 64, 128):
        draws = np.random.default_rng(n).binomial(n, 0.85, 400_000)
        assert (draws >= minhash.least_agreements(n)).all()
    signer, values = minhash.Signer(), np.random.default_rng(1).integers(0, 2**63, 2000, dtype=np.uint64)
    agree = [(signer.sign(values[:1000]) == signer.sign(values[s : s + 1000])).mean() for s in (0, 81, 500)]
    assert agree[0] == 1 and abs(agree[1] - 0.85) < 0.12 and abs(agree[2] - 1 / 3) < 0.15


# --- conversation trie ---------------------------------------------------------


def slow_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, role, digest, text))
    own = {c: [(r, t) for _, _, r, _, t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    nodes = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
    out = []
    for path, members in nodes.items():
        below = {p: m for p, m in nodes.items() if p[: len(path)] == path}
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(m) - 1) * len(p[-1][1]) for p, m in below.items() if p)
        ends = ",".join(str(c) for c in sorted(members) if len(rebuilt[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, out))


def fast_trie(df):
    return sorted(str(tuple(r)) for r in prefix_trie.prefix_trie(*prefix_trie.sequences(df)).collect())


CONV = "conv_id bigint, turn bigint, role string, text string, conv string, pos bigint, depth int"


def with_clashes(rows):
    return [(*r, "x", 9, 9) for r in rows]


@pytest.mark.parametrize("piece", [1 << 15, 4])
def test_trie_of_random_conversations(store, monkeypatch, piece):
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    monkeypatch.setattr(prefix_trie, "_STRETCH", 3)
    rng = random.Random(5)
    rows = []
    for c in [*range(100, 140), *range(700, 730), 5, 905]:
        for t in range(rng.randrange(1, 10)):
            rows.append((c, t, rng.choice("ab"), rng.choice(["hi", "hello there", "é🙂"])))
    rows += [(730 + k, t, "a", "hi") for k in range(25) for t in range(4)]  # copies of one conversation
    rows += [(760, t % 3, "a", f"{t % 5}") for t in range(150)]  # a long one with ties
    rows += [(None, 1, "a", "b"), (761, None, None, None), (761, 0, None, "x"), (761, None, "a", None), (762, 0, "a", ""), (762, 0, "a", "")]
    assert fast_trie(store(with_clashes(rows), CONV)) == slow_trie(rows)


def test_trie_without_turns_or_rows(store):
    assert fast_trie(store([], CONV, 1)) == []
    short = [(c, 0, "a", "b") for c in (2, 7, 11)]  # no base: the first turns go
    assert fast_trie(store(with_clashes(short), CONV)) == slow_trie(short)


# --- spelling variants -----------------------------------------------------------


def slow_counts(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.encode().lower().decode()
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def slow_variants(counts):
    out, form = [], {}
    near = {a: [b for b in counts if abs(len(a) - len(b)) < 2 and one_edit(a, b)] for a in counts}
    for a, others in near.items():
        best = min(others, key=lambda b: (-counts[b], b), default=None)
        if best is not None and counts[best] >= 5 * counts[a]:
            form[a] = best
    for a in counts:
        root = a
        while root in form:
            root = form[root]
        out.append((a, form.get(a), root, counts[a], len(near[a]), counts[form[a]] if a in form else None))
    return sorted(map(str, out))


def fast_variants(words, **options):
    return sorted(str(tuple(r)) for r in spelling.spelling_variants(words, **options).collect())


def test_counts_of_odd_rows(odd_docs, no_docs, store):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert {r.word: r.n for r in spelling.word_counts(odd_docs).collect()} == slow_counts(rows)
    assert fast_variants(spelling.word_counts(no_docs)) == []
    text = "Straßen ÀÉçetera x×y÷zabcdef ΩABCDEFGΩ " + "a" * 5000 + " " + " ".join(f"letter{chr(97 + i % 26)}" for i in range(3000))
    more = [(k, text) for k in range(12)]
    assert {r.word: r.n for r in spelling.word_counts(store(more, "doc_id int, text string")).collect()} == slow_counts(more)


@pytest.mark.parametrize("options", [{}, {"leaf_words": 20, "searches": 30}, {"groups": 3, "top": 1}])
def test_variants_of_many_near_words(spark, options):
    rng = random.Random(9)
    counts = {}
    for _ in range(120):
        word = "".join(rng.choice("abcdéü") for _ in range(rng.randrange(6, 9)))
        counts[word] = rng.choice([5, 25, 125, 700])
        for _ in range(4):
            i, c = rng.randrange(len(word)), rng.choice("abcdéü")
            counts[rng.choice([word[:i] + c + word[i:], word[:i] + c + word[i + 1 :], word[:i] + word[i + 1 :] + "a"])] = rng.choice([5, 6, 30])
    counts["z" * 90], counts["z" * 91], counts["z" * 89 + "y"] = 900, 30, 6
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert fast_variants(words, **options) == slow_variants(counts)


def test_variants_of_a_table(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    counts = slow_counts([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    assert sorted(str(tuple(r)) for r in spelling.op13_spelling_variants(spark, sf).collect()) == slow_variants(counts)


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=3, max_size=9), st.text("abc", min_size=3, max_size=9))
def test_near_is_one_edit(a, b):
    assert spelling.near(a, b) == one_edit(a, b)
    rows = spelling.near_rows(spelling.Letters([a]), np.array([0]), spelling.Letters([b]), np.array([0]))
    assert len(a) < 6 or len(b) < 6 or bool(rows[0]) == one_edit(a, b)
