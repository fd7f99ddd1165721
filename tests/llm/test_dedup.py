import hashlib
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from riskloom.llm import exact_dedup, passages, simhash
from riskloom.llm.common import connected_components


def ascii_lower(text):
    return (text or "").encode().lower()


# --- exact dedup ---------------------------------------------------------------


def test_exact_groups_on_odd_rows(odd_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    groups = defaultdict(list)
    for r in rows:
        groups[ascii_lower(r.text)].append(r.doc_id)
    got = exact_dedup.exact_groups(odd_docs).collect()
    assert len(got) == len(rows)
    want = sorted((hashlib.sha256(t).hexdigest(), len(ids)) for t, ids in groups.items() for _ in ids)
    assert sorted((r.sha, r.group_size) for r in got) == want
    for text, ids in groups.items():
        own = [r for r in got if r.sha == hashlib.sha256(text).hexdigest()]
        best = max((i for i in ids if i is not None), default=None)
        assert {r.keep_id for r in own} == {best}
        assert [r.doc for r in own if r.kept] == [best]


@pytest.mark.parametrize("size", [1, 3, 7])
def test_names_equal_exactly_when_texts_do(store, size):
    texts = ["", "a", "b", "ab", "ba", "aab", "abab", "abababab", "ababababa", "abababab", "AB", "x" * 100, "x" * 101, "é" * 9]
    df = store(list(enumerate(texts)), "doc_id int, text string")
    rows = exact_dedup.text_identity(df, block_bytes=size).collect()
    assert len(rows) == len(texts)
    for a in rows:
        for b in rows:
            same = ascii_lower(texts[a.doc]) == ascii_lower(texts[b.doc])
            assert ((a.blocks, a.name) == (b.blocks, b.name)) == same


def test_drop_copies_keeps_columns_and_one_row_a_text(odd_docs, no_docs):
    kept = exact_dedup.drop_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = [ascii_lower(r.text) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({ascii_lower(r.text) for r in odd_docs.collect()})
    assert exact_dedup.drop_copies(no_docs).count() == 0


# --- near dedup ----------------------------------------------------------------


def slow_fingerprint(text):
    words = ascii_lower(text).split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(prints):
    """prints: list of (id, fingerprint); smallest id reachable, by brute force."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 3:
                parent[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            low[find(i)] = min(doc, low.get(find(i), doc))
    return [low.get(find(i)) for i in range(len(prints))]


def test_near_groups_match_brute_force_on_a_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = [(r.doc_id, slow_fingerprint(r.text)) for r in rows]
    want = sorted((d, f"{p:016x}", c) for (d, p), c in zip(prints, components(prints)))
    got = sorted(tuple(r)[:3] for r in simhash.op1_simhash_near_dedup(spark, sf).collect())
    assert got == want


def test_links_of_dense_fingerprints(spark):
    """A centre with many variants of one to three bits, chains of steps, and strangers."""
    import random

    dice = random.Random(3)
    centre = dice.getrandbits(64)
    prints = {centre, 0, (1 << 64) - 1, 1 << 63}
    for _ in range(300):
        p = centre
        for b in dice.sample(range(64), dice.randint(1, 5)):
            p ^= 1 << b
        prints.add(p)
    chain = dice.getrandbits(64)
    for _ in range(20):
        for b in dice.sample(range(64), 3):
            chain ^= 1 << b
        prints.add(chain)
    prints |= {dice.getrandbits(64) for _ in range(200)}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    df = spark.createDataFrame([(p, 1) for p in signed], "fp bigint, n bigint")
    roots = {r.fp: r.root for r in simhash.link_components(df).collect()}
    want = components(list(enumerate(prints)))
    for i, a in enumerate(signed):
        for j, b in enumerate(signed[:i]):
            assert (roots[a] == roots[b]) == (want[i] == want[j])


def test_near_dedup_on_odd_rows(odd_docs, no_docs):
    got = simhash.near_groups(odd_docs).collect()
    prints = [(r.doc_id, slow_fingerprint(r.text)) for r in odd_docs.select("doc_id", "text").collect()]
    key = lambda x: (x[0] is None, x)
    want = sorted(((d, p, c) for (d, p), c in zip(prints, components(prints))), key=str)
    assert sorted(((r.doc, r.fp % (1 << 64), r.component_id) for r in got), key=str) == want, key
    kept = simhash.drop_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len({c for _, _, c in want})
    assert simhash.near_groups(no_docs).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (60, 61)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)} | {60: 60, 61: 60}
    assert got == want


# --- passages ------------------------------------------------------------------


def slow_passages(docs, window):
    first = {}
    for doc, text in docs:
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if doc is not None:
                first[key] = min(doc, first.get(key, doc))
    out = []
    for doc, text in docs:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - window + 1):
            if doc is not None and first[tuple(words[i : i + window])] < doc:
                gone |= set(range(i, i + window))
        left = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def passages_of(df, **options):
    got = passages.drop_passages(df, **options).collect()
    return sorted(((r.doc, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str)


@pytest.mark.parametrize("hot", [8000, 2])
def test_passages_match_brute_force(spark, sf, monkeypatch, hot):
    """Once as it is, once with every anchor of more than two documents spread over tasks."""
    monkeypatch.setattr(passages, "HOT_DOCUMENTS", hot)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert passages_of(docs) == slow_passages(rows, 13)


def test_passages_on_odd_rows(odd_docs, no_docs, store):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert passages_of(odd_docs) == slow_passages(rows, 13)
    assert passages_of(no_docs) == []
    letters = store([(i, " ".join("abc"[(i * k) % 3] for k in range(40))) for i in range(12)], "doc_id int, text string")
    rows = [(r.doc_id, r.text) for r in letters.collect()]
    assert passages_of(letters, window=4) == slow_passages(rows, 4)


def test_row_filter_lets_every_wanted_row_pass(spark):
    source = spark.range(5000).select(F.col("id").alias("row"), F.col("id").alias("doc"), F.lit(b"x").alias("text"))
    wanted = spark.range(0, 5000, 7).select(F.col("id").alias("row"))
    passed = passages._row_filter(source, wanted)
    assert passed.join(wanted, "row").count() == wanted.count()
    assert passed.count() < 2000
