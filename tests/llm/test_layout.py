"""Packing, mixing and sharding."""

import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm import mixing, packing, sharding
from riskloom.llm.common import identified

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- packing -------------------------------------------------------------------


def check_pack(df, pieces, capacity):
    """Every id in exactly one piece, sequences gapless, next to no padding."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = Counter()
    for r in df.select("doc_id", "text").collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        want[(r.doc_id, np.array(ids, "<u4").tobytes())] += 1
    per_doc, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length and p.length > 0
        per_doc[p.doc].append(p)
        sequences[p.sequence_id].append(p)
    for doc, own in per_doc.items():
        texts = [ids for (d, ids), n in want.items() if d == doc for _ in range(n)]
        assert sum(p.length for p in own) == sum(len(t) // 4 for t in texts)
        left = Counter((p.start, bytes(p.ids), p.doc_tokens) for p in own)
        for ids in texts:  # lay each text out of pieces that fit it
            at = 0
            while at < len(ids) // 4:
                fit = next(k for k, n in left.items() if n and k[0] == at and k[2] == len(ids) // 4 and ids.startswith(k[1], at * 4))
                left[fit] -= 1
                at += len(fit[1]) // 4
        assert not +left
    assert set(per_doc) == {d for d, _ in want}
    padding = 0
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
        filled = sum(p.length for p in own)
        assert filled <= capacity
        padding += 0 if filled & (filled - 1) == 0 else capacity - filled
    assert padding == 0


def test_pack_of_odd_rows(odd_docs, no_docs):
    for capacity, classes in ((2048, 6), (8, 2), (1, 6)):
        df = odd_docs if capacity > 1 else odd_docs.where("n is null and length(text) < 200 or text is null")
        check_pack(df, packing.pack(df, capacity=capacity, classes=classes).collect(), capacity)
    assert packing.pack(no_docs).count() == 0
    with pytest.raises(ValueError):
        packing.pack(odd_docs, capacity=1000)


def test_pack_of_a_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    pieces = packing.pack(docs).collect()
    check_pack(docs, pieces, 2048)
    fits = {p.doc for p in pieces if p.doc_tokens <= 2048}
    whole = {p.doc for p in pieces if p.length == p.doc_tokens <= 2048}
    assert len(whole) >= 0.9 * len(fits) > 0
    row = packing.op2_harmonic_packing(spark, sf).first()
    assert row.ids_crc32 >= 0 and "ids" not in row.asDict()


def test_ids_equal_the_tokenizers(sf):
    path = public_tokenizers.path(packing.TOKENIZER)
    tokenizer, coder = Tokenizer.from_file(path), packing.WordIds(path, cached=40)
    texts = [
        "",
        "Straße ÀÉ ĮX don't it's we'LL x-y a.b. (x) A%%%% 12ab ab12 <|endoftext|> x<|endoftext|>y __",
        "nbsp in side 　 ΣΣ İ ŉ ﬁ é ́a \x1c z\x85z 漢字かな 🙂!! ªºµ",
        " ".join(f"w{i} Word{'!' * (i % 4)} abc{chr(97 + i % 26)}." for i in range(300)),
    ]
    for text in texts * 2:
        want = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert coder(text.encode()).tolist() == want
    assert tokenizer.get_vocab_size() > 49_000
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert not packing.WordIds(other).by_parts


# --- mixing --------------------------------------------------------------------


def slow_targets(sizes):
    """sizes: source key to words, exact; caps by repeated sharing."""
    names = sorted(sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    capped: set = set()
    total = sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        share = sum(weight[s] for s in names if s not in capped)
        target = {s: Fraction(3 * sizes[s]) if s in capped else Fraction(rest * weight[s], share) for s in names}
        over = {s for s in names if s not in capped and target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def slow_quotas(target, total, block):
    seats = int(total / block + 0.5)
    quota = dict.fromkeys(target, 0)
    for _ in range(seats):
        best = max(sorted(target), key=lambda s: target[s] / (2 * quota[s] + 1))
        quota[best] += 1
    return quota


def source(r):
    return "1" if r.source is None else "0" + r.source


@pytest.mark.parametrize("block", [7, 1000])
def test_targets_and_quotas_match_the_slow_way(spark, sf, odd_docs, block):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    tiny = table.where("source not in ('src3', 'src5') or doc_id in (3, 5)")
    for df in (tiny, odd_docs):
        rows = df.collect()
        sizes = Counter()
        for r in rows:
            sizes[source(r)] += len(WORD.findall(r.text or ""))
        target = slow_targets(sizes)
        quota = slow_quotas({s: t for s, t in target.items() if t}, sum(sizes.values()), block)
        sized = df.select(mixing.source_key(F.col("source")).alias("src"), mixing.n_words(F.col("text")).alias("size"))
        quotas = mixing.apportion(mixing.source_targets(sized), block)
        got = {r.src: r for r in quotas.collect()}
        assert set(got) == set(sizes)
        for s, r in got.items():
            assert r.target == pytest.approx(float(target[s]))
            assert r.quota == quota.get(s, 0)
            assert abs(r.wanted - target[s]) <= Fraction(1, 2) + Fraction(1, 10**6) and r.wanted <= 3 * sizes[s]
        dealt = mixing.shard_quotas(quotas, 8).collect()
        per_shard, per_source = Counter(), Counter()
        for r in dealt:
            per_shard[r.shard] += r.blocks
            per_source[r.src] += r.blocks
            assert abs(r.blocks - got[r.src].quota / 8) < 1
        assert per_source == Counter({s: q.quota for s, q in got.items() if q.quota})
        assert max(per_shard.values()) - min(per_shard[k] for k in range(8)) <= 1


@pytest.mark.parametrize("block", [5, 256])
def test_mix_takes_whole_blocks_and_the_exact_rest(spark, sf, odd_docs, no_docs, block):
    for df in (spark.read.parquet(f"{sf}/documents.parquet"), odd_docs):
        rows = mixing.mix(df, block_words=block).collect()
        assert len(rows) == df.count()
        blocks, shards, words, target = Counter(), defaultdict(set), Counter(), {}
        for r in rows:
            key = (r.source_size, r.target)
            target[key] = r.target
            pieces = r.pieces or []
            assert r.taken == sum(p.words for p in pieces) <= 3 * r.size
            times = Counter(w for p in pieces for w in range(p.first, p.first + p.words))
            assert all(0 <= w < r.size and n <= 3 for w, n in times.items())
            for p in pieces:
                blocks[key, p.place] += p.words
                shards[key, p.place].add((p.block, p.shard))
                words[key, p.shard] += p.words
        for key, goal in target.items():
            wanted = min(int(goal + 0.5), 3 * key[0])
            own = {place: n for (k, place), n in blocks.items() if k == key}
            assert sum(own.values()) == wanted
            for place, n in own.items():  # a block is one stretch of the stream, in one shard
                assert n == (block if place < wanted // block else wanted % block)
                assert len(shards[key, place]) == 1
            by_shard = [words[key, k] for k in range(8)]
            assert max(by_shard) - min(by_shard) <= 2 * block
        again = mixing.mix(df, block_words=block).collect()
        assert sorted(map(str, rows)) == sorted(map(str, again))
    assert mixing.mix(no_docs).count() == 0


def test_mixed_documents_are_whole_and_near_the_targets(spark, sf, odd_docs, no_docs):
    for df in (spark.read.parquet(f"{sf}/documents.parquet"), odd_docs):
        mixed = mixing.mixed_documents(df)
        assert mixed.columns == df.columns
        texts = {r.text for r in df.collect()}
        size, longest, got = Counter(), Counter(), Counter()
        for r in df.collect():
            n = len(WORD.findall(r.text or ""))
            size[source(r)] += n
            longest[source(r)] = max(longest[source(r)], n)
        for r in mixed.collect():
            assert r.text in texts
            got[source(r)] += len(WORD.findall(r.text))
        for s, goal in slow_targets(size).items():
            assert abs(got[s] - goal) <= longest[s] / 2 + 1
    assert mixing.mixed_documents(no_docs).count() == 0


@pytest.fixture(scope="module")
def three_sources(spark, tmp_path_factory):
    rows = [(i, " ".join(["w"] * (20 + i * 37 % 380)), "abc"[i % 3]) for i in range(900)]
    path = str(tmp_path_factory.mktemp("sources") / "t")
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_whole_documents_follow_the_selected_blocks_and_their_shards(three_sources):
    """Before, blocks, quotas and shards had no part in it: a source's documents were taken as a prefix of its seeded order."""
    laid = mixing._laid(three_sources, "doc_id", "text", "source", mixing.BLOCK_WORDS, mixing.SEED)
    takes = Counter((r.row, r.shard) for r in mixing.document_takes(laid).collect())
    begun, source_of = Counter(), {}
    for r in mixing.mix(three_sources).collect():
        source_of[r.row] = r.source_size
        begun.update((r.row, p.shard) for p in r.pieces if p.first == 0)
    for size in set(source_of.values()):  # what the two have differently lies at the end of a source's selection
        own = {k for k in takes | begun if source_of[k[0]] == size}
        assert sum(abs(takes[k] - begun[k]) for k in own) <= 6 < sum(takes[k] for k in own) / 10
    for k in range(8):  # every shard has every source's share
        words = Counter()
        sizes = {r.row: (r.source_size, r["size"]) for r in laid.select("row", "source_size", "size").collect()}
        for (row, shard), n in takes.items():
            words[sizes[row][0]] += n * sizes[row][1] if shard == k else 0
        wanted = {r.source_size: r.wanted for r in laid.select("source_size", "wanted").distinct().collect()}
        assert all(abs(words[s] - w / 8) < 0.35 * w / 8 for s, w in wanted.items())


def test_a_shard_of_whole_documents_has_partitions_of_its_own(three_sources, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_PARTITION", 70)
    laid = mixing._laid(three_sources, "doc_id", "text", "source", mixing.BLOCK_WORDS, mixing.SEED)
    named = mixing.document_takes(laid).join(laid.select("row", "id"), "row").collect()
    parts = -(-len(named) // (8 * 70))
    assert parts > 1
    got = mixing.mixed_documents(three_sources).select("doc_id", F.spark_partition_id().alias("p")).collect()
    assert Counter((r.doc_id, r.p // parts) for r in got) == Counter((r.id, r.shard) for r in named)


def test_a_tiny_source_beside_huge_ones_is_taken(spark, tmp_path):
    """Eight million words and more: a share of 2^20 of them is longer than the tiny sources."""
    huge = spark.range(8).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 1 << 20).alias("text"), F.concat(F.lit("huge"), F.col("id") % 2).alias("source"))
    tiny = spark.createDataFrame([(100, "one", "a"), (101, "two words", "b"), (102, "three", "tiny")], huge.schema)
    huge.unionByName(tiny).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    rows = mixing.mix(df).collect()
    assert sum(r.taken for r in rows) == sum(r["size"] for r in rows)
    assert {r.id: r.taken for r in rows if r.id >= 100} == {100: 3, 101: 6, 102: 3}
    for k in range(2):
        huge_rows = [r for r in rows if r.id < 100 and r.id % 2 == k]
        assert abs(sum(r.taken for r in huge_rows) - huge_rows[0].target) < 1
    kept = {r.doc_id for r in mixing.mixed_documents(df).select("doc_id").collect()}
    assert kept >= {100, 101, 102}


# --- sharding ------------------------------------------------------------------


def slow_interleave(rows, shards):
    """rows: (row, id, source key), placed as the operator's docstring says."""
    import hashlib

    by_source = defaultdict(list)
    for row, doc, src in rows:
        name = str(doc) if doc is not None else f"row {row}"
        by_source[src].append((hashlib.md5(f"{name}:{sharding.SEED}".encode()).hexdigest(), doc is not None, doc or 0, row))
    placed = []
    for src, own in by_source.items():
        for rank, (*_, row) in enumerate(sorted(own)):
            placed.append((Fraction(2 * rank + 1, 2 * len(own)), src, row))
    out, seen = {}, Counter()
    for position, (_, _, row) in enumerate(sorted(placed)):
        shard = position * shards // len(placed)
        out[row] = (shard, seen[shard])
        seen[shard] += 1
    return out


def test_shards_match_the_slow_way(spark, sf, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr("riskloom.llm.order.ROWS_PER_BUCKET", 8)
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 8)
    for df in (spark.read.parquet(f"{sf}/documents.parquet"), odd_docs):
        rows = identified(df, **{c: F.col(c) for c in ("doc_id", "text", "source")}).collect()
        want = slow_interleave([(r.row, r.doc_id, source(r)) for r in rows], 8)
        got = {r.row: r for r in sharding.interleave(df).collect()}
        assert {k: (r.shard, r.slot) for k, r in got.items()} == want
        for r in rows:
            assert got[r.row].size == len((r.text or "").encode()) + 1
            assert got[r.row].text_crc32 == zlib.crc32((r.text or "").encode())
        counts = Counter(r.shard for r in got.values())
        assert max(counts.values()) - min(counts[k] for k in range(8)) <= 1
    assert sharding.interleave(no_docs).count() == 0


def test_every_shard_matches_the_mixture(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    joined = sharding.interleave(docs).join(docs, F.col("id") == docs.doc_id)
    table = Counter((r.source, r.shard) for r in joined.select("source", "shard").collect())
    totals = Counter()
    for (s, _), n in table.items():
        totals[s] += n
    assert all(abs(n - totals[s] / 8) <= 1 for (s, _), n in table.items())


def test_native_operators_have_no_python_in_their_plans(spark, sf):
    for fn in (mixing.op4_source_mixing, sharding.op8_stratified_interleaving):
        plan = fn(spark, sf)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
