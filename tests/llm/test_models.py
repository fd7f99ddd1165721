"""Quality classifier, neighbours, main text, language model and the pipeline."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import html_text, lm, neighbours, packing, quality

# --- quality -------------------------------------------------------------------


def test_label_model_finds_accuracies():
    dice = np.random.default_rng(0)
    truth = dice.random(4000) < 0.2
    said = []
    for accuracy, cover in ((0.95, 0.9), (0.85, 0.8), (0.8, 0.9), (0.6, 0.7)):
        right = np.where(dice.random(4000) < accuracy, truth, ~truth).astype(int)
        said.append(np.where(dice.random(4000) < cover, right, 2))
    keys = ["".join(map(str, v)) for v in zip(*said)]
    model = quality.label_model(Counter((k, None) for k in keys), 4)
    assert np.mean([(model[(k, None)] > 0.5) == t for k, t in zip(keys, truth)]) > 0.93
    held = quality.label_model(Counter({("2222", 1): 3, ("0000", None): 5}), 4)
    assert held[("2222", 1)] == 1.0 and quality.label_model(Counter(), 4) == {}


def test_scorer_agrees_with_held_out_labels(spark):
    """Labels of even ids may be used, those of odd ids judge."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    for known in (labels.where("doc_id % 2 = 0"), None):
        judged = quality.classify(docs, known).join(labels.where("doc_id % 2 = 1"), F.col("doc") == F.col("doc_id"))
        rows = judged.select((F.col("junk") < 0.5).alias("good"), "quality").collect()
        good = [r.good for r in rows if r.quality == 1]
        bad = [r.good for r in rows if r.quality == 0]
        assert np.mean(good) > 0.98 and np.mean(bad) < 0.2, (np.mean(good), np.mean(bad))


def test_score_is_the_sum_of_features():
    dice = np.random.default_rng(1)
    weights = dice.normal(size=quality.BUCKETS)
    hasher = quality.Hasher(weights + 2j * weights)
    for text in (b"", b"one", b"One one ONE, one! 12 12 %%% x%%% \xc3\xa9t\xc3\xa9"):
        at, value = quality.Hasher().features(text)
        score = hasher.score(text)
        assert score.real == pytest.approx(float(weights[at] @ value), abs=1e-5)
        assert score.imag == pytest.approx(2 * score.real)


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (7, 0, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    judged = quality.classify(odd_docs, labels).collect()
    assert len(judged) == odd_docs.count() and all(0 <= r.junk <= 1 for r in judged)
    kept = quality.accepted(odd_docs, labels)
    assert kept.columns == odd_docs.columns
    assert kept.count() == sum(r.accepted for r in judged)
    assert quality.classify(no_docs, labels).count() == 0


# --- neighbours ----------------------------------------------------------------


def slow_nearest(rows, k):
    """rows: (place, id, vector) of sound vectors; the exact answer per query row."""
    out = {}
    points = np.array([v for _, _, v in rows], float)
    for i, (place, doc, vector) in enumerate(rows):
        if doc is not None and doc % 100 == 0:
            score = np.sqrt(((points - np.array(vector, float)) ** 2).sum(1))
            order = sorted((score[j], rows[j][1] is None, rows[j][1] or 0, rows[j][0]) for j in range(len(rows)) if j != i)
            out.setdefault(doc, []).append([(s, None if null else d) for s, null, d, _ in order[:k]])
    return out


def test_neighbours_recall_on_a_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(i, r.vec_id, r.embedding) for i, r in enumerate(spark.read.parquet(f"{sf}/embeddings.parquet").collect())]
    want = slow_nearest(rows, 10)
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = neighbours.nearest(df, F.col("vec_id") % 100 == 0, reach=3000, reach_share=0).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r.rank] = (r.id, r.score)
    hits = 0
    for q, (best,) in want.items():
        assert sorted(found[q]) == list(range(1, 11))
        hits += len({d for _, d in best} & {d for d, _ in found[q].values()})
    assert hits / (10 * len(want)) >= 0.9


def test_neighbours_on_odd_rows(store):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 7), float(i % 5), 1.0], "x") for i in range(60)]
    rows += [(100, [0.0, 1.0, 1.0], None), (100, [0.0, 1.0, 1.0], None), (200, None, None), (300, [0.0, 0.0, 0.0], None)]
    rows += [(400, [nan, 1.0, 1.0], None), (500, [1.0, None, 1.0], None), (600, [inf, 1.0, 1.0], None), (700, [1.0, 2.0], None)]
    rows += [(None, [0.0, 1.0, 1.0], None)] + [(1000 + i, [2.0, 2.0, 2.0], None) for i in range(40)]
    df = store(rows, "vec_id bigint, embedding array<float>, row string")
    table = [(i, r.vec_id, r.embedding) for i, r in enumerate(df.collect()) if r.row == "x" or r.vec_id in (None, 100) or (r.vec_id or 0) >= 1000]
    want = slow_nearest(table, 10)
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.score, r.id))
    assert set(got) == set(want)
    for q, lists in want.items():
        assert sorted((s, str(d)) for _, s, d in got[q]) == sorted((s, str(d)) for best in lists for s, d in best)
    few = store([(0, [1.0, 2.0], None), (1, [1.0, 3.0], None)], "vec_id bigint, embedding array<double>, row string", 1)
    assert [(r.query_id, r["rank"], r.id, r.score) for r in neighbours.nearest(few, F.col("vec_id") % 100 == 0).collect()] == [(0, 1, 1, 1.0)]
    assert neighbours.nearest(few.where("vec_id > 5"), F.lit(True)).count() == 0


# --- main text -----------------------------------------------------------------

PROSE = "A long enough sentence with many words, to be taken for prose by its ratio. " * 2
PAGES = [
    (None, ""),
    ("", ""),
    ("plain text only", "plain text only"),
    ("<p>a&amp;b &lt;c&gt;&nbsp;&#233;<br>d\n\n e</p>", "a&b <c> é d e"),
    (
        f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><ul><li><a href=x>Menu</a></ul></nav>"
        f"<div class='ad'>Buy {PROSE}</div><article><h1>Head</h1><p><b>{PROSE}<br><p>Short.<form><input><p>Your name</form>"
        f"<script>var t='</p>';</script><aside>Side {PROSE}</aside><ul><li>One<li>Two</ul><table><tr><td>c1<td>c2</table></article>"
        f"<div id='comments'><p>{PROSE}</div><div class='cookie-notice'>We {PROSE}</div><footer>&copy; {PROSE}</footer></body></html>",
        "\n".join(["Head", PROSE.strip(), "Short.", "One", "Two", "c1", "c2"]),
    ),
    (
        f"<body><div class=top><a href=a>Home</a> <a href=b>News</a> <a href=c>Shop</a></div>"
        f"<div id=x><h2>Title</h2><p>{PROSE}</p><p>{PROSE}</p></div><div><a href=d>More</a><a href=e>Else</a></div>",
        "\n".join(["Title", PROSE.strip(), PROSE.strip()]),
    ),
    ("<article><p>unclosed <b>bold <i>x", "unclosed bold x"),
    ("<!DOCTYPE html><!-- c --><p>after</p><!-- open", "after"),
]


@pytest.mark.parametrize("page, want", PAGES)
def test_main_text(page, want):
    assert html_text.main_text(page or "") == want


@pytest.mark.parametrize(
    "mark", ["<![x]>", "<![ foo>", "<![>", "<![endif]-->", "<![if !IE]>", "<![CDATA[x>", "<![CDATA[a > b]]>", "<!x>", f"&#{'9' * 5000};", "<?x>", "</ >", "<!>"]
)
def test_text_behind_a_malformed_declaration_is_kept(mark):
    ahead = html_text.main_text(f"{mark}<article><p>{PROSE}</p></article>")
    assert ahead == PROSE.strip()
    inside = html_text.main_text(f"<article><p>{PROSE}</p>{mark}<p>{PROSE}End</p></article>").splitlines()
    assert inside[0] == PROSE.strip() and inside[-1] == f"{PROSE}End"


HINTED = [
    (f"<article class='post has-sidebar'><p>{PROSE}</article>", [PROSE]),
    (f"<main class='no-comments'><p>{PROSE}</main>", [PROSE]),
    (f"<article class='comment'><p>{PROSE}</article>", [PROSE]),
    (f"<div class='page with-sidebar'><p>{PROSE}<p>{PROSE}</div>", [PROSE, PROSE]),
    (f"<div class=widget><div id=sidebar><article><p>{PROSE}</article></div></div><div class=ad>{PROSE * 3}</div>", [PROSE]),
    (f"<div class=widget><p>{PROSE * 3}</div><div class=ad>{PROSE}</div>", [PROSE * 3]),
    (f"<article><h2 id='related-work'>Related</h2><p>{PROSE}<section id='discussion'><h2 class=header>D</h2><p>{PROSE}</section></article>", ["Related", PROSE, "D", PROSE]),
    (f"<article><p>{PROSE}<p>so <math><mi>a</mi><mo>=</mo><mn>1</mn></math> holds</article>", [PROSE, "so a=1 holds"]),
    (f"<article><p>{PROSE}<span class=ad>Buy <b>now</b></span> tail<div class='comment-list'>c {PROSE * 5}</div></article>", [f"{PROSE}tail"]),
    (f"<article><p>{PROSE}</article><div id=comments><article class=comment-body><p>{PROSE}</article></div>", [PROSE]),
    (f"<article><p>{PROSE}<ul class=share-buttons hidden><li>x</ul><ul class='social share'><li>y</ul></article>", [PROSE]),
]


@pytest.mark.parametrize("page, want", HINTED)
def test_names_of_classes_and_ids(page, want):
    assert html_text.main_text(page).splitlines() == [x.strip() for x in want]


OTHERS = [
    (f"<div class=post><p>{PROSE}</p></div><div id=comments>" + f"<p>c {PROSE * 3}</p>" * 3 + "</div>", [PROSE]),
    (f"<div class=post><p>{PROSE}</p></div><div class=sidebar>" + f"<p>c {PROSE * 3}</p>" * 3 + "</div>", [PROSE]),
    (f"<div class=post><p>{PROSE}</p></div><div id=comments><article><p>{PROSE * 3}</p></article></div>", [PROSE]),
    (f"<body><form id=f><div class=post><h1>T</h1><p>{PROSE}</p></div><select><option>x</select><button>Go</button></form></body>", ["T", PROSE]),
    (f"<nav><ul><li><a href=x>Menu</a></ul><article><h1>T</h1><p>{PROSE}</p></article>", ["T", PROSE]),
    (f"<div><nav><ul><li><a href=x>Menu</a></ul><article><h1>T</h1><p>{PROSE}</p></article></div>", ["T", PROSE]),
    (f"<body><nav><a href=x>Menu</a><div><h1>T</h1><p>{PROSE}</p></div></body>", ["T", PROSE]),
    (f"<header><h1>Site</h1></header><div class=post><h1>T</h1><p>{PROSE}</p></div><footer><h4>About</h4>{PROSE}</footer>", ["T", PROSE]),
    (f"<body><section><p>{PROSE}</p></section><section><p>Short.</p></section><section><p>{PROSE}</p></section>", [PROSE, "Short.", PROSE]),
    (f"<article><p>{PROSE * 3}</p></article><article><p>Short one.</p></article>", [PROSE * 3, "Short one."]),
    (f"<article><p>{PROSE}</p></article><article class=comment><p>{PROSE * 4}</p></article>", [PROSE]),
    (f"<article><p>{PROSE}</p><aside><h3>Related</h3><article><p>teaser {PROSE}</p></article></aside><p>End.</p></article>", [PROSE, "End."]),
]


@pytest.mark.parametrize("page, want", OTHERS)
def test_pages_without_plain_structure(page, want):
    assert html_text.main_text(page).splitlines() == [x.strip() for x in want]


@pytest.mark.parametrize("make", [lambda n: "<div>" * n + "</p>" * n, lambda n: "<li><ul>" + "<div>" * n + "<li></li>" * n, lambda n: "<nav><h2>x" * n, lambda n: "<div class=ad><article>x" * n])
def test_deep_markup_takes_linear_time(make):
    import time

    def seconds(n):
        start = time.process_time()
        html_text.main_text(make(n) + "x")
        return time.process_time() - start

    seconds(1000)
    assert seconds(40_000) < 4 * 3 * max(seconds(10_000), 0.02)


def test_extract_handles_odd_rows(store):
    rows = [(i, None if i % 2 else "u", page, "x") for i, (page, _) in enumerate(PAGES)] + [(None, None, PAGES[4][0], "x")] * 2
    rows.append((99, "u", f"<article><p>{'long ' * 200_000}</p></article>", "x"))
    df = store(rows, "page_id bigint, url string, html string, text string")
    got = {r.page_id: r for r in html_text.extract(df).collect()}
    assert html_text.extract(df).count() == len(rows)
    for i, (_, want) in enumerate(PAGES):
        assert (got[i].text, got[i].n_chars) == (want, len(want))
    assert got[99].n_chars == 5 * 200_000 - 1
    assert html_text.extract(df.where("false")).count() == 0


def test_articles_of_a_table_come_back_whole(spark, sf):
    import html as entities
    import re

    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1].replace("<br>", " ")
        blocks = re.split(r"</?(?:p|h1)\b[^>]*>", inner)
        lines = [" ".join(entities.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks]
        assert html_text.main_text(r.html) == "\n".join(x for x in lines if x)


# --- language model ------------------------------------------------------------


def tokens_of(text):
    return (text or "").encode().lower().split()


def test_base_score_matches_brute_force_and_the_model_beats_it(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rest = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 10 for r in rows}
    counts = Counter()
    for r in rows:
        if rest[r.doc_id]:
            counts.update([*tokens_of(r.text), None])
    under = math.log10(sum(counts.values()) + 0.1 * (len(counts) + 1))
    got = {r.doc_id: r for r in lm.op6_recurrent_lm(spark, sf).collect()}
    assert len(got) == len(rows)
    for r in rows:
        own, mine = [*tokens_of(r.text), None], got[r.doc_id]
        assert mine.held_out == (rest[r.doc_id] == 0)
        assert (mine.n_tokens, mine.train_tokens) == (len(own), sum(counts.values()))
        assert mine.n_known == sum(t in counts for t in own)
        assert mine.base_score == pytest.approx(sum(math.log10(counts[t] + 0.1) - under for t in own), rel=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 0.99


def test_rare_words_take_the_joined_way(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 40")
    trains = F.col("doc_id") % 3 != 0
    listed = lm.score_texts(docs, trains).collect()
    joined = lm.score_texts(docs, trains, listed=2000).collect()
    key = lambda r: r.doc
    for a, b in zip(sorted(listed, key=key), sorted(joined, key=key)):
        assert (a.n_known, a.n_tokens) == (b.n_known, b.n_tokens)
        assert a.base_score == pytest.approx(b.base_score) and a.score == pytest.approx(b.score)


def small_words():
    tail = np.ones(lm.TAIL_CLASSES)
    return lm.Words({b"a": 5, b"b": 2}, {b"a": 1}, 3, 10, 3, tail, tail)


def test_places_of_words_hold_what_the_counts_say():
    counts = {b"a": 5, b"b": 2, b"xing": 2, b"ring": 1}
    tail = np.arange(1.0, lm.TAIL_CLASSES + 1)
    words = lm.Words(counts, {b"a": 1}, 3, 13, 5, tail, tail)
    tokens = [b"a", b"ring", b"b", b"sing", b"ring", b"zz"]
    places = words.slots.of(tokens)
    want = [words.head.get(t, words.n_head + lm.tail_class(t)) for t in tokens]
    assert words.slots.coded(places).tolist() == [*want, 0] and max(want) < words.start < 2**15
    assert (places >= words.slots.listed).tolist() == [t not in counts for t in tokens]
    logs = [math.log10(counts[t] + lm.SMOOTH) if t in counts else 0 for t in tokens]
    share = [math.log10((lm.tail_class(t) + 1) * (1 + lm.SMOOTH) + lm.SMOOTH) for t in tokens]
    assert words.slots.logs[places].tolist() == pytest.approx(logs)
    assert words.slots.shares[places].tolist() == pytest.approx([0 if t == b"a" else x - y for t, x, y in zip(tokens, logs, share)])


def test_gradients_match_differences():
    dice, words = np.random.default_rng(0), small_words()
    net = lm.Network.fresh(words)
    for name in net.w:
        net.w[name] = net.w[name].astype(float) + dice.normal(size=net.w[name].shape) * 0.1
    ids = dice.integers(0, words.start, (5, 6)).astype(np.int32)
    ids[0, :3] = ids[2, 4] = words.start
    goals, first = dice.integers(0, words.start, (5, 6)), dice.normal(size=(6, lm.HIDDEN))

    def loss():
        state, total = first, 0.0
        for t in range(5):
            state = net.step(ids[t], np.where((ids[t] == words.start)[:, None], 0, state))[-1]
            total -= net.log_chance(state, goals[t]).sum()
        return total / goals.size

    g, (rows, x), _ = net.gradient(ids, goals, first, words.start)
    full = {**g, "x": np.zeros_like(net.w["x"])}
    full["x"][rows] = x
    for name, gradient in full.items():
        where = np.argwhere(gradient != 0)
        for at in map(tuple, where[dice.choice(len(where), 4)]):
            kept = net.w[name][at]
            net.w[name][at] = kept + 1e-5
            up = loss()
            net.w[name][at] = kept - 1e-5
            down = loss()
            net.w[name][at] = kept
            assert (up - down) / 2e-5 == pytest.approx(gradient[at], rel=1e-4, abs=1e-8)


def test_every_token_is_trained_once():
    words, dice = small_words(), np.random.default_rng(3)
    docs = [dice.integers(1, words.start, n).astype(np.int32) for n in (700, 1, 333, 90, 2000, 5)]
    for buffer in (1000, 10**6):
        trainer, seen = lm.Trainer(lm.Network.fresh(words), words.start), Counter()
        gradient = trainer.network.gradient

        def noted(ids, targets, state, start):
            seen.update(zip(ids.ravel().tolist(), targets.ravel().tolist()))
            return gradient(ids, targets, state, start)

        trainer.network.gradient = noted
        trainer.fit(iter(docs), buffer)
        want = Counter(p for d in docs for p in zip([words.start, *d[:-1].tolist()], d.tolist()))
        assert seen == want and trainer.tokens == sum(map(len, docs))


def test_the_network_tells_enough_words_apart():
    words = small_words()
    assert (words.n_head, lm.TAIL_CLASSES) == (16 * 48, 48)


def test_chances_of_all_continuations_sum_to_one():
    words = small_words()
    net = lm.Network.fresh(words)
    states = np.random.default_rng(0).normal(size=(3, lm.HIDDEN)).astype(np.float32)
    for state in states:
        every = np.arange(words.n_head + lm.TAIL_CLASSES)
        chance = np.exp(net.log_chance(np.repeat(state[None], len(every), 0), every)).sum()
        assert chance == pytest.approx(1, abs=1e-4)


def test_state_is_carried_through_a_document_and_not_beyond():
    words = small_words()
    net = lm.Network.fresh(words)
    dice = np.random.default_rng(2)
    docs = [dice.integers(0, words.start, n).astype(np.int32) for n in (1, 500, 3, 70, 64, 65, 2)]
    together = lm.score_documents(net, docs, words.start)
    for doc, score in zip(docs, together):
        state, total, before = np.zeros((1, lm.HIDDEN), np.float32), 0.0, words.start
        for k in doc:
            state = net.step(np.array([before]), state)[-1]
            total += float(net.log_chance(state, np.array([k]))[0])
            before = k
        assert score == pytest.approx(total, rel=1e-4)


def test_language_model_on_odd_rows(odd_docs, no_docs):
    got = lm.score_texts(odd_docs, F.col("doc_id") % 2 == 0).collect()
    assert len(got) == odd_docs.count()
    assert all(math.isfinite(r.score) and r.score < 0 and r.n_tokens >= 1 for r in got)
    none = lm.score_texts(odd_docs, F.lit(False)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in none)
    assert lm.score_texts(no_docs, F.lit(True)).count() == 0


# --- pipeline ------------------------------------------------------------------


def test_pipeline_stages_and_run(spark, sf, store):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, frame = docs.columns, docs
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "simhash near-dedup", "source mixing", "packing"
    ]
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = store(stage(spark, frame, sf).collect(), docs.schema)
        assert frame.columns == columns
        counts.append(frame.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3]
    pieces = corpus_pipeline.run(spark, sf)
    assert set(pieces.columns) >= {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    kept = {r.doc_id for r in frame.select("doc_id").collect()}
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == kept
    coder = packing.WordIds(packing.public_tokenizers.path(packing.TOKENIZER))
    tokens = sum(len(coder(r.text.encode())) for r in frame.select("text").collect())
    assert pieces.agg(F.sum("length")).first()[0] == tokens
