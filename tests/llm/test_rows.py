"""Chat, top-k, quality, packing, HTML, revisits and SentencePiece."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinfold.llm import chat, html, packing, pieces, quality, registry, topk, warc
from kinfold.storage import stage
from tests.compare import assert_same

CONTROL = st.text(st.sampled_from(["<", "s", ">", "/", "[", "INST", "]", "\\", " ", "[/INST]</s>", "[INST:", "|", "é", "\n"]), max_size=12)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "a] b\\"]), st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", " [/INST]</s>", "[INST:", "\\", "<|", "x", " ", "["]), max_size=8).map("".join)), max_size=5))
def test_chat_round_trip(turns):
    form = chat.Formatter(chat.Template())
    text, spans, _ = form.round_trip(turns)
    assert form.parse(text) == turns
    assert form.loss_text(text, spans) == "".join(t for r, t in turns if r == "assistant")


def test_chat_query(spark, small):
    rows = spark.read.parquet(f"{small}/conversations.parquet").collect()
    said = "</s>[INST] ok [/INST]"
    by = {-7: [(0, "user", said), (1, "assistant", said)]}
    for r in rows:
        by.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    want = set()
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, role, t in turns if role == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.add((conv, len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss)))
    got = registry.queries()["op3_chat_format"](spark, small).collect()
    assert {(r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want
    odd = spark.createDataFrame([(None, None, None, None, 1), (None, None, None, None, 1)], "conv_id long, turn int, role string, text string, formatted int")
    back = chat.read_back(chat.format_conversations(odd)).first()
    assert back.conv_id is None and [tuple(t) for t in back.turns] == [("", ""), ("", "")]
    assert chat.format_conversations(odd.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(name, spark, small, duck):
    assert_same(registry.queries()[name](spark, small), duck, registry.oracle_sql()[name])


def test_top_k_with_ties_and_bad_vectors(spark):
    r = np.random.default_rng(1)
    vectors = [(i, r.integers(-2, 3, 4).astype(float).tolist()) for i in range(700)]
    bad = [(900, None), (1000, [1.0, None]), (1100, [math.nan, 1.0]), (1200, [math.inf]), (None, [1.0]), (300, vectors[300][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in [*vectors, *bad]], "vec_id long, embedding array<double>, rank string")
    got = {(x.query_id, x["rank"], x.vec_id, x.score) for x in topk.top_k(df, F.col("vec_id") % 100 == 0, k=7).collect()}
    want = set()
    q = {i: np.floor(1024 * np.array(v)).astype(int) for i, v in vectors}
    for i in range(0, 700, 100):
        best = sorted(((-int(q[i] @ q[j]), j) for j in q if j != i))[:7]
        want |= {(i, n, j, -s) for n, (s, j) in enumerate(best, 1)}
    assert got == want
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0


def brute_top(rows, k=10):
    """Every row's k best of the rows with other ids, in exact integers."""
    out = []
    for i, q in rows:
        found = sorted((-sum(x * y for x, y in zip(q, d)), j) for j, d in rows if j != i)[:k]
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(found, 1)]
    return Counter(out)


def test_products_are_exact():
    """float64 below 2**53, int64 to 2**63, beyond it an error."""
    big = np.array([[102400000, 1]])
    assert topk.products(big, np.array([[102400000, 3], [102400000, 1]])).tolist() == [[10485760000000003, 10485760000000001]]
    near = np.array([[2**26, 2**25]])
    assert topk.products(near, near)[0, 0] == 2**52 + 2**50 and topk.products(2 * near, 2 * near)[0, 0] == 2**54 + 2**52
    with pytest.raises(OverflowError):
        topk.products(np.array([[2**32]]), np.array([[2**31]]))
    # Large components that meet small ones, or cancel out, are no overflow.
    far = np.array([[2**53, 1], [1, 2]])
    assert topk.products(far, np.array([[3, 2**50], [0, 7]])).tolist() == [[3 * 2**53 + 2**50, 7], [3 + 2**51, 14]]
    assert topk.products(np.array([[2**40, 2**40]]), np.array([[2**30, -(2**30) + 1]])).tolist() == [[2**40]]
    assert topk.bounds(np.array([[2**40, -1]]), np.array([[2**30, 5]]), np.array([[-(2**30), 2]])).tolist() == [[2**63 - 1]]
    assert topk.bounds(np.array([[2**40]]), np.array([[-(2**30)]]), np.array([[-(2**31)]]))[0, 0] >= -(2**63)


def test_top_k_with_a_far_vector(spark):
    rows = [(i, [float(i % 7), float(i % 5)]) for i in range(60)] + [(60, [1e11, 0.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=2).where("rank = 1 AND query_id IN (20, 60)").orderBy("query_id").collect()
    assert [(r.vec_id, r.score) for r in got] == [(60, 6 * 1024 * 10**11 * 1024), (6, 6 * 1024 * 10**11 * 1024)]  # its product with itself is beyond a long


def test_top_k_prunes_clusters(spark, monkeypatch):
    """Clustered vectors: few pairs and blocks are scored, and every answer is brute force's; repeated rows count each."""
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "SHARD_BLOCKS", 2)
    monkeypatch.setattr(topk, "A_PIVOT", 32)
    r = np.random.default_rng(4)
    centres = r.normal(size=(12, 16)) * 4
    vecs = (np.repeat(centres, 50, axis=0) + r.normal(size=(600, 16)) * 0.2).tolist()
    rows = [(i, v) for i, v in enumerate(vecs)] + [(5, vecs[5]), (20, vecs[20]), (700, vecs[33])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows]
    want = Counter({x: n for x, n in brute_top(whole).items() if x[0] % 20 == 0})
    assert Counter(map(tuple, topk.top_k(table, F.col("vec_id") % 20 == 0).collect())) == want
    ints = table.select(F.col("vec_id").alias("key"), topk.quantised(F.col("embedding")).alias("vec"))
    index = stage(topk.build_index(ints, 16, 603), "t")
    asked = ints.where("key % 20 = 0").distinct().selectExpr("xxhash64(key, vec) AS row", "0 AS grp", "key", "vec", "1L AS copies", f"{-2**63 + 1}L AS floor")
    asked = stage(topk.floors(stage(asked, "q"), index, 10), "f")
    shards = index.where("kind = 1").count()
    live = topk.live_pairs(asked, index)
    assert shards > 12 and live.count() < 0.5 * asked.count() * shards
    docs, q = index.where("kind = 0").toPandas(), asked.toPandas()
    docs["block"] += docs["shard"].rank(method="dense").astype(int) * 100
    found, scored = topk.search_blocks(q, docs, 10)
    assert scored < 0.5 * len(q) * docs["block"].nunique() and len(found) == 10 * len(q)


def brute_features(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeat = {k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)}
    kept = [s for s in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    return len(w), sum(map(len, w)), sum(c in quality.SYMBOLS for c in text), len(kept) - len(set(kept)), len(repeat)


def test_quality_query(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = registry.queries()["op6_quality_rules"](spark, small).collect()
    assert len(got) == len(texts)
    for r in got:
        f = brute_features(texts[r.doc_id])
        failed = f[0] < 50 or 100 * f[4] > 50 * f[0]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (*f, failed)
        assert not (failed and r.kept)


def test_quality_verdicts(spark, small):
    """kept, from the cutoffs and brute-force features; in strata by literals and joined, with clashing column names."""
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    rows = spark.createDataFrame([("en", "symbols", 0.01), ("en", "capitals", 0.2), ("de", "shouting", 0.001), (None, "symbols", 0.0)], "stratum string, rule string, cutoff double")
    cut = {(r.stratum, r.rule): r.cutoff for r in rows.collect()}
    def verdict(text, lang):
        f = brute_features(text)
        n = max(f[0], 1)
        share = {"symbols": f[2] / n, "shouting": (text or "").count("!") / n, "capitals": len(regex.findall(r"\p{Lu}", text or "")) / n}
        return f[0] >= 50 and 100 * f[4] <= 50 * f[0] and not any(share[r] > cut.get((lang, r), math.inf) for r in share)
    named = docs.selectExpr("doc_id", "text", "IF(doc_id % 7 = 0, NULL, lang) AS lang", "1 AS n_words", "2 AS _c0", "3 AS _stratum", "4 AS kept")
    want = {r.doc_id: verdict(r.text, r.lang) for r in named.collect()}
    assert 0 < sum(want.values()) < len(want)
    for most in (500, 1):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(quality, "LITERAL_STRATA", most)
            got = quality.judge(named, rows)
            assert {"_c0", "_stratum"} <= set(got.columns) and {r.doc_id: r.kept for r in got.collect()} == want


def test_repeated_rows_certify_nothing(spark, monkeypatch):
    """A good document repeated a thousand times is one document, whether labels are broadcast or joined."""
    rows = [(1, "word " * 60, "en")] * 1000 + [(2, "# " * 90, "en")] * 30
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame([(1, 1), (2, 0)] * 3, "doc_id long, quality int")
    for most in (1_000_000, 0):
        monkeypatch.setattr(quality, "BROADCAST_LABELS", most)
        assert quality.certified_cutoffs(docs, labels).isEmpty()
    many = spark.createDataFrame([(i, "word " * 60 + "#" * (i % 5 == 0) * 80, "en") for i in range(4000)] * 2, "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(4000)], "doc_id long, quality int")
    found = []
    for most in (1_000_000, 0):
        monkeypatch.setattr(quality, "BROADCAST_LABELS", most)
        found.append(sorted(map(tuple, quality.certified_cutoffs(many, marks).collect())))
    assert found[0] == found[1] and 1400 < found[0][0][3] < 1800


def test_every_label_certifies(spark, monkeypatch):
    """More labelled documents in a stratum than any bound of old: all of one half are tested, all of the other choose."""
    n = 130_000
    docs = spark.range(n).selectExpr("id AS doc_id", "if(id % 5 = 0, '## ##', 'a b') AS text", "'en' AS lang")
    labels = spark.range(n).selectExpr("id AS doc_id", "CAST(id % 5 > 0 AS INT) AS quality")
    certify = spark.range(n).where("id % 5 > 0 AND pmod(xxhash64(id, 'split'), 2) = 0").count()
    for most in (1_000_000, 0):
        monkeypatch.setattr(quality, "BROADCAST_LABELS", most)
        assert [tuple(x)[:2] + tuple(x)[3:5] for x in quality.certified_cutoffs(docs, labels).collect()] == [("en", "symbols", certify, 0)]


def test_quality_edges(spark):
    texts = [None, "", "a b c a b c", "x\n x\n\nx\n", "é# " * 40, "a b c d a b c", "a a a a"]
    df = spark.createDataFrame([(i, t, None, 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, rule int")
    for r in quality.features(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_features(texts[r.doc_id])
    labels = spark.createDataFrame([], "doc_id long, quality int")
    judged = quality.judge(df, quality.certified_cutoffs(df, labels))
    assert judged.count() == len(texts) and quality.judge(df.limit(0), quality.certified_cutoffs(df, labels)).count() == 0


def test_binomial_tail(spark):
    cases = [(k, n, p) for n in (1, 30, 400, 5000) for k in (0, 1, 5, 9) if k <= n for p in (0.02,)]
    for k, n, p in cases:
        exact = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))
        got = spark.range(1).select(quality.binomial_tail(F.lit(k), F.lit(n), p).alias("x")).first().x
        assert got == pytest.approx(exact, rel=1e-9) or (k > n * p and got == 1.0)


def test_cutoffs_limit_false_rejection(spark):
    """Held-out good documents of each stratum are rejected by a chosen cutoff about as seldom as promised."""
    r = random.Random(3)
    rows, labels = [], []
    for i in range(6000):
        good = r.random() < 0.7
        marks = 0 if good and r.random() < 0.995 else r.randint(20, 60)
        rows.append((i, " ".join(["word"] * 40 + ["#"] * marks), r.choice("xy")))
        labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    cut = quality.certified_cutoffs(docs, spark.createDataFrame(labels, "doc_id long, quality int")).where("rule = 'symbols'").collect()
    assert {c.stratum for c in cut} == {"x", "y"}
    good = dict(labels)
    for c in cut:
        shares = [t.split().count("#") / len(t.split()) for i, t, s in rows if s == c.stratum and good[i]]
        assert sum(x > c.cutoff for x in shares) / len(shares) <= 0.02 and c.p_value <= 0.1


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 40), st.integers(1, 9), min_size=1, max_size=8), st.integers(1, 4))
def test_boundaries_are_optimal(histogram, buckets):
    from itertools import combinations

    lengths = sorted(histogram)
    cost = lambda edges: sum(c * (min(e for e in edges if e >= n) - n) for n, c in histogram.items())
    best = min(cost([*some, lengths[-1]]) for k in range(min(buckets, len(lengths))) for some in combinations(lengths[:-1], k))
    edges = packing.boundaries(np.array(lengths), np.array([histogram[n] for n in lengths]), buckets)
    assert cost(edges) == best and len(edges) <= buckets


def test_packing_of_rows_without_ids(spark, monkeypatch):
    """Rows without an id are dealt onto slices like others and numbered without gaps."""
    monkeypatch.setattr(packing, "SLICE", 16)
    docs = spark.createDataFrame([(None, "a b c")] * 300 + [(1, None)], "doc_id long, text string")
    got = packing.pack(docs, packing.n_words(F.col("text")), max_tokens=8, buckets=2, token_budget=30).collect()
    threes = sorted((r.batch, r.slot) for r in got if r.n_tokens == 3)
    assert len(got) == 301 and threes == [(i // 10, i % 10) for i in range(300)]


def test_packing(spark):
    lengths = [0, None, 5, 5, 9000, 4096, 4097] + [random.Random(1).randint(1, 300) for _ in range(300)]
    df = spark.createDataFrame([(i, n, "x") for i, n in enumerate(lengths)] + [(2, 5, "x")], "doc_id long, n int, batch string")
    rows = packing.pack(df, F.col("n"), token_budget=8192, buckets=5).collect()
    want = Counter()
    for i, n in [*enumerate(lengths), (2, 5)]:
        want[i] += n or 0
    got = Counter()
    for r in rows:
        got[r.doc_id] += r.n_tokens
        assert r.n_tokens + r.padding == r.boundary
    assert got == want
    per = Counter((r.boundary, r.batch) for r in rows)
    assert all(n * b <= max(8192, b) for (b, _), n in per.items())
    assert len({(r.boundary, r.batch, r.slot) for r in rows}) == len(rows)
    assert packing.pack(df.limit(0), F.col("n")).count() == 0


def test_html_held_out():
    """Pages of other seeds than the training's: nearly all come out word for word."""
    pages = html.labelled_pages(120, seed=99)
    trees = [html.read_page(p, labelled=True) for p in pages]
    want = ["\n".join(text for node, text, _ in t.blocks if t.label[node]) for t in trees]
    got = html.content([p.replace(' data-content="1"', "") for p in pages], html.trained())
    assert sum(a == b for a, b in zip(got, want)) >= 108


#: Pages written by hand, not by the generator of the training pages: html and the blocks wanted.
WRITTEN = [
    ("""<html><head><title>Tide tables</title></head><body><div id="topbar"><a href=/>Home</a> <a href=/news>News</a> <a href=/about>About us</a></div>
    <div class="container"><div class="content-area"><h1>Spring tides reach the quay</h1><p class="byline">By <a href=/a>A. Writer</a></p>
    <p>Water stood two metres above the usual mark on Monday, and the harbour master closed the lower road until noon.</p>
    <p>Nobody was hurt. Repairs to the wall begin next week, the council said, and should last until the end of the month.</p></div>
    <div class="sidebar"><h3>Most read</h3><ul><li><a href=/1>Ferry late again</a></li><li><a href=/2>Market moves</a></li></ul></div></div>
    <div class="footer"><p>All rights reserved</p></div></body></html>""",
     ["Spring tides reach the quay", "Water stood two metres above the usual mark on Monday, and the harbour master closed the lower road until noon.", "Nobody was hurt. Repairs to the wall begin next week, the council said, and should last until the end of the month."]),
    ("""<!DOCTYPE html [<!ENTITY x "y">]><body><nav role=navigation><ul><li><a href=/>Start</a><li><a href=/r>Recipes</a></ul></nav>
    <main><article><header><h1>Barley soup</h1></header><p>Rinse the barley and soak it over night in plenty of cold water.<ul><li>200 g pearl barley</li><li>one leek, sliced</li></ul>
    <p>Boil for forty minutes, then season &amp; serve with bread.</article></main>
    <section id="comments"><h2>2 comments</h2><div class="comment"><p>Made this yesterday, the children loved it very much indeed.</p></div></section>
    <footer><p>Imprint</p></footer></body>""",
     ["Barley soup", "Rinse the barley and soak it over night in plenty of cold water.", "200 g pearl barley", "one leek, sliced", "Boil for forty minutes, then season & serve with bread."]),
    ("""<body><div class="cookie-banner"><p>We use cookies to improve your visit.</p><button>Accept</button></div><svg><svg></svg><text>hidden</text></svg>
    <div class="page"><div class="post"><h2>Notes on slow trains</h2><p>The night train leaves at ten and takes the old line along the river, where it stops at every village.</p>
    <blockquote>Nobody hurries here.</blockquote><p>By morning the mountains are in view and tea is served from a trolley.</p></div>
    <div class="advert">Buy two tickets and get one free</div></div><form class="newsletter"><label>Your address</label><button>Subscribe</button></form></body>""",
     ["Notes on slow trains", "The night train leaves at ten and takes the old line along the river, where it stops at every village.", "Nobody hurries here.", "By morning the mountains are in view and tea is served from a trolley."]),
    ("""<body><header class="site-header"><h1>The Gazette</h1><nav><a href=/>Front page</a></nav></header><div class="article-body"><h1>Library opens on Sundays</h1>
    <p>From May the town library opens its doors on Sundays between ten and four, thanks to volunteers.</p><div data-content="popover text"><p>Returns can be left in the box by the door at any hour of the day.</p></div></div>
    <aside class="related"><h4>Related</h4><a href=/x>Old books sold</a></aside><![foo[x]]><![if IE]><!-- c --></body>""",
     ["Library opens on Sundays", "From May the town library opens its doors on Sundays between ten and four, thanks to volunteers.", "Returns can be left in the box by the door at any hour of the day."]),
    # Pages without containers, tables as layout, line breaks, bare text, single paragraphs.
    ("<body><h1>Frost in May</h1><p>Gardeners in the valley were surprised by a late frost on Thursday night.</p><p>Covering young plants with fleece is the simplest help.</p></body>",
     ["Frost in May", "Gardeners in the valley were surprised by a late frost on Thursday night.", "Covering young plants with fleece is the simplest help."]),
    ("<body><p>The ferry to the island runs twice a day in winter and takes about forty minutes when the sea is calm.</p></body>",
     ["The ferry to the island runs twice a day in winter and takes about forty minutes when the sea is calm."]),
    ("<html><head><title>x</title></head><body>Sourdough needs time more than skill. Mix flour, water and salt in the evening and leave the bowl covered until the morning.<br><br>Bake it hot, with steam, for forty minutes.</body></html>",
     ["Sourdough needs time more than skill. Mix flour, water and salt in the evening and leave the bowl covered until the morning. Bake it hot, with steam, for forty minutes."]),
    ("<body><div><a href=/>Home</a> <a href=/c>Contact</a> <a href=/m>Map</a></div><div><p>Swifts return to the same nest every year, often within a day or two of the same date, after a winter spent over the forests of central Africa without landing once.</p></div></body>",
     ["Swifts return to the same nest every year, often within a day or two of the same date, after a winter spent over the forests of central Africa without landing once."]),
    ("<body><nav><a href=/>Start</a></nav><article><p>The observatory opens its dome to visitors on clear Fridays; warm clothes are advised, for the room isn't heated.</p><button>Share</button></article></body>",
     ["The observatory opens its dome to visitors on clear Fridays; warm clothes are advised, for the room isn't heated."]),
    ("<table><tr><td><a href=/1>News</a><br><a href=/2>Sport</a><br><a href=/3>Weather</a></td><td><h2>Bridge closed for repairs</h2><p>The old stone bridge will be closed to cars from Monday, the district said.</p><p>Cyclists may use the footpath on the northern side.</p></td></tr></table>",
     ["Bridge closed for repairs", "The old stone bridge will be closed to cars from Monday, the district said.", "Cyclists may use the footpath on the northern side."]),
    ("<body><center><a href=/>Index</a> | <a href=/old>Archive</a></center><hr><h1>On sharpening knives</h1>Hold the blade at a low angle and draw it over the stone with even strokes, always from heel to tip.<p>A leather strop takes off the burr.<hr><p>Copyright 2003 by the author</p></body>",
     ["On sharpening knives", "Hold the blade at a low angle and draw it over the stone with even strokes, always from heel to tip.", "A leather strop takes off the burr."]),
    ("<body><main><h1>Council minutes</h1><p>The chair opened the meeting at seven.</p><h2>Roads</h2><p>Potholes in Mill Lane will be filled before winter.</p><ol><li>Grant for the choir: agreed.</li><li>New benches: deferred.</li></ol></main><footer><a href=/imprint>Imprint</a></footer></body>",
     ["Council minutes", "The chair opened the meeting at seven.", "Roads", "Potholes in Mill Lane will be filled before winter.", "Grant for the choir: agreed.", "New benches: deferred."]),
    ("<body><div id=header><h1>Hill Walkers Club</h1></div><div id=menu><ul><li><a href=/a>Walks</a></li><li><a href=/b>Members</a></li></ul></div><div id=main><h2>Autumn programme</h2><p>We meet at the station at nine and share cars to the start of each walk.</p><p>Bring food for the whole day, since there is no inn on the way.</p></div><div id=footer>Page kept by the secretary</div></body>",
     ["Autumn programme", "We meet at the station at nine and share cars to the start of each walk.", "Bring food for the whole day, since there is no inn on the way."]),
    ("<body><section class=story><h1>A second life for sails</h1><p>Old sails become bags in a workshop by the harbour.</p><figure><img src=x><figcaption>Worn cloth waits to be cut.</figcaption></figure><p>Each bag keeps the numbers of the boat that it came from, and buyers like that.</p></section><section class=related><h3>More</h3><a href=/p>Nets into carpets</a><a href=/q>Ropes into mats</a></section></body>",
     ["A second life for sails", "Old sails become bags in a workshop by the harbour.", "Worn cloth waits to be cut.", "Each bag keeps the numbers of the boat that it came from, and buyers like that."]),
    ("<body><div class=wrapper><div class=breadcrumb><a href=/>Home</a> &gt; <a href=/k>Kitchen</a></div><div class=entry><h1>Pickled plums</h1><p>Salt the plums and weigh them down for three weeks.</p><table><tr><th>Plums</th><td>2 kg</td></tr><tr><th>Salt</th><td>300 g</td></tr></table><p>Dry them in the sun for three days before storing them in jars.</p></div><div class=share><a href=#>Send</a> <a href=#>Save</a></div></div></body>",
     ["Pickled plums", "Salt the plums and weigh them down for three weeks.", "Plums", "2 kg", "Salt", "300 g", "Dry them in the sun for three days before storing them in jars."]),
    ("<body><article><h1>Why bells crack</h1><p>Bronze is hard but brittle, and a clapper that always strikes one spot wears it thin.</p><blockquote>Turn a bell every fifty years, founders say.</blockquote><pre>strike note: 440 Hz</pre></article><div class=comments><ol><li><p>Ours was turned in 1950 and still rings well.</p></li><li><p>Great read, thanks!</p></li></ol></div></body>",
     ["Why bells crack", "Bronze is hard but brittle, and a clapper that always strikes one spot wears it thin.", "Turn a bell every fifty years, founders say.", "strike note: 440 Hz"]),
    ("<body><div><div><div><h1>Night buses</h1><p>Lines N1 and N4 run every half hour between midnight and five on weekends.</p><p>A day ticket is valid until the first tram of the morning.</p></div></div></div><div class=popup><p>Subscribe to our letter and never miss a thing.</p><button>Yes</button></div></body>",
     ["Night buses", "Lines N1 and N4 run every half hour between midnight and five on weekends.", "A day ticket is valid until the first tram of the morning."]),
    ("<body><header class=masthead><a href=/>The Sentinel</a></header><div class=content><div class=ad>Shoes at half price, this week only</div><h1>Dry summer, early harvest</h1><p>Farmers began to cut barley two weeks sooner than usual.</p><div class=ad>Rent a van today</div><p>Yields are lower but the grain is of good quality, the cooperative reports.</p></div><aside><h3>Weather</h3><p>Sunny, 31 degrees.</p></aside></body>",
     ["Dry summer, early harvest", "Farmers began to cut barley two weeks sooner than usual.", "Yields are lower but the grain is of good quality, the cooperative reports."]),
    ("<body><ul><li><a href=/1>One</a><li><a href=/2>Two</a><li><a href=/3>Three</a></ul><h1>Learning to row</h1><p>The first lesson is spent on land, where the boat cannot tip.<p>The second lesson is wet.<p>By the fifth most people keep a straight course.<address>Boathouse, Lower Quay</address></body>",
     ["Learning to row", "The first lesson is spent on land, where the boat cannot tip.", "The second lesson is wet.", "By the fifth most people keep a straight course."]),
    ("<body><div class=cookie-notice><p>This site uses cookies.</p></div><main><article class=post><h1>Repairing a clock</h1><p>Let the spring down before you open the case, <a href=/why>for good reasons</a>.</p><p>Clean the pivots with a soft stick and <em>very</em> little oil.</p></article></main><div class=newsletter><form><label>Mail</label><input><button>Go</button></form></div><footer class=site-footer><p>&copy; 2021 Clockwork</p></footer></body>",
     ["Repairing a clock", "Let the spring down before you open the case, for good reasons.", "Clean the pivots with a soft stick and very little oil."]),
]


def test_html_pages_not_from_the_generator():
    """Blocks found of those wanted, and wanted of those found: nine tenths at least."""
    got = [x.split("\n") for x in html.content([p for p, _ in WRITTEN], html.trained())]
    hits = sum(b in g for g, (_, want) in zip(got, WRITTEN) for b in want)
    # Recall and precision of blocks.
    assert hits >= 0.95 * sum(len(want) for _, want in WRITTEN) and hits >= 0.95 * sum(map(len, got)), [(g, want) for g, (_, want) in zip(got, WRITTEN) if g != want]
    assert not any(x in "\n".join(map("\n".join, got)) for x in ("hidden", "]>", "x]]"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(["<![foo[x]]>", "<![CDATA[", "<!DOCTYPE a [", "]>", "<!--", "-->", "<div data-content='a b'>", "<p", "<a href=x><div>", "</a>", "<svg><svg>", "</svg>", "<head>", "<script>", "&#x110000;", "&amp", "<?php", "</", "<td>", "<li>", "<option>", "\0"]), st.text(max_size=6)), max_size=14).map("".join))
def test_html_reads_anything(page):
    html.content([page], html.trained())


def test_html_deep_pages():
    """Depth changes nothing: a block 5,000 elements down keeps its own evidence."""
    deep = "<div>" * 5000 + '<div class="ad">buy now and save</div><article><p>' + "plain words " * 40 + "</p></article>"
    assert html.content([deep], html.trained()) == [("plain words " * 40).strip()]
    tree = html.read_page("<div>" * 5000 + "<ul class=menu><li>x")
    # The root, the elements, and the text as a leaf.
    assert max(tree.depth) == 5003 and len(tree.parent) == 5004


@pytest.mark.parametrize("open_", ["<a ", "<!--", "<![", "</", '<a x="', "<!doctype [>", "<!---->", "<script>", "<", "&", "<a =", "<svg>", "<?", "<p ", "<a x='"])
def test_html_time_is_linear(open_):
    import time

    html.trained()
    page, began = open_ * (1_000_000 // len(open_)), time.process_time()
    html.content([page], html.trained())
    assert time.process_time() - began < 4  # two seconds on an idle machine


def test_html_reads_what_browsers_read():
    read = lambda page: [text for _, text, _ in html.read_page(page).blocks]
    assert read("<p>a < b <3 &lt;i> c") == ["a < b <3 <i> c"] and read("<p title='x>y' a=1/>one</p ><div/>two") == ["one", "two"]
    assert read("x<!-- <p>no</p> --!>y<!>z</>w") == ["xyzw"] and read("a<b c=\"d>e") == ["a"] and read("<title>t<p></title>a<textarea><b>x</textarea>") == ["a", "<b>x"]
    assert read("<script>if (a<b) '</scr'</script>q<style></style>r") == ["qr"] and read('<p a="1"b=\'2\'c>s</P>') == ["s"] and read("") == []


def test_html_messages_are_exact():
    tree = html.read_page("<body><div class=ad>x</div><article><p>one two</p><p>three</p></article></body>")
    f, w = html.forest([tree]), html.trained()
    n = len(f.parent)
    from itertools import product

    total, ones = 0.0, np.zeros(n)
    for y in product((0, 1), repeat=n):
        s = math.exp(sum(y[i] * (f.features[i] @ w.unary) for i in range(n)) + sum(w.pair[f.kind[i], y[f.parent[i]], y[i]] for i in range(n) if f.parent[i] >= 0))
        total += s
        ones += s * np.array(y)
    assert np.allclose(html.sum_product(f, w)[0][:, 1], ones / total)


def test_html_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<article><p>a &amp; b<br>c<p>d  e</article>"), (3, "u", "<div>" * 500 + "<p>deep</p>"), (4, "u", "plain < text &#x41;")]
    got = html.extract(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")).collect()
    assert [r.text for r in got][:3] == ["", "", "a & b c\nd e"] and all(r.n_chars == len(r.text) for r in got)


def test_warc_edges(spark):
    from datetime import datetime as D

    at = lambda m: D(2024, 1, 1, 0, m)
    rows = [
        (1, "response", "HTTP://WWW.a.com:80/x/?b=2&a=1&utm_source=q#f", at(1), "HTTP/1.1 200 OK\r\nETag: W/\"1\"\r\nX-A: s\r\nDate: d1", "p1"), (2, "revisit", "https://a.com/x?a=1&b=2", at(2), "304\r\nETag: \"1\"\r\nX-A: n\r\nDate: d2", None),
        (3, "revisit", "http://a.com/x?a=1&b=2", at(0), "ETag: \"1\"", None), (4, "revisit", None, at(3), "ETag: \"1\"", None), (5, "revisit", "http://a.com/x?b=2&a=1", at(4), None, None), (6, "revisit", "http://a.com/x?b=2&a=1", at(4), "ETag: \"2\"", None), (7, None, "", None, None, None),
    ]
    df = spark.createDataFrame(rows, "record_id long, warc_type string, target_uri string, warc_date timestamp, http_headers string, payload_digest string")
    got = {r.record_id: r for r in warc.resolve_revisits(df).collect()}
    assert [got[i].outcome for i in range(1, 8)] == ["full", "resolved", "no_earlier_response", "no_url", "no_validator", "validator_mismatch", "full"]
    assert (got[2].response_id, got[2].payload_digest, got[2].headers) == (1, "p1", 'date: d2\netag: "1"\nx-a: s')
    assert warc.resolve_revisits(df.limit(0)).count() == 0


def test_pieces_sampling_without_replacement():
    """Against all paths of a short text: distinct paths, exact probabilities, unbiased totals."""
    v = pieces.Vocabulary()
    n, text = 3000, "abcd"
    lattice = pieces.Lattice(v, [text] * n)

    def paths(node, end):
        if node == end:
            return [((), 0.0)]
        return [((a, *rest), lattice.weight[a] + w) for a in range(lattice.out[node], lattice.out[node + 1]) for rest, w in paths(int(lattice.head[a]), end)]

    every = {tuple(lattice.ids[list(p)]): w for p, w in paths(int(lattice.begin[0]), int(lattice.end[0]))}
    z = np.logaddexp.reduce(list(every.values()))
    first, total = Counter(), 0.0
    for rows in pieces.sample(lattice, np.arange(n), 3, seed=1):
        keys = [tuple(lattice.ids[r[0]]) for r in rows]
        assert len(set(keys)) == len(keys) == 3 and [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True)
        assert all(r[1] == pytest.approx(every[k] - z, abs=1e-9) for r, k in zip(rows, keys))
        first[keys[0]] += 1
        total += sum(math.exp(r[1]) / r[3] for r in rows)
    for k, w in every.items():
        p = math.exp(w - z)
        assert abs(first[k] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3
    assert total / n == pytest.approx(1.0, abs=0.08)


def test_pieces_round_trip(spark):
    rows = [(1, "Hello  wörld ▁ 漢😀\n\x00"), (2, ""), (3, None), (None, "a"), (1, "Hello  wörld ▁ 漢😀\n\x00")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, ids int")
    got = pieces.encode_samples(df, k=3)
    assert got.where("NOT round_trip").isEmpty()
    decoded = pieces.decode_ids(got).collect()
    assert {r.decoded for r in decoded if r.key == 1} == {rows[0][1]} and {r.decoded for r in decoded if r.key in (2, 3)} == {""}
    assert len({tuple(r.ids) for r in decoded if r.key == 1}) == 3 and sum(r.key == 1 for r in decoded) == 6
    assert pieces.encode_samples(df.limit(0)).count() == 0
