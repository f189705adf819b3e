"""Language identification, source divergence and centroid clusters."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.llm import centroids, divergence, languages

WORDS = {"en": "the and of that with from house river".split(), "de": "der und über größe nicht auf haus fluß".split(), "fr": "le été où avec déjà maison rivière ça".split()}


def _plain_probabilities(net, data):
    """One byte after the other, a segment at a time."""
    soft = lambda x: x / (1 + np.abs(x))
    total, letters = np.zeros(len(net.languages)), 0
    for at in range(0, len(data), languages.SEGMENT):
        part, sides = data[at : at + languages.SEGMENT], []
        for d, order in ((net.forward, range(len(part))), (net.backward, range(len(part) - 1, -1, -1))):
            h, out = np.zeros(d.turn.shape[1]), {}
            for t in order:
                a, g, n = d.enter[:, part[t]], d.turn @ h, len(h)
                z, r = (0.5 + 0.5 * soft(a[k * n : (k + 1) * n] + g[k * n : (k + 1) * n]) for k in (0, 1))
                new = soft(a[2 * n :] + r * (g[2 * n :] + d.inner[:, 0]))
                h = new + z * (h - new)
                out[t] = h
            sides.append(out)
        for t, b in enumerate(part):
            if chr(b).isalpha() and b < 128 or b >= 128:
                e = np.exp(net.out @ np.concatenate((sides[0][t], sides[1][t])) + net.bias[:, 0])
                total, letters = total + e / e.sum(), letters + 1
    return total / max(letters, 1)


def test_network_reads_whole_texts():
    r = random.Random(3)
    net = languages.start(["a", "b", "c"], seed=4)
    texts = [bytes(r.randrange(256) for _ in range(n)) for n in (0, 1, 5, 127, 128, 129, 700)] + [b"... 12", b"x"]
    bounds = np.cumsum([0, *map(len, texts)])
    got = languages.probabilities(net, np.frombuffer(b"".join(texts), np.uint8), bounds)
    assert np.allclose(got, [_plain_probabilities(net, t) for t in texts], atol=1e-4)


def test_gradient_against_differences():
    r = np.random.default_rng(0)
    net = languages.start(["a", "b", "c"], hidden=3)
    for d in (net.forward, net.backward):
        d.enter, d.turn, d.inner = d.enter.astype(float), d.turn.astype(float), r.normal(size=d.inner.shape)
    net.out, net.bias = net.out.astype(float), net.bias.astype(float)
    texts, y = [b"abcde", b"x", b"\xc3\xa9 q7"], np.array([0, 2, 1])
    bounds = np.cumsum([0, *map(len, texts)])
    x = languages.lanes_of(np.frombuffer(b"".join(texts), np.uint8), bounds[:-1], np.diff(bounds))
    _, grads = languages.gradient(net, x, y)
    for v, g in zip(net.parameters(), grads):
        for _ in range(8):
            i = (int(r.integers(v.shape[0])), int(r.choice(x.ravel()) if v.shape[1] == 257 else r.integers(v.shape[1])))
            old, both = v[i], []
            for step in (1e-6, -1e-6):
                v[i] = old + step
                both.append(languages.gradient(net, x, y)[0])
            v[i] = old
            assert abs((both[0] - both[1]) / 2e-6 - g[i]) < 1e-4


def test_languages_of_held_out_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = {r.doc_id: r for r in languages.op11_language_id(spark, small).collect()}
    known = docs.select("doc_id", "lang").where("text IS NOT NULL").collect()
    assert len(rows) == docs.count() and all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    held = [r.lang == rows[r.doc_id].lang_pred for r in known if rows[r.doc_id].held_out]
    assert sum(held) >= 0.95 * len(held) and all(0 <= r.score <= 1 for r in rows.values())


def test_language_edges(spark):
    r = random.Random(1)
    say = lambda lang, n=30: " ".join(r.choices(WORDS[lang], k=n))
    rows = [(i, say(lang), lang, "de") for i, lang in enumerate(list(WORDS) * 40)]
    odd = [(500, None, "en", "x"), (501, "", "en", "x"), (502, "123 --- 4", "en", "x"), (503, say("de", 40_000), None, "x"), (None, say("fr"), "xx", "x"), (504, "我们", None, None), (505, say("en"), None, "x"), (505, say("en"), None, "x")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, lang_pred string")
    net = languages.train(languages.sample(docs), updates=80)
    assert net.languages == ["de", "en", "fr"]
    got = [(x.doc_id, x.held_out, x.lang_pred, x.score) for x in languages.identify(docs, net).collect()]
    assert len(got) == len(rows) + len(odd)
    by = {i: (lang, score) for i, _, lang, score in got}
    assert [by[i] for i in (500, 501, 502)] == [("und", 0.0)] * 3 and by[503][0] == "de" and by[504][0] in WORDS and by[None][0] == "fr" and by[505][0] == "en"
    assert [h for i, h, *_ in got if i is None] == [False] and sum(i == 505 for i, *_ in got) == 2
    assert languages.identify(docs.limit(0), net).count() == 0 and languages.sample(docs.limit(0)) == {}
    nothing = languages.identify(docs, languages.train({})).collect()
    assert {x.lang_pred for x in nothing} == {"und"}
    # Nothing is learned from held-out rows, null ids or null languages.
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 == 2]
    only = spark.createDataFrame([(i, "abc", "zz") for i in held] + [(None, "abc", "yy"), (1, "abc", None)], "doc_id long, text string, lang string")
    assert languages.sample(only) == {}


def _audit(rows):
    fold = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c if "a" <= c <= "z" or ord(c) >= 128 else " " for c in t or "")
    docs = [(lang or "", source or "", fold(text).split(" ")) for lang, source, text in rows]
    docs = [(lang, source, [t for t in terms if t]) for lang, source, terms in docs]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        seen = Counter(t for _, _, terms in mine for t in set(terms))
        kept = sorted(t for t in seen if seen[t] >= 3)
        counts = {s: Counter(t for _, x, terms in mine if x == s for t in terms if seen[t] >= 3) for s in {d[1] for d in mine}}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share(sum(counts.values(), Counter()))
        for s in counts:
            pairs = sorted((-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in counts if o != s)
            terms = sorted((-((p[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t])[:200]
            for part, found in (("pair", pairs), ("term", terms)):
                out |= {(lang, s, part, item.decode(), -v, i) for i, (v, item) in enumerate(found, 1)}
    return out


@pytest.mark.parametrize("shard, wave", [(250_000, 1 << 30), (7, 1)])
def test_divergence(spark, monkeypatch, shard, wave):
    """Against the definition; with shards of a few terms and a wave a round, too."""
    monkeypatch.setattr(divergence, "SHARD", shard)
    monkeypatch.setattr(divergence, "WAVE_BYTES", wave)
    r = random.Random(shard)
    words = ["Tee", "tee", "ÉTÉ", "été", "x", "日本", *[f"w{chr(97 + i)}" for i in range(20)]]
    rows = [(r.choice(["en", "de"]), f"s{r.randrange(6)}", r.choice([" ", "-", "9"]).join(r.choices(words, k=r.randrange(12)))) for _ in range(160)]
    rows += [(None, None, "solo"), (None, "a", None), ("en", "quiet", None), ("en", "quiet", "\x00 12"), ("one", "only", "tee"), ("one", "only", "tee"), ("one", "only", "tee tee"), ("en", "s1", "tee " * 5000)]
    docs = spark.createDataFrame([(*row, 1) for row in rows], "lang string, source string, text string, value int")
    got = [tuple(x) for x in divergence.audit(docs).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got)) and set(got) == _audit(rows)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_shares_of_large_counts():
    counts = np.array([0, 1, 10**12, 4 * 10**15])
    assert divergence.shares(counts, 7 * 10**15).tolist() == [1 + 10**9 * (int(c) + 1) // (7 * 10**15) for c in counts]


def _clusters(rows, k=centroids.CENTROIDS):
    kept = [(i, [math.floor(c) * 256 if abs(c) > 2**53 else math.floor(c * 256) for c in v]) for i, v in rows if v is not None and len(v) == 64 and all(c is not None and math.isfinite(c) for c in v)]
    start = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    c = [v for _, v in start]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, x)), j) for j, x in enumerate(c))
    for _ in range(5):
        of = [near(v)[1] for _, v in kept]
        c = [[sum(col) // len(mine) for col in zip(*mine)] if (mine := [v for (_, v), o in zip(kept, of) if o == j]) else c[j] for j in range(len(c))]
    last = [(i, *near(v)[::-1]) for i, v in kept]
    per = Counter()
    for _, j, d in last:
        per[j] += d
    fits = lambda x: x if x < 2**63 else None
    return Counter((i, j, fits(d), fits(per[j]), fits(sum(per.values())), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, j, d in last)


def test_clusters(spark):
    r = np.random.default_rng(2)
    middles = r.normal(size=(9, 64))
    rows = [(i, (middles[i % 9] + 0.2 * r.normal(size=64)).tolist()) for i in range(400)]
    rows += [(400 + i, [0.25 * (i % 3)] * 64) for i in range(60)] + [(7, rows[7][1]), (7, rows[7][1])]
    bad = [(900, None), (901, [1.0] * 63), (902, [1.0] * 65), (903, [math.nan] + [0.0] * 63), (904, [math.inf] + [0.0] * 63), (905, [None] + [0.0] * 63), (906, [])]
    df = spark.createDataFrame([(*row, 1, 2.0) for row in rows + bad], "vec_id long, embedding array<double>, cluster int, distance double").repartition(5)
    got = centroids.with_inertia(*centroids.cluster(df)).collect()
    assert Counter(map(tuple, got)) == _clusters(rows)
    # Integers beyond an int32 and beyond a long stay exact; distances beyond a long are null.
    huge = rows[:90] + [(950, [1e300] * 64), (951, [-3e306] * 64), (952, [2.0**40 + i for i in range(64)]), (953, [1e6] * 64), (954, [1e6 + 1] * 64)]
    df = spark.createDataFrame(huge, "vec_id long, embedding array<double>")
    assert Counter(map(tuple, centroids.with_inertia(*centroids.cluster(df)).collect())) == _clusters(huge)
    few = df.limit(3)
    assert len(centroids.cluster(few)[1]) == 3 and centroids.with_inertia(*centroids.cluster(df.limit(0))).count() == 0
    assert {x.cluster for x in centroids.cluster(spark.createDataFrame([(None, [1.0] * 64)], "vec_id long, embedding array<double>"))[0].collect()} == {0}
