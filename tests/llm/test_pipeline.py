"""The five stages: each does its whole job on what its predecessor kept."""

import random
from collections import Counter

import corpus_pipeline
from kinfold.llm import alike as similar
from kinfold.llm import quality
from tests.llm.test_text_dedup import WORD, brute_components, brute_windows, edit, fingerprint


def test_stages(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    tables = [docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, small).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if name != "packing":
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        tables.append(docs.collect())
    start, rated, lined, near, cut, packed = tables
    judged = quality.op6_quality_rules(spark, small).where("kept").collect()
    assert sorted(r.doc_id for r in judged) == sorted(r.doc_id for r in rated)
    lines = [s for r in lined for s in r.text.split("\n") if len(s) >= 20]
    assert len(lines) == len(set(lines))
    assert not any(abs(len(a) - len(b)) <= 2 and edit(a, b) <= 2 for i, a in enumerate(sorted(lines)) for b in sorted(lines)[i + 1 : i + 3] if len(a) < 400)
    fps = [fingerprint(r.text, 5) for r in near]
    assert not any(bin(a ^ b).count("1") <= 2 for i, a in enumerate(fps) for b in fps[i + 1 :])
    assert len(near) < len({r.doc_id for r in start})
    want = {i: n - gone for i, n, gone, _ in brute_windows([(r.doc_id, r.text) for r in near], 35)}
    assert {r.doc_id: len(WORD.findall(r.text)) for r in cut} == {i: n for i, n in want.items() if n}
    words = Counter()
    for r in packed:
        words[r.doc_id] += r.n_tokens
    assert words == {i: n for i, n in want.items() if n}


def test_two_chains_at_once(spark, small):
    """Results of one chain stay readable while another runs."""
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(40)
    packed = [corpus_pipeline.pack(spark, docs.limit(n), small) for n in (20, 30)]
    rated = corpus_pipeline.quality_rules(spark, docs, small)
    last = corpus_pipeline.pack(spark, rated, small)
    assert [p.select("doc_id").distinct().count() for p in packed] == [20, 30] and last.count() >= rated.count() > 0


def test_empty_documents(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, small).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.isEmpty()


def test_near_dedup_keeps_a_row_of_each_class(spark):
    """Texts without an id, and texts that share one, are no copies of one another; repeated rows are."""
    say = lambda x: " ".join(f"{x}{i}" for i in range(60))
    rows = [(None, say("a")), (None, say("b")), (None, say("b")), (7, say("c")), (7, say("d")), (7, say("d")), (8, say("d")), (None, say("d")), (9, say("e"))]
    docs = spark.createDataFrame([(i, t, "en", "x", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter([(None, say("a")), (None, say("b")), (7, say("c")), (7, say("d")), (9, say("e"))])


def shingles(text, n=5):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    return {tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set()


def alike(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) >= 0.8 * len(a | b)


def planted():
    """Pairs at similarities about 0.8, and a group of copies of one base whose members aren't all alike."""
    r = random.Random(3)
    say = lambda n: [r.choice("abcdefgh") + str(r.randrange(400)) for _ in range(n)]
    def change(words, k):
        words = list(words)
        for i in r.sample(range(len(words)), k):
            words[i] = f"New{r.randrange(10**6)}"
        return words
    texts = [say(r.randint(1, 120)) for _ in range(20)]
    for k in (1, 2, 3, 4, 5, 6, 7, 8):
        base = say(260)
        texts += [base, change(base, k)]
    base = say(150)
    texts += [change(base, r.randint(0, 3)) for _ in range(60)]
    return [" ".join(x) for x in texts]


def test_near_copies_by_similarity(spark):
    """The classes of 5-word shingles at 0.8 or more are found whole; more of it than two bits of a SimHash find."""
    texts = planted()
    docs = spark.createDataFrame([(i, t, "en", "x", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    fps = [fingerprint(t, 5) for t in texts]
    near = lambda i, j: alike(texts[i], texts[j]) or bin(fps[i] ^ fps[j]).count("1") <= 2
    component = brute_components(range(len(texts)), near)
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == set(component.values())
    hashed = docs.selectExpr("doc_id AS h", "text")
    links = {(r.a, r.b) for r in similar.links(hashed).collect()}
    assert all(alike(texts[a], texts[b]) for a, b in links)
    assert brute_components(range(len(texts)), lambda i, j: (i, j) in links or (j, i) in links) == brute_components(range(len(texts)), lambda i, j: alike(texts[i], texts[j]))
