"""Line dedup, SimHash classes and substring dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from kinfold.llm import lines, simhash, substring
from kinfold.llm.text import Rolling

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, key int, anchor string, component string"


def documents():
    r = random.Random(5)
    say = lambda n: " ".join("".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(n))
    shared, line = say(60), say(12)
    near = line[:5] + "Q" + line[6:]
    texts = [say(r.randint(1, 80)) for _ in range(30)]
    texts += [f"{say(20)} {shared} {say(9)}", f"{shared}\n{shared}", f"{say(3)} {shared[:-3]}", shared, shared]
    texts += [f"{line}\n{say(8)}", f"{near}\n{line}", f"{line[:-1]}\n\nshort\nshort", f"x{near}", "a b c", "A B C", "", None, " \t\n", "α " * 200, say(4000)]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(3, texts[3]), (None, texts[4]), (4, "another text of the same id " + shared)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", None) for i, t in rows], DOCS)


def brute_components(nodes, linked):
    label = {n: n for n in nodes}
    def root(n):
        while label[n] != n:
            n = label[n]
        return n
    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def fingerprint(text, n=3):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark):
    rows = documents()
    found = simhash.near_duplicates(frame(spark, rows)).collect()
    fps = {t: fingerprint(t) for _, t in rows}
    component = brute_components(sorted(set(fps.values())), lambda a, b: bin(a ^ b).count("1") <= 2)
    least = {}
    for i, t in rows:
        c = component[fps[t]]
        least[c] = min([x for x in (least.get(c), i) if x is not None], default=None)
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in found) == Counter((i, fps[t], least[component[fps[t]]]) for i, t in rows)


@pytest.mark.parametrize("near", [0, 200])
def test_links_of_fingerprints(spark, near):
    r = random.Random(near)
    base = r.getrandbits(64)
    fps = {r.getrandbits(64) for _ in range(60)} | {base ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for _ in range(near)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = [(x.a, x.b) for x in simhash.link(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()]
    close = lambda a, b: bin((a ^ b) % 2**64).count("1") <= 2
    have = set(links)
    assert all(close(a, b) or near for a, b in links)
    got = brute_components(sorted(signed), lambda a, b: (a, b) in have or (b, a) in have)
    assert got == brute_components(sorted(signed), close)


def brute_windows(rows, length):
    words = [WORD.findall(t or "") for _, t in rows]
    starts = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (i, _), w in zip(rows, words):
        gone = {k for s in range(len(w) - length + 1) if starts[tuple(w[s : s + length])] > 1 for k in range(s, s + length)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("length,seed", [(35, 12), (5, 3), (2, 2)])
def test_substrings(spark, length, seed):
    rows = documents()
    found = substring.remove_repeats(frame(spark, rows), length=length, seed=seed)
    assert Counter((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in found.collect()) == brute_windows(rows, length)


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("ab€", max_size=14), st.text("ab€", max_size=14), st.integers(1, 3))
def test_banded_distance(a, b, threshold):
    a, b = sorted((a, b), key=len)
    if len(b) - len(a) <= threshold:
        got = int(lines.banded_distance([a], [b], threshold)[0])
        assert got == edit(a, b) if edit(a, b) <= threshold else got > threshold


def test_lines(spark):
    rows = [(i, t) for i, t in documents() if i is not None and len(t or "") < 2000]
    rows = list({i: (i, t) for i, t in rows}.values())
    found = lines.line_classes(lines._keyed(frame(spark, rows), "doc_id", "text")).collect()
    places = [(i, n, s) for i, t in rows for n, s in enumerate((t or "").split("\n")) if len(s) >= lines.MIN_CHARS]
    near = lambda a, b: abs(len(a) - len(b)) <= 2 and edit(a, b) <= 2
    texts = sorted({s for _, _, s in places})
    component = brute_components(texts, near)
    first, links = {}, {s: sum(near(s, o) for o in texts if o != s) for s in texts}
    for i, n, s in places:
        first[component[s]] = min(first.get(component[s], (i, n)), (i, n))
    assert {(r.doc_id, r.line): (tuple(r["first"]), r.n_links, r.kept) for r in found} == {(i, n): (first[component[s]], links[s], first[component[s]] == (i, n)) for i, n, s in places}


@settings(max_examples=300, deadline=None)
@given(st.text("ab€", max_size=14), st.text("ab€", max_size=14), st.integers(0, 3))
def test_furthest_reach(a, b, threshold):
    codes = lambda x: np.frombuffer(x.encode("utf-32-le"), np.uint32)
    assert lines.within(codes(a), codes(b), threshold) == (edit(a, b) <= threshold)


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n)), "".join("ba"[bin(i).count("1") % 2] for i in range(n))


def test_lines_that_collide_in_polynomials(spark):
    """Lines that every polynomial modulo 2**64 takes for equal stay two; so do words and windows of them."""
    a, b = thue_morse(2048)
    whole = lambda x, which: int(Rolling(np.frombuffer(x.encode(), np.uint8), which).of(np.array([0]), np.array([2048]))[0])
    assert whole(a, 1) == whole(b, 1) and whole(a, 2) != whole(b, 2)
    got = {r.doc_id: (r.text, r.n_removed) for r in lines.dedup_lines(frame(spark, [(1, a), (2, b), (3, a)])).collect()}
    assert got == {1: (a, 0), 2: (b, 0), 3: ("", 1)}
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, a), (4, b), (5, a)]
    found = substring.remove_repeats(frame(spark, rows), length=1024, seed=12)
    assert Counter((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in found.collect()) == brute_windows(rows, 1024)


def test_line_edges(spark):
    """Null ids, repeated rows, very long lines and clashing column names."""
    r = random.Random(2)
    long = "".join(r.choice("abcdefgh ") for _ in range(300_000))
    near = long[:5] + "Q" + long[6:250_000] + long[250_001:]
    same = "the very same line of some length"
    rows = [(None, f"{same}\none"), (1, f"{same}\ntwo"), (1, f"{same}\ntwo"), (2, long), (3, near), (4, long[::-1])]
    docs = spark.createDataFrame([(i, t, 7, "g") for i, t in rows], "doc_id long, text string, n_removed int, _gone string")
    found = lines.dedup_lines(docs)
    assert found.columns == ["doc_id", "text", "_gone", "n_removed"]
    want = Counter([(None, f"{same}\none", 0), (1, "two", 1), (1, "two", 1), (2, long, 0), (3, "", 1), (4, long[::-1], 0)])
    assert Counter((r.doc_id, r.text, r.n_removed) for r in found.collect()) == want


def test_substring_column_clash(spark):
    docs = spark.createDataFrame([(1, "a b c", 5, "x", 2, "s")], "doc_id long, text string, N_words int, kept string, n_removed int, _spans string")
    got = substring.remove_repeats(docs)
    assert got.columns == ["doc_id", "text", "_spans", "kept", "n_words", "n_removed"] and tuple(got.first()) == (1, "a b c", "s", "a b c", 3, 0)


def test_lines_are_removed(spark):
    line = "a line that is long enough to count"
    rows = [(1, f"{line}\nsame\nsame"), (2, f"{line}!\nother words\n"), (3, None), (4, "")]
    got = {r.doc_id: (r.text, r.n_removed) for r in lines.dedup_lines(frame(spark, rows)).collect()}
    assert got == {1: (f"{line}\nsame\nsame", 0), 2: ("other words\n", 1), 3: (None, 0), 4: ("", 0)}


def test_short_lines(spark, tmp_path):
    """Equal short lines are one class, near ones aren't; blank lines have none."""
    line = "a line that is long enough to count"
    rows = [(1, f"{line}\nsame\nsame\n \t\n\n}}"), (2, f"sama\n{line}!\n}}\n \t"), (3, "same"), (4, None)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.line): (r.class_doc_id, r.class_line, r.n_links, r.kept) for r in lines.op1_line_dedup(spark, str(tmp_path)).collect()}
    own = {(1, 0): (1, 0, 1, True), (1, 1): (1, 1, 0, True), (1, 5): (1, 5, 0, True), (2, 0): (2, 0, 0, True)}
    assert got == own | {(1, 2): (1, 1, 0, False), (2, 1): (1, 0, 1, False), (2, 2): (1, 5, 0, False), (3, 0): (1, 1, 0, False)}
    kept = {r.doc_id: (r.text, r.n_removed) for r in lines.dedup_lines(frame(spark, rows), short=True).collect()}
    assert kept == {1: (f"{line}\nsame\n \t\n\n}}", 1), 2: ("sama\n \t", 2), 3: ("", 1), 4: (None, 0)}


def test_hot_line_keys(spark):
    """Lines that share a key are dealt out: no task's group holds them all, and no candidate is lost."""
    r = random.Random(9)
    texts = ["a template of one length with a number " + "".join(r.choice("0123456789") for _ in range(r.choice((5, 6)))) for _ in range(600)]
    docs = frame(spark, list(enumerate(texts))).repartition(3)
    hot = lines.hot_keys(docs, 2, 20, hot=50, sample=1)
    assert len(hot[0]) and hot[1].max() >= 4
    plain, dealt = lines.line_keys(docs, 2, 20), lines.line_keys(docs, 2, 20, hot)
    largest = lambda keys: keys.groupBy("key").count().agg({"count": "max"}).first()[0]
    assert largest(dealt) <= 200 < 250 < largest(plain)
    pairs = lambda keys: {(x.a, x.b) for x in lines.candidate_pairs(keys, 2).collect()}
    assert len(pairs(plain)) > 100 and pairs(plain) == pairs(dealt)


@pytest.mark.parametrize("run", [simhash.near_duplicates, substring.remove_repeats, lines.dedup_lines])
def test_empty_table(spark, run):
    assert run(frame(spark, [])).count() == 0
