"""Brute force, round trips and edge cases of the corpus operators, on small fixtures."""

import hashlib
import html as entities
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartolith.llm import chat, decontamination, embeddings, html, minhash, mixing, quality, substrings, suffixes, toxicity
from cartolith.llm import textnp
from cartolith.llm.common import components

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(rnd, n, vocabulary=400):
    return " ".join("".join(rnd.choice(["th", "an", "er", "on", "in", "re", "ed", "ou"]) for _ in range(2 + rnd.randrange(vocabulary) % 3)) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Texts with exact and near copies, shared passages, odd characters, nulls and empties."""
    rnd = random.Random(7)
    texts = [prose(rnd, rnd.randrange(1, 220)) for _ in range(60)]
    passage = prose(rnd, 70)
    for i in range(0, 20, 2):
        w = texts[i].split()
        w.insert(len(w) // 2, passage)
        texts[i] = " ".join(w)
    texts += [texts[3], texts[3], texts[8]]
    for i in (5, 9, 11, 13):  # near copies
        w = texts[i].split()
        for _ in range(max(1, len(w) // 60)):
            w[rnd.randrange(len(w))] = "neu"
        texts.append(" ".join(w))
    texts += [None, None, "", "   ", "eins", "Eins", "éé ñ日本 " * 60, "x" * 700, "ab " * 300, "The the THE " + texts[1]]
    return [(i, t, "en", f"src{i % 5}" if i % 7 else None, None) for i, t in enumerate(texts)]


def no_rows(spark, schema):
    return spark.createDataFrame([], schema)


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(500, k) for k in range(501, 560)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    loops_only = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in parent if x not in loops_only}
    assert components(no_rows(spark, "a bigint, b bigint")).count() == 0


def test_embeddings_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(90, 12))
    x = np.concatenate([base[i % 90 : i % 90 + 1] * rng.uniform(0.5, 2) + rng.normal(size=(1, 12)) * 0.1 * (i >= 90) for i in range(900)])
    rows = [(i, [float(c) for c in v], int(i % 3) if i % 11 else None) for i, v in enumerate(x)]
    rows += [(900 + k, rows[5][1], rows[5][2]) for k in range(40)]
    rows += [(950, None, 1), (951, [], 1), (952, [0.0] * 12, 1), (953, [None] + [1.0] * 11, 1), (954, [float("nan")] + [1.0] * 11, 1), (955, [float("inf")] + [1.0] * 11, 1), (956, [1e300] * 12, 1), (957, [2e300] * 12, 1), (958, [1.0] * 5, 1), (958, [1.0] * 5, 1)]
    across = [[float(j == k) for j in range(12)] for k in range(2)]  # two vectors of one vec_id, each with a partner of its own
    rows += [(970, across[0], 7), (970, across[1], 7), (971, across[0], 7), (972, across[1], 7), (None, across[0], 8)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, label int, component_id string")
    got = [tuple(r) for r in embeddings.near_duplicates(df).collect()]
    fine = lambda v: v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v)
    group = defaultdict(list)
    for n, (i, v, label) in enumerate(rows):
        if fine(v) and label is not None:
            group[label, len(v)].append(n)
    links, parent = Counter(), list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for g in group.values():
        u = embeddings.unit(np.array([rows[n][1] for n in g]))
        for a, b in np.argwhere(np.triu(u @ u.T >= 0.98, 1)):
            links[g[a]] += 1
            links[g[b]] += 1
            p, q = sorted((find(g[a]), find(g[b])))
            parent[q] = p
    low = {}
    for n in range(len(rows)):
        low[find(n)] = min(low.get(find(n), 1 << 60), 1 << 60 if rows[n][0] is None else rows[n][0])
    low = {n: None if x == 1 << 60 else x for n, x in low.items()}
    want = [(rows[n][0], links[n], low[find(n)], None if rows[n][0] is None else rows[n][0] == low[find(n)]) for n in range(len(rows))]
    assert Counter(got) == Counter(want)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def near_sets(rows):
    sets = {}
    for i, t, *_ in rows:
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOW))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    return sets


def near_components(sets, percent):
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in sets}


def test_minhash_brute_force(spark, corpus):
    df = spark.createDataFrame(corpus, DOCS).withColumn("rep", F.lit("clash")).withColumn("component_id", F.lit(3))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(df, percent=85).collect()}
    sets = near_sets(corpus)
    assert got == {i: (len(sets[i]), c, i == c) for i, c in near_components(sets, 85).items()}
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    twice = minhash.near_duplicates(df.where("doc_id < 4").union(df.where("doc_id < 4")))
    assert twice.count() == 8


def test_minhash_rows_that_share_an_id(spark):
    """Each row is compared by its own text; a component is named by the least doc_id of its rows."""
    rnd = random.Random(31)
    base = [prose(rnd, 97) for _ in range(12)]
    changed = lambda t, k: " ".join([*t.split()[:-k], *["neu"] * k])
    rows = [(1, base[0]), (1, base[1]), (2, changed(base[1], 1))]
    rows += [(10 + k % 4, changed(base[k], 1 + k % 2)) for k in range(2, 12)] + [(30 + k % 3, base[k]) for k in range(2, 12)] + [(40, base[0]), (13, base[4]), (13, base[4])]
    sets = near_sets(enumerate(t for _, t in rows))
    part = near_components(sets, 85)
    low = {}
    for n, c in part.items():
        low[c] = min(low.get(c, 1 << 60), rows[n][0])
    want = Counter((rows[n][0], len(sets[n]), low[c], rows[n][0] == low[c]) for n, c in part.items())
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = minhash.near_duplicates(df, percent=85)
    assert Counter(tuple(r)[:4] for r in got.collect()) == want
    assert {r["component_id"] for r in got.where("doc_id = 2").collect()} == {1}


def test_superminhash_estimates():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    b = np.concatenate([a[:300], rng.integers(0, 1 << 62, 100).astype(np.uint64)])
    off = lambda *n: np.concatenate([[0], np.cumsum(n)])
    sig = minhash.superminhash(np.concatenate([a, b, a[:7]]), off(400, 400, 7), 180)
    assert abs((sig[0] == sig[1]).mean() - 300 / 500) < 0.12
    assert np.isfinite(sig).all() and (sig < 180).all()


def test_suffixes_brute_force(spark, corpus):
    """Also with equal rows, rows that share an id or have none, and texts of up to a megabyte."""
    rnd = random.Random(21)
    long = prose(rnd, 130_000, 4000)
    mixed = corpus[1][1] + corpus[7][1][:230] + corpus[9][1][-260:]
    rows = [(r[0], r[1]) for r in corpus] + [(1, corpus[1][1]), (1, mixed), (None, corpus[7][1]), (None, "q" * 10 + corpus[7][1]), (None, None), (3, corpus[3][1])]
    rows += [(900, long), (901, long[500_000:500_900] + corpus[11][1]), (902, prose(rnd, 60) + long[-420:])]
    # windows that differ in one byte at every place
    base = prose(rnd, 90)
    rows += [(1000 + k, base[:k] + "#" + base[k + 1 :]) for k in range(0, len(base), 23)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("h", F.lit(1)).withColumn("lo", F.lit("x")).withColumn("k1", F.lit(None).cast("string"))
    got = Counter(tuple(r)[:5] for r in suffixes.remove_repeats(df).collect())
    raw = [(t or "").encode() for _, t in rows]
    count = Counter(hash(b[p : p + 200]) for b in raw for p in range(len(b) - 199))
    want = Counter()
    for (i, _), b in zip(rows, raw):
        gone = bytearray(len(b))
        for p in range(len(b) - 199):
            if count[hash(b[p : p + 200])] > 1:
                gone[p : p + 200] = b"\1" * 200
        kept = bytes(c for c, g in zip(b, gone) if not g)
        want[i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()] += 1
    assert got == want
    assert suffixes.remove_repeats(df.limit(0)).count() == 0
    assert suffixes.levels(200) == [(32, 32, [0, 64, 72, 136]), (64, 64, [0, 72]), (128, 72, [0])]


def test_substring_dedup(spark, corpus):
    df = spark.createDataFrame(corpus, DOCS).withColumn("first", F.lit(1)).withColumn("start", F.lit("x"))
    out = {r["doc_id"]: r for r in substrings.substring_dedup(df).collect()}
    assert len(out) == len(corpus)
    passage = corpus[0][1].split()
    text = {i: t for i, t, *_ in corpus}
    # the planted passage stays once and goes from the others, those with longer copies included
    middle = " ".join(passage[len(passage) // 2 - 10 : len(passage) // 2 + 10])
    assert sum(middle in (t or "") for t in text.values()) > 5
    assert sum(middle in (r["text"] or "") for r in out.values()) == 1
    assert all(out[i]["__n_removed"] > 0 for i in range(2, 20, 2)) and out[0]["__n_removed"] == 0
    # copies lose their text, clean documents none; spans tell what is gone
    assert out[60]["__n_removed"] >= 0.5 * len(text[60].encode()) or len(text[60]) < 240
    for i in (1, 7, 21, 33):
        assert out[i]["text"] == text[i]
    for i, r in out.items():
        raw, p, kept = (text[i] or "").encode(), 0, b""
        for s in r["__spans"]:
            kept, p = kept + raw[p : s["start"]], s["end"]
        assert (kept + raw[p:]).decode() == (r["text"] or "") and r["__n_bytes"] == len(raw)
    assert out[67]["text"] is None
    assert substrings.substring_dedup(df.limit(0)).count() == 0


def test_substring_dedup_brute_force(spark, corpus):
    """What goes holds every word of a 51-word passage that an earlier document has; all of it lies in strings that occur earlier."""
    rnd = random.Random(31)
    long = prose(rnd, 40_000, 4000)
    rows = [(r[0], r[1]) for r in corpus] + [(900, long), (901, prose(rnd, 30) + " " + long[100_000:103_000] + " " + prose(rnd, 30)), (60, corpus[7][1]), (None, corpus[0][1]), (1, corpus[1][1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("__n_removed", F.lit("x"))
    out = [(r["doc_id"], r["text"], [(s["start"], s["end"]) for s in r["__spans"]]) for r in substrings.substring_dedup(df).collect()]
    assert len(out) == len(rows)
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append((t or "").encode())
    first: dict[bytes, int] = {}
    words = lambda b: [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0d]+", b)]
    for i, t in sorted((x for x in rows if x[0] is not None), key=lambda x: x[0]):
        b = (t or "").encode()
        w = words(b)
        for k in range(len(w) - 50):
            first.setdefault(b[w[k][0] : w[k + 50][1]], i)
    spans = {}
    for i, t, gone in out:
        b = next(x for x in texts[i] if len(x) == len((t or "").encode()) + sum(e - s for s, e in gone))
        spans.setdefault((i, b), gone)
    for (i, b), gone in spans.items():
        cut = bytearray(len(b))
        for s, e in gone:
            cut[s:e] = b"\1" * (e - s)
        if i is None:
            assert not gone
            continue
        w = words(b)
        for k in range(len(w) - 50):
            s, e = w[k][0], w[k + 50][1]
            if first[b[s:e]] < i:
                assert all(cut[s:e]), (i, s, e)
        earlier = [x for j, xs in texts.items() if j is not None and j <= i for x in xs if j < i or x == b]
        for s, e in gone:
            for p in range(s, e, 29):  # any stretch of 60 bytes of it occurs before
                q = min(p, e - 60) if e - s >= 60 else s
                assert any(0 <= x.find(b[q : min(q + 60, e)]) and (x is not b or x.find(b[q : min(q + 60, e)]) < q) for x in earlier), (i, s, e)


def test_substring_dedup_short_words(spark):
    """Each of 300 passages of 51 to 60 short words goes whole from its second document, and nothing else goes."""
    rnd = random.Random(12)
    words = lambda n, longest: " ".join("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randrange(1, longest + 1))) for _ in range(n))
    rows, planted = [], {}
    for i in range(300):
        passage = words(51 + i % 10, 1 + i % 6)
        ends = [words(rnd.randrange(1, 40), 9) for _ in range(4)]
        rows += [(i, f"{ends[0]} {passage} {ends[1]}", "en", "a", None), (1000 + i, f"{ends[2]} {passage} {ends[3]}", "en", "a", None)]
        planted[1000 + i] = [*ends[2:], passage]
    rows += [(5000, "ab " * 300, "en", "a", None), (5001, words(50, 4), "en", "a", None)]
    text = {i: t for i, t, *_ in rows}
    out = {r["doc_id"]: r["text"] for r in substrings.substring_dedup(spark.createDataFrame(rows, DOCS)).collect()}
    missed = [i for i, (a, b, passage) in planted.items() if out[i].split() != f"{a} {b}".split()]
    assert missed == []
    assert [i for i in [*range(300), 5001] if out[i] != text[i]] == []
    assert len(out[5000].split()) >= 51


def test_chunks_resist_insertion():
    rnd = random.Random(2)
    one = prose(rnd, 400).encode()
    two = b"an insertion at the start " + one
    cut = lambda b: {b[s:e] for s, e, _ in zip(*substrings.chunks(np.frombuffer(b, np.uint8), np.array([0, len(b)])))}
    assert len(cut(one) & cut(two)) >= len(cut(one)) - 2
    start, end, _ = substrings.chunks(np.frombuffer(one, np.uint8), np.array([0, len(one)]))
    assert start[0] == 0 and end[-1] == len(one) and (start[1:] == end[:-1]).all()


def test_decontamination(spark, corpus):
    items = [(1, " ".join(corpus[4][1].split()[:25])), (10, "Eins"), (2, None), (3, "..."), (4, "nowhere to be found in any of these texts at all really"), (5, " ".join(corpus[4][1].split()[5:17]).upper())]
    df = spark.createDataFrame([*corpus, corpus[4]], DOCS).withColumn("words", F.lit(1)).withColumn("items", F.lit("x"))
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(sorted(r["items"]))) for r in decontamination.decontaminate(df, spark.createDataFrame(items, "item_id bigint, text string")).collect())
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    want = Counter()
    for i, t, *_ in [*corpus, corpus[4]]:
        w, hit, found = words(t), set(), set()
        for item, it in items:
            x = words(it)
            n = min(10, len(x))
            for a in range(len(x) - n + 1) if n else ():
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == x[a : a + n]:
                        hit |= set(range(p, p + n))
                        found.add(item)
        want[i, len(w), len(hit), tuple(sorted(found))] += 1
    assert got == want
    clean = {r["doc_id"] for r in decontamination.clean_documents(df, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert clean == {i for i, _, hit, _ in want if not hit}
    sliced = decontamination.decontaminate(df, spark.createDataFrame(items, "item_id bigint, text string"), slice_bytes=500)
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(sorted(r["items"]))) for r in sliced.collect()) == want
    none = no_rows(spark, "item_id bigint, text string")
    assert decontamination.decontaminate(df, none).where("n_hit > 0").count() == 0
    assert decontamination.decontaminate(df.limit(0), none).count() == 0


def test_mixing_ties_go_by_text(spark):
    """Rows that share doc_id, source and size are dealt their copies by their texts, whatever the order of rows."""
    rows = [(7, f"w{i} " * 5, "a") for i in range(30)] + [(None, f"v{i} " * 5, "a") for i in range(30)] + [(9, "z " * 900, "b")]
    one = mixing.mix_sources(spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(1))
    two = mixing.mix_sources(spark.createDataFrame(rows[::-1], "doc_id bigint, text string, source string").repartition(7))
    of = lambda df: {r["text"]: r["copies"] for r in df.collect()}
    assert of(one) == of(two) and len(set(of(one).values())) > 1


def test_mixing_tells_when_the_dual_is_not_met(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STEPS", 2)
    rows = [(i, "w " * (1 + i % 17), "abc"[i % 3]) for i in range(60)]
    with pytest.raises(RuntimeError):
        mixing.mix_sources(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))


def test_mixing(spark, corpus):
    rows = [(i, t, lang, s, n) for i, t, lang, s, n in corpus] + [(200 + i, prose(random.Random(i), 40), "en", "big", None) for i in range(60)]
    df = spark.createDataFrame([*rows, rows[0]], DOCS).withColumn("size", F.lit("x")).withColumn("target", F.lit(1)).withColumn("idx", F.lit(1))
    out = mixing.mix_sources(df).collect()
    assert len(out) == len(rows) + 1
    size = defaultdict(int)
    for i, t, _, s, _ in [*rows, rows[0]]:
        size[s] += len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight, target, open_ = {s: k % 3 + 1 for k, s in enumerate(names)}, {}, set(names)
    left = sum(size.values())
    while True:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * size[s]}
        if not over:
            break
        for s in over:
            target[s] = 3.0 * size[s]
            left -= target[s]
        open_ -= over
    target |= {s: level * weight[s] for s in open_}
    taken = defaultdict(int)
    for r in out:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["taken"] <= 3 * r["size"] and r["source_size"] == size[r["source"]]
        taken[r["source"]] += r["taken"]
    for s in names:
        assert abs(taken[s] - target[s]) <= max(0.02 * target[s], 1 + min((r["size"] for r in out if r["source"] == s and r["size"]), default=0) / 2), s
        rates = {r["size"]: r["rate"] for r in out if r["source"] == s and 0 < r["rate"] < 3}
        tilt = {round(math.log(r) / z, 6) for z, r in rates.items()}  # rates are exp(lambda * size), alike per size
        assert max(tilt, default=0) - min(tilt, default=0) <= 1e-5 and (len(rates) < 3 or target[s] == size[s] or len(set(rates.values())) > 2)
    assert sorted(out, key=str) == sorted(mixing.mix_sources(df.repartition(7)).collect(), key=str)
    assert mixing.mix_sources(df.limit(0)).count() == 0
    assert {r["taken"] for r in mixing.mix_sources(df.where("text is null")).collect()} == {0}


def test_quality(spark):
    rnd = random.Random(4)
    good = [prose(rnd, rnd.randrange(5, 200)) for _ in range(120)]
    junk = [" ".join(w + rnd.choice(["%%%", "$$$", "###"]) for w in prose(rnd, 80).split()) for _ in range(20)] + [" | ".join(prose(rnd, 60).split()) for _ in range(20)]
    rows = [(i, t, "en", "a" if i % 3 else "b", None) for i, t in enumerate(good + junk)] + [(900, None, None, None, None), (901, "", "de", "c", None)]
    labels = [(i, int(i < len(good)), 0) for i in range(0, len(good + junk), 2)] + [(None, 1, 0), (5, None, 0), (5000, 1, 0)]
    df = spark.createDataFrame(rows, DOCS).withColumn("n", F.lit(1)).withColumn("root", F.lit(1))
    got = {r["doc_id"]: r for r in quality.classify(df, spark.createDataFrame(labels, LABELS)).collect()}
    assert len(got) == len(rows)
    assert sum((got[i]["__quality"] >= 0.5) == (i < len(good)) for i in range(len(good + junk))) >= 0.97 * len(good + junk)
    assert all(0 <= r["__quality"] <= 1 for r in got.values())
    # labels of one half of the documents, judged on the other
    half = [x for x in labels if x[0] is not None and x[0] % 4 == 0]
    held = {r["doc_id"]: r["__quality"] for r in quality.classify(df, spark.createDataFrame(half, LABELS)).collect()}
    others = [i for i in range(len(good + junk)) if i % 4]
    assert sum((held[i] >= 0.5) == (i < len(good)) for i in others) >= 0.95 * len(others)
    # rates by plain arithmetic: shrunk path rate, then the posterior
    for r in got.values():
        rate = min(max(r["__path_rate"], 1e-6), 1 - 1e-6)
        assert r["__quality"] == pytest.approx(1 / (1 + math.exp(-(r["__evidence"] + math.log(rate / (1 - rate))))), abs=1e-9)
    # shrinkage: the host of one document stays near the global rate
    assert abs(got[901]["__host_rate"] - got[1]["__host_rate"]) < 0.5
    none = no_rows(spark, LABELS)
    assert quality.classify(df, none).count() == len(rows)
    assert quality.classify(df.limit(0), none).count() == 0


def test_quality_rates_brute_force(spark):
    """Moments, strengths and shrunk rates by plain arithmetic, for sites of many sizes, null ones among them."""
    rnd = random.Random(14)
    rows = []
    for h in [None, *"abcdefghij"]:
        lean = rnd.uniform(-3, 3)
        for p in [None, "x", "y", "z"][: rnd.randrange(1, 5)]:
            rows += [(h, p, rnd.gauss(lean + (p == "y"), 2) * (50 if rnd.random() < 0.02 else 1)) for _ in range(rnd.choice([1, 2, 30, 200]))]
    df = spark.createDataFrame(rows, "source string, lang string, __evidence double")
    got = {(r["__host"], r["__path"]): (r["__host_rate"], r["__rate"]) for r in quality.site_rates(df, "source", "lang").collect()}
    n, good = Counter(), Counter()
    for h, p, e in rows:
        n[h, p] += 1
        good[h, p] += 1 / (1 + math.exp(-min(max(e, -30), 30)))

    def strength(sites):
        """(n, good, parent rate) of sites: the prior's strength from within and between variance."""
        inner = [q * (1 - q) for _, _, q in sites]
        between = (sum(m * (g / m - q) ** 2 for m, g, q in sites) - sum(inner)) / sum(m for m, _, _ in sites)
        return min(max(sum(inner) / len(inner) / max(between, 1e-9) - 1, 1.0), 1e6)

    hosts = {h: (sum(v for k, v in n.items() if k[0] == h), sum(v for k, v in good.items() if k[0] == h)) for h, _ in n}
    root = sum(g for _, g in hosts.values()) / sum(m for m, _ in hosts.values())
    k = strength([(m, g, root) for m, g in hosts.values()])
    host = {h: (g + k * root) / (m + k) for h, (m, g) in hosts.items()}
    k = strength([(n[s], good[s], host[s[0]]) for s in n])
    want = {s: (host[s[0]], (good[s] + k * host[s[0]]) / (n[s] + k)) for s in n}
    assert set(got) == set(want) and all(got[s] == pytest.approx(want[s], abs=1e-9) for s in want)


def test_quality_measures_brute_force():
    """Each measure of a text by a plain count over its bytes and words."""
    rnd = random.Random(15)
    rng = np.random.default_rng(15)
    odds = rng.normal(size=quality.BINS)
    texts = ["", "A", "Ab cd Ab", "x | y | z ||", "1 22 333 ab$$ cd%% e$$", "éÉ ñ", "the the the cat", "TAB\tand\nline", *(" ".join(rnd.choice(["Foo", "bar", "b|z", "q9", "z##", "é"]) for _ in range(rnd.randrange(90))) for _ in range(40))]
    raw = [t.encode() for t in texts]
    offs = np.cumsum([0, *map(len, raw)])
    got = quality.measures(np.frombuffer(b"".join(raw), np.uint8), offs, odds)
    symbols = b"#$%&*!@^~+=<>{}[]\\_"

    def bin_of(w):
        b = np.frombuffer(w.lower(), np.uint8)
        return int(quality.bins_of(textnp.Quick(textnp.codes(21, lower=True)[b]).of(np.array([0]), np.array([len(b)])))[0])

    for b, row in zip(raw, got, strict=True):
        w, size = b.split(), max(len(b), 1)
        of = max(len(w), 1)
        upper = sum(65 <= x < 91 for x in b)
        letters = upper + sum(97 <= x < 123 or x >= 128 for x in b)
        mark = lambda x: len(x) >= 3 and x[-1] in symbols and x[-2] in symbols
        want = [math.log1p(len(b)) / 12, upper / max(letters, 1), sum(x in symbols for x in b) / size, b.count(b"|") / of, sum(48 <= x < 58 for x in b) / size]
        want += [sum(p.lower() == q.lower() for p, q in zip(w, w[1:])) / of, sum(map(mark, w)) / of, min(sum(map(len, w)) / of / 20, 2), len({x.lower() for x in w}) / of, sum(odds[bin_of(x)] for x in w) / of]
        assert row == pytest.approx(want, abs=1e-9), b


def test_toxicity_decoder():
    counts = np.zeros((64, 64, 64))
    for w in ["idiot", "stupid", "loser", "moron", "the", "then", "other"] * 50:
        code = [0, 0, *map(toxicity.letter, w), 0]
        for a, b, c in zip(code, code[1:], code[2:]):
            counts[a, b, c] += 1
    d = toxicity.Decoder(toxicity.language_model(counts.reshape(-1)))
    for token in ["1d10t", "id!ot", "i*iot", "IDIOT!!!".lower(), "s.t.u.p.i.d", "$tupid", "stuuuupid", "l0$er", "m0r0n$$$", "looooser", "m-o-r-o-n"]:
        assert {"idiot", "stupid", "loser", "moron"} & set(d.restore(token)), token
    assert "stupid" in d.restore("stuupid") and "idiot" in d.restore("iddiot") and "stupid" in d.restore("st**id")
    assert d.restore("then,") == ["then"] and d.restore("1234") == ["1234"] and d.restore("") == [""]
    assert toxicity.spaced("a i d i o t is".split()) == ["aidiot"]


def test_toxicity_viterbi_brute_force():
    """The decoded word has the least cost of all readings of its lattice; long tokens take time in proportion."""
    rnd = random.Random(3)
    counts = np.zeros((64, 64, 64))
    for w in ["idiot", "stupid", "loser", "moron", "slime", "tools"] * 9:
        code = [0, 0, *map(toxicity.letter, w), 0]
        for a, b, c in zip(code, code[1:], code[2:]):
            counts[a, b, c] += rnd.randrange(1, 4)
    cost = toxicity.language_model(counts.reshape(-1))
    d = toxicity.Decoder(cost)

    def price(word):
        code = [0, 0, *map(toxicity.letter, word), 0]
        return sum(cost[x] for x in zip(code, code[1:], code[2:]))

    def readings(token, before="", word="", spent=0.0):
        if not token:
            yield spent + price(word), word
            return
        c = token[0]
        like = toxicity.LOOKS_LIKE.get(c)
        options = [(c, 0.0)] + [("", toxicity.REPEAT)] * (c == before) if c.isalpha() else [(x, toxicity.IMITATED if len(like) < 3 else toxicity.WILD) for x in like or ""]
        if not c.isalpha():
            options.append(("", toxicity.NO_DIGIT if c.isdigit() else toxicity.NO_SYMBOL if like else toxicity.NO_MARK))
        for x, extra in options:
            if not (x and x == c and word[-2:] == x + x):
                yield from readings(token[1:], c, word + x, spent + extra)

    for token in ["1d10t", "st*p1d", "s.t.u|p", "m0r*n", "l00s3r", "s|1m3", "iddi*t", "t00o1s", "*lim3"]:
        best = min(readings(token))
        got = d.viterbi(token)[0]
        assert min(x for x, w in readings(token) if w == got) == pytest.approx(best[0]), token
    begin = time.time()
    assert any("idiot" in w for w in d.restore("1d10t." * 20_000)) and d.restore("x" * 100_000)
    assert time.time() - begin < 30


def test_toxicity_held_out(spark):
    rnd = random.Random(5)
    rows, labels = [], []
    for i in range(900):
        w, toxic = prose(rnd, rnd.randrange(20, 90)).split(), i % 4 == 0
        for _ in range(rnd.randrange(2, 6) if toxic else 0):
            w[rnd.randrange(len(w))] = rnd.choice(["idiot", "stupid", "loser", "st0pid", "1diot", "l o s e r", "stuuupid"])
        rows.append((i, " ".join(w), "en", "a", None))
        labels.append((i, 1, int(toxic)))
    rows += [(2000, None, None, None, None), (2001, "", None, None, None), (2002, prose(rnd, 30) + " i d i o t and l0ser", None, None, None)]
    df = spark.createDataFrame(rows, DOCS).withColumn("toxic", F.lit(1)).withColumn("score", F.lit("x"))
    got = {r["doc_id"]: r for r in toxicity.score_documents(df, spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None)], LABELS)).collect()}
    held = [i for i in range(900) if got[i]["held_out"]]
    assert 200 < len(held) < 400
    assert sum(got[i]["predicted"] == labels[i][2] for i in held) >= 0.97 * len(held)
    toxic = [i for i in held if labels[i][2]]
    assert sum(got[i]["predicted"] for i in toxic) >= 0.9 * len(toxic)
    assert got[2000]["score"] == got[2001]["score"] < 0.5 and got[2002]["predicted"] == 1
    none = no_rows(spark, LABELS)
    assert {r["score"] for r in toxicity.score_documents(df.limit(3), none).collect()} == {0.0}
    assert toxicity.score_documents(df.limit(0), none).count() == 0


PAGE = (
    "<!DOCTYPE html><html><head><title>no</title><script>var t='</p>';</script></head><body><header><h1>Site</h1></header><nav><ul><li>menu</ul></nav>"
    "<div class='cookie-notice'>We use cookies</div>{body}<div id=comments><p>first!</div><form><input name=a><button>go</button></form><footer>&copy; x</footer></body></html>"
)


def test_html_rules():
    page = PAGE.format(body="<article><h1>A&amp;B\n title</h1><p>one <b>two<br>three<p>four&nbsp;&eacute;&#x41; <a title='a>b' href=x>five</a><ul><li>six<li>seven</ul><div class='advert'>buy</div><!-- c --><pre> eight\n\t nine </pre></article>")
    assert html.extract(page) == "A&B title\n\none two three\n\nfour éA five\n\nsix\n\nseven\n\neight nine"
    assert html.extract("") == "" and html.extract("plain &lt; text <br") == "plain < text" and html.extract("<p>cut <b>of") == "cut of"
    assert html.extract("<style>p{}</style><p>a</p><script>x") == "a" and html.extract("a < b <> c") == "a < b <> c"
    assert html.extract(PAGE.format(body="<p>x</p>")) == "x"


def test_html_style_tree(spark):
    rnd = random.Random(6)
    pages = [(i, f"https://h.example/{i}", PAGE.format(body=f"<div class='x1'>same words on all pages</div><div class='x2'><p>{prose(rnd, 12)}</p></div>")) for i in range(40)]
    pages += [(100, None, None), (101, "odd", ""), (102, "https://one.example/", PAGE.format(body="<div class='x1'>same words on all pages</div>"))]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("host", F.lit(1)).withColumn("low", F.lit(1))
    got = {r["page_id"]: r["text"] for r in html.extract_pages(df).collect()}
    for i in range(40):
        assert got[i] == re.search(r"<div class='x2'><p>(.*?)</p>", pages[i][2])[1]
    assert got[100] == got[101] == "" and got[102] == "same words on all pages"
    assert html.extract_pages(df.limit(0)).count() == 0


def test_html_copies(spark):
    """Copies of one page on a host, alone or beside others, lose no text, nor does an article in a shared wrapper."""
    page = lambda x: f"<body><div><p>{x}</p></div></body>"
    inner = lambda x, k: f"<body><p>{k}</p><div class='w'><article><p>{x}</p></article></div></body>"
    rows = [(i, "https://a.example/", page("one text")) for i in range(8)]
    rows += [(100 + i, "https://b.example/", page("one text")) for i in range(30)] + [(200 + i, "https://b.example/", page(f"text {i}")) for i in range(6)]
    rows += [(300 + i, "https://c.example/", inner("copy", i)) for i in range(30)] + [(400, "https://c.example/", inner("own", 99))]
    got = {r["page_id"]: r["text"] for r in html.extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {i: "copy" if 300 <= i < 400 else "own" if i == 400 else re.search("<p>(.*?)</p>", h)[1] for i, _, h in rows}


def test_html_names_are_hints():
    page = lambda x: f"<body><main><article><h1>T</h1><p>one two</p>{x}</article></main></body>"
    for x, said in [
        ("<h2 id='social-impact'>Impact</h2>", "Impact"), ("<h2 id=related-work>Work</h2>", "Work"), ("<div class='post-header'><h1>head</h1></div>", "head"),
        ("<p class='notice-of-death'>died</p>", "died"), ("<table class='menu-prices'><tr><td>nine</td></tr></table>", "nine"), ("<div class='sponsored'>buy</div>", ""),
        ("<article class='comment'>first</article>", ""), ("<section id=comments><article><p>a long comment, longer than all the rest of it</p></article></section>", ""),
        ("<p>see <span hidden>not</span>this<button>press</button></p>", "see this"),
    ]:
        assert html.extract(page(x)) == "T\n\none two" + (f"\n\n{said}" if said else ""), x
    assert html.extract("<body><form><article><p>text</p></article><input></form></body>") == "text"
    assert html.extract("<body><form><div><p>all the text of a page</p></div></form></body>") == "all the text of a page"
    assert html.extract(f"<body><article><p>teaser</p></article><div><p>{'long text ' * 30}</p></div></body>").startswith("teaser\n\nlong text")
    for x, said in [("<p class='notice'>mind the gap</p>", "mind the gap"), ("<section id='navigation'><h2>Ways</h2><p>by sea</p></section>", "Ways\n\nby sea"), ("<section><h3>3 comments</h3><p>first!</p></section>", ""), ("<div><h4>Kommentare (2)</h4><p>erster</p></div>", ""), ("<section><h3>On comments</h3><p>they matter</p></section>", "On comments\n\nthey matter")]:
        assert html.extract(page(x)) == "T\n\none two" + (f"\n\n{said}" if said else ""), x
    began = time.process_time()
    deep = "<div>" * 20_000 + "deep" + "</div>" * 20_000 + "</section>" * 20_000
    assert html.extract(deep) == "deep" and html.extract("<b>" * 20_000 + "<li>x</em>" * 2_000).count("x") == 2_000
    assert time.process_time() - began < 4
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    assert html.extract(deep) == "deep" and html.extract("<p>" + "word " * 200_000).count("word") == 200_000


def test_html_the_tree_overrules_names(spark):
    """Where a host has pages enough, what differs from page to page stays, whatever its class; comments and adverts go."""
    rnd = random.Random(12)
    page = lambda said, more: f"<body><article><h1>{prose(rnd, 3)}</h1><p>{prose(rnd, 60)}</p><section class='share'><p>{said}</p></section><div class='widget'>the same</div>{more}</article></body>"
    said = [prose(rnd, 12) for _ in range(30)]
    rows = [(i, "https://s.example/", page(x, f"<div class='advert'>{prose(rnd, 5)}</div><section class='comments'><p>{prose(rnd, 30)}</p></section>")) for i, x in enumerate(said)]
    rows += [(100, "https://few.example/", page("share this", ""))]
    got = {r["page_id"]: r["text"] for r in html.extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for i, x in enumerate(said):
        assert got[i].split("\n\n")[2:] == [x]
    assert got[100].count("\n\n") == 1


def test_html_tree_brute_force(spark):
    """Unnamed furniture and slots go by the tree alone, in articles and beside them; the tree is that of a plain count."""
    rnd = random.Random(9)
    own = [prose(rnd, 25 + i % 40) for i in range(40)]
    body = lambda i, x: f"<div class='qq{i + 100}'>{prose(rnd, 4)}</div><article><h1>{prose(rnd, 3)}</h1><p>{x}</p><div class='zz'>buy <b>this</b> now</div></article>"
    plain = lambda i, x: f"<div class='q{i + 100}'><div class='u'>{prose(rnd, 3)}</div><div class='v'><p>{x}</p>{'<ul><li>a b</ul>' * (i % 2)}</div></div>"
    rows = [(i, "https://d.example/", f"<body>{body(i, x)}</body>") for i, x in enumerate(own)] + [(100 + i, "https://e.example/", f"<body>{plain(i, x)}</body>") for i, x in enumerate(own)]
    rows += [rows[3], rows[3]]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    values = defaultdict(list)
    for url, page in {(u, h) for _, u, h in rows}:
        for path, x in html.branches(html.parse(page)).items():
            values[url.split("/")[2], int.from_bytes(path, "little", signed=True)].append(x)

    def entropy(v):
        return -sum(n / len(v) * math.log(n / len(v), len(v)) for n in Counter(v).values())

    want = {k: (len(v), entropy([x[0] for x in v]), entropy([x[1] for x in v]), sum(x[2] for x in v) / len(v)) for k, v in values.items() if len(v) >= html.LEAST_PAGES}
    tree = df.select(F.element_at(F.split("url", "/"), 3).alias("host"), "html")
    got = {(r["host"], r["path"]): tuple(r)[2:] for r in html.style_tree(tree).collect()}
    assert set(got) == set(want) and all(g == pytest.approx(want[k], abs=1e-9) for k, g in got.items())
    for r in html.extract_pages(df).collect():
        i = r["page_id"]
        page = rows[i][2] if i < 100 else rows[40 + i - 100][2]
        title = re.findall("<h1>(.*?)</h1>", page)
        assert r["text"] == "\n\n".join([*title, own[i % 100]]), i


def test_chat_round_trip(spark):
    odd = ["<|im_end|>", "\\", "<\\|", "<\\\\|im_start|>", "a<|turn|>b", "", None, "é日本\n", "<|", "|>", "<|message|>x"]
    rnd = random.Random(8)
    rows = [(c, t, rnd.choice(["user", "assistant", "assistant", "system", None, "a<|message|>b"]), rnd.choice(odd) if rnd.random() < 0.7 else prose(rnd, 5)) for c in range(30) for t in range(rnd.randrange(1, 9))]
    rows += [(None, 1, "user", "x"), (None, None, "user", "y"), rows[0]]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("seq", F.lit(1)).withColumn("start", F.lit("x"))
    out = {r["conv_id"]: r for r in chat.read_back(chat.format_chat(df)).collect()}
    conv = defaultdict(list)
    for c, t, role, text in rows:
        conv[c].append((t is not None, t or 0, role or "", text or ""))
    for c, turns in conv.items():
        turns.sort()
        assert [(x["role"], x["text"]) for x in out[c]["turns"]] == [(r, t) for *_, r, t in turns]
        assert out[c]["loss_text"] == "".join(t for *_, r, t in turns if r == "assistant")
        runs = 1 + sum(a[2] != b[2] for a, b in zip(turns, turns[1:]))
        assert out[c]["formatted"].count(chat.START) == runs
    assert chat.format_chat(df.limit(0)).count() == 0


def test_entities_module_is_used():
    assert entities.unescape("&amp") == "&"


def test_edges_of_each_operator(spark):
    """Nulls in any column, empty and very long texts, repeated rows, rows that share an id, clashing columns, empty tables."""
    rnd = random.Random(77)
    long = prose(rnd, 150_000, 4000)
    rows = [(i, prose(rnd, rnd.randrange(3, 120)), "en", f"s{i % 3}", 1) for i in range(40)]
    rows += [(None, None, None, None, None), (None, prose(rnd, 40), None, None, None), (50, "", "en", "s0", None), (51, long, "en", "s0", None), rows[0], rows[0], (0, prose(rnd, 60), "de", None, 2), (52, "\u00e9\U0001f600 " * 50, None, "s1", None)]
    clash = "size target rate copies taken rep kept component_id n_shingles th k1 h lo words items spans score held_out predicted __quality __evidence __spans rest toxic y half".split()
    df = spark.createDataFrame(rows, DOCS).withColumns({n: F.lit("x") for n in clash})
    labels = spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(40)] + [(None, 1, 1), (7, None, None), (3, 1, 0)], LABELS).withColumn("text", F.lit("x"))
    bench = spark.createDataFrame([(1, " ".join(long.split()[1000:1015])), (None, "x y z"), (3, None)], "item_id bigint, text string").withColumn("phrase", F.lit(1))
    runs = {
        "near": lambda d: minhash.near_duplicates(d), "repeats": lambda d: suffixes.remove_repeats(d), "substrings": lambda d: substrings.substring_dedup(d).select("doc_id", "text", "__n_removed"),
        "toxic": lambda d: toxicity.score_documents(d, labels), "quality": lambda d: quality.classify(d, labels).select("doc_id", "__quality"), "mix": lambda d: mixing.mix_sources(d).select("doc_id", "source", "size", "target", "rate"),
        "bench": lambda d: decontamination.decontaminate(d, bench), "clean": lambda d: decontamination.clean_documents(d, bench).select("doc_id"),
    }
    for name, run in runs.items():
        got = run(df).collect()
        assert len(got) == len(rows) - (name == "clean"), name
        same = Counter(str(r) for r in got if r["doc_id"] == 0)
        assert max(same.values()) >= 3, name  # three equal rows, one of another text
        assert run(df.limit(0)).count() == 0, name
    tagged = {r["doc_id"]: r for r in decontamination.decontaminate(df, bench).collect()}
    assert tagged[51]["n_hit"] == 15 and tagged[51]["items"] == [1]
    # one long conversation, and turns without id
    talk = [(1, i, "user" if i % 3 else "assistant", f"t{i}") for i in range(3000)] + [(None, None, None, None), (2, 0, "assistant", long)]
    turns = spark.createDataFrame(talk, "conv_id bigint, turn bigint, role string, text string").withColumns({n: F.lit("x") for n in ("turns", "parts", "starts", "formatted")})
    out = {r["conv_id"]: r for r in chat.read_back(chat.format_chat(turns)).collect()}
    assert out[1]["loss_text"] == "".join(f"t{i}" for i in range(0, 3000, 3)) and len(out[1]["turns"]) == 3000
    assert out[2]["loss_text"] == long and out[None]["loss_text"] == ""


def test_mixing_optimum(spark):
    """The rates are those of the dual optimum found by bisection, at the cap too."""
    rnd = random.Random(13)
    rows = [(i, " ".join(["w"] * rnd.randrange(1, 400)), "en", f"s{i * i % 6}", None) for i in range(400)]
    got = mixing.mix_sources(spark.createDataFrame(rows, DOCS)).collect()
    by = defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
    for rs in by.values():
        total, target, mean = sum(r["size"] for r in rs), rs[0]["target"], sum(r["size"] for r in rs) / len(rs)
        if target >= 3 * total:
            assert all(r["rate"] == 3 for r in rs)
            continue
        lo, hi = -100.0, 100.0
        for _ in range(200):
            mid = (lo + hi) / 2
            g = sum(r["size"] * min(3.0, math.exp(min(mid * r["size"] / mean, 50))) for r in rs)
            lo, hi = (mid, hi) if g < target else (lo, mid)
        assert all(r["rate"] == pytest.approx(min(3.0, math.exp(lo * r["size"] / mean)), abs=1e-4) for r in rs)
        assert len({r["rate"] for r in rs if r["size"] > 20}) > 5
