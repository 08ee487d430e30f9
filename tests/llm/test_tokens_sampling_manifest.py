"""Operators 11 to 13 against the tokenizer's library and brute force, with their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from cartolith.llm import bpe, merkle, resampling
from cartolith.llm import textnp as tn

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def library():
    tokens = bpe.vocabulary(PATH)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: k for k, t in enumerate(tokens)}, special_tokens={})


@pytest.fixture(scope="module")
def encode():
    encoder, kind = bpe.Encoder(bpe.vocabulary(PATH)), np.frombuffer(bpe.character_classes(), np.uint8)

    def run(texts):
        out = []
        for _, buf, offs in tn.pieces(pa.array(texts, pa.string())):
            ids, at = bpe.encode_piece(buf, offs, encoder, kind)
            out += [ids[a:b].tolist() for a, b in zip(at, at[1:])]
        return out

    run.encoder = encoder
    return run


def odd_texts(n, seed):
    rnd = random.Random(seed)
    bits = ["'", "'s", "'ll", "'re", "'l", "'r", "'ve", "'T", " ", "  ", "\n", "\t", "\r\n", "a", "b", "xyz", "l", "s", "1", "23", "é", "é", "日本", " ", "　", ".", "!!", "🎉", "́", "ß", "x" * 50, "ab" * 40, "   \n", "<|endoftext|>", "\0", "Ⅷ", "½"]
    return ["".join(rnd.choice(bits) for _ in range(rnd.randrange(14))) for _ in range(n)]


def test_matches_and_tokens_are_those_of_the_library(encode, library):
    texts = odd_texts(4000, 1) + [None, "", " ", "\n\n", "'"]
    assert encode(texts) == [library.encode_ordinary(t or "") for t in texts]


def test_runs_grow_windows(encode, library):
    """Strings of one or two letters, whose tokens change far from a boundary."""
    rnd = random.Random(2)
    texts = ["a" * n for n in range(1, 300, 7)] + [" " * n + "x" for n in range(1, 150, 7)] + ["ab" * n for n in range(1, 200, 9)] + ["".join(rnd.choice("aab") for _ in range(rnd.randrange(300))) for _ in range(200)]
    assert encode(texts) == [library.encode_ordinary(t) for t in texts]
    long = "".join(rnd.choice("abcdefgh") for _ in range(200_000))
    assert encode([long]) == [library.encode_ordinary(long)]


def test_join_is_a_monoid(encode):
    """Any bracketing gives the encoding of the whole; both ways to merge a window agree."""
    rnd, e = random.Random(3), encode.encoder
    for _ in range(300):
        s = bytes(rnd.choice(b"the ring'\xc3\xa9\xe6\x97\xa5") for _ in range(rnd.randrange(3, 80)))
        a, b = sorted(rnd.sample(range(1, len(s)), 2))
        x, y, z = e.encode(s[:a]), e.encode(s[a:b]), e.encode(s[b:])
        want = e._merge_by_heap(s)
        assert e.join(e.join(x, y), z) == e.join(x, e.join(y, z)) == want == e.encode(s)
        assert len(s) > bpe.SCANNED or e.merge(s) == want


def test_characters_of_each_class(encode, library):
    """One code point in 97, beside letters, digits and blanks."""
    texts = [f"a{c}1{c}{c} {c}" for c in map(chr, [*range(1, 0xD800, 97), *range(0xE000, 0x110000, 97)])]
    assert encode(texts) == [library.encode_ordinary(t) for t in texts]


def test_round_trip_of_columns(spark, library):
    texts = odd_texts(60, 4) + [None, "", "x" * 5000, "wort " * 40000, "same", "same"]
    docs = spark.createDataFrame([(i // 2, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, tokens string").repartition(3)
    t = bpe.Tokenizer(spark, PATH)
    enc = t.encode(docs, ["doc_id"])
    assert Counter((r["doc_id"], tuple(r["tokens"])) for r in enc.collect()) == Counter((i // 2, tuple(library.encode_ordinary(x or ""))) for i, x in enumerate(texts))
    assert Counter((r["doc_id"], bytes(r["bytes"])) for r in t.decode(enc, ["doc_id"]).collect()) == Counter((i // 2, (x or "").encode()) for i, x in enumerate(texts))
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id bigint, tokens array<int>")
    assert [bytes(r["bytes"]) for r in t.decode(nulls, ["doc_id"]).collect()] == [b"", b""]
    assert t.decode(t.encode(docs.limit(0), ["doc_id"]), ["doc_id"]).count() == 0


def test_op11_on_documents(spark, library):
    sf = "/root/testdata/sf0.001"
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode_ordinary(r["text"] or "")
        want[r["doc_id"]] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.op11_bpe_round_trip(spark, sf).collect()}
    assert got == want


# ---- operator 12


def resampled(docs, target, percent, buckets=10000, least=20, n=2):
    """Brute force: (doc_id, n_features, weight, score, rank), sorted."""

    def features(text):
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOW))
        return w, [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]

    rows = [(i, *features(t)) for i, t in docs]
    s, t = Counter(f for _, _, x in rows for f in x), Counter(f for x in target for f in features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
    out = []
    for i, w, f in rows:
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w)])
    able = sorted((x for x in out if x[4] >= least), key=lambda x: (-x[3], x[0] is not None, x[0] or 0, x[1], x[4]))
    for k, x in enumerate(able):
        x.append(k + 1 if k < percent * len(able) // 100 else None)
    return sorted((tuple(x[:4]) + (x[5] if len(x) > 5 else None,) for x in out), key=str)


def test_resampling_brute_force(spark):
    rnd = random.Random(5)
    words = ["Haus", "haus", "ÄPFEL", "äpfel", "Zahl7", "x", "日本", "the", "over", "lazy", "dog's", "<b>", "a_b"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(60))) for _ in range(300)] + [None, "", "...", "x " * 30000, "one"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (4, texts[5] + " x"), (None, texts[6]), (None, texts[7])]
    target = [" ".join(rnd.choice(words[:5]) for _ in range(30)) for _ in range(20)] + [None, ""]
    d = spark.createDataFrame([(i, t, "k", 1) for i, t in docs], "doc_id bigint, text string, score string, rank int").repartition(3)
    b = spark.createDataFrame(list(enumerate(target)), "item_id bigint, text string")
    for percent, buckets, n in ((25, 10000, 2), (60, 7, 3)):
        got = resampling.importance_resample(d, b, percent, buckets, n)
        assert sorted((tuple(r) for r in got.drop("words").collect()), key=str) == resampled(docs, target, percent, buckets, n=n)
    assert sorted((tuple(r) for r in resampling.importance_resample(d, b.limit(0)).drop("words").collect()), key=str) == resampled(docs, [], 25)
    assert resampling.importance_resample(d.limit(0), b).count() == 0


def test_resampling_moves_towards_the_target(spark):
    """Documents of the target's vocabulary, a fifth of all, are drawn more than four times as often as the others."""
    rnd = random.Random(6)
    far, near = [f"w{i}" for i in range(200)], [f"v{i}" for i in range(200)]
    rows = [(i, " ".join(rnd.choice(near if i % 5 == 0 else far) for _ in range(40))) for i in range(1000)]
    target = spark.createDataFrame([(i, " ".join(rnd.choice(near) for _ in range(40))) for i in range(50)], "item_id bigint, text string")
    drawn = [r["doc_id"] for r in resampling.importance_resample(spark.createDataFrame(rows, "doc_id bigint, text string"), target, 15).where("rank is not null").collect()]
    assert len(drawn) == 150 and sum(i % 5 == 0 for i in drawn) > 75


# ---- operator 13


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(r):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))


def tree_rows(rows, tampered):
    """Brute force over (doc_id, source, lang, n_chars, text): the multiset of output rows."""
    levels_of, source_leaves = {}, {}
    for r in rows:
        source_leaves.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf_of(r), leaf_of(tampered(r)), r[0]))

    def build(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            x = levels[-1]
            levels.append([sha("".join(x[i : i + 16])) for i in range(0, len(x), 16)])
        return levels

    order = sorted(source_leaves, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        source_leaves[s].sort()
        levels_of[s] = build([x[2] for x in source_leaves[s]])
    top = build([levels_of[s][-1][0] for s in order])
    out = []
    for j, s in enumerate(order):
        for i, (_, _, leaf, now, name) in enumerate(source_leaves[s]):
            siblings = ""
            for levels, at in ((levels_of[s], i), (top, j)):
                for x in levels[:-1]:
                    run = x[at // 16 * 16 : at // 16 * 16 + 16]
                    before, after = run[: at % 16], run[at % 16 + 1 :]
                    siblings += "".join(before + after)
                    now = sha("".join([*before, now, *after]))
                    at //= 16
            out.append((name, leaf, levels_of[s][-1][0], top[-1][0], sha(siblings), now, now == top[-1][0]))
    return Counter(out)


def lowered(r):
    bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
    return (*r[:4], r[4].translate(LOW) if bad and r[4] is not None else r[4])


def run_manifest(spark, rows):
    d = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(3)
    d = d.withColumns({"tree": F.lit("clash"), "row": F.lit(1)})
    fields = {c: F.col(c) for c in merkle.FIELDS}
    bad = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    d = d.withColumn("leaf", merkle.leaf_digest(fields))
    d = d.withColumn("now", F.when(bad, merkle.leaf_digest({**fields, "text": merkle.lowered(F.col("text"))})).otherwise(F.col("leaf")))
    return Counter(tuple(r) for r in merkle.manifest(d).collect())


@pytest.mark.parametrize("shape", ["mixed", "lone", "many", "one source", "one row"])
def test_manifest_brute_force(spark, shape, monkeypatch):
    monkeypatch.setattr(merkle, "NODES", 64)
    rnd = random.Random(7)
    counts = {"mixed": [1, 16, 17, 256, 257, 700, 2, 15], "lone": [1] * 40, "many": [1 + k % 3 for k in range(300)], "one source": [300], "one row": [1]}[shape]
    rows, at = [], 0
    for k, n in enumerate(counts):
        source = None if k == 2 else f"q{k}é" if k % 2 else f"Q{k}"
        for _ in range(n):
            rows.append((at, source, rnd.choice([None, "de"]), rnd.choice([None, -3, 12]), rnd.choice([None, "", "ÄB C", "abc", "A" * 3000, f"Text {at}"])))
            at += 1
    if shape == "mixed":
        rows += [rows[5], rows[5], (rows[9][0], rows[9][1], "en", 1, "other"), (None, "Q0", None, None, None), (None, None, None, None, "N")]
    rnd.shuffle(rows)
    got, want = run_manifest(spark, rows), tree_rows(rows, lowered)
    assert got == want
    if shape == "mixed":
        assert {r[6] for r in got} == {True, False}


def test_manifest_of_no_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, source string, leaf binary, now binary")
    assert merkle.manifest(none).count() == 0 and merkle.manifest(none).columns[0] == "doc_id"


def test_matrix_is_read_in_bounded_pieces(spark, monkeypatch):
    """Blocks are large rows: row groups and batches are bounded by bytes, not by rows alone."""
    import pyarrow.parquet as pq

    from cartolith.llm.common import BYTES

    seen, gains = [], resampling.gains
    monkeypatch.setattr(resampling, "GROUP", 1 << 18)
    monkeypatch.setattr(resampling, "gains", lambda *x: seen.append(spark.conf.get(BYTES)) or gains(*x))
    docs = spark.range(0, 600, 1, 1).select(F.col("id").alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(2000)), lambda i: F.hex(i * 7919 + F.col("id"))), " ").alias("text"))
    before = spark.conf.get(BYTES, None)
    matrix = resampling.count_matrix(docs, 10000, 2, "matrix")
    sizes = [g.total_byte_size for f in matrix.inputFiles() for m in [pq.read_metadata(f.removeprefix("file:"))] for g in map(m.row_group, range(m.num_row_groups))]
    assert sum(sizes) > 2 << 20 and max(sizes) < 1 << 20, sizes
    assert resampling.importance_resample(docs, docs.limit(3).withColumnRenamed("doc_id", "item_id")).count() == 600
    assert seen == [str(resampling.BATCH_BYTES)] and spark.conf.get(BYTES, None) == before
