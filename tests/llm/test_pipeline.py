"""The pipeline on the smallest tables: each stage against its own definition by brute force."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartolith.llm.common import Written, table

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        docs = Written(stage(spark, docs, SF), name).df
        out.append((name, before, docs, {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}))
    return out


def test_columns(spark, stages):
    want = table(spark, SF, "documents").columns
    assert [name for name, *_ in stages] == ["quality", "near_dedup", "passages", "decontaminate", "mixture"]
    for _, _, docs, _ in stages[:-1]:
        assert docs.columns == want


def test_quality_keeps_clean(spark, stages):
    _, before, _, after = stages[0]
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    good = [i for i in before if labels.get(i) == 1]
    bad = [i for i in before if labels.get(i) == 0]
    assert sum(i in after for i in good) >= 0.98 * len(good)
    assert sum(i not in after for i in bad) >= 0.8 * len(bad)


def test_near_dedup(stages):
    from test_operators import near_components, near_sets

    _, before, _, after = stages[1]
    sets = near_sets([(i, t) for i, t in before.items()])
    assert set(after) == set(near_components(sets, 80).values())


def test_passages(stages):
    _, before, _, after = stages[2]
    assert set(before) == set(after)
    words = lambda t: t.split()
    grams = Counter(g for t in after.values() for g in {" ".join(words(t)[k : k + 51]) for k in range(len(words(t)) - 50)})
    assert max(grams.values(), default=0) == 1


def test_decontaminate(spark, stages):
    _, before, _, after = stages[3]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    windows = set()
    for r in table(spark, SF, "benchmark").collect():
        w = words(r["text"])
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))}
    dirty = {i for i, t in before.items() if any(tuple(words(t)[k : k + 10]) in windows for k in range(max(1, len(words(t)) - 9)))}
    assert set(after) == set(before) - dirty


def test_mixture(stages):
    _, before, docs, after = stages[4]
    rows = docs.collect()
    assert {r["doc_id"] for r in rows} <= set(before)
    assert all(0 < r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"] and r["text"] == before[r["doc_id"]] for r in rows)


def test_empty(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
        docs = Written(docs, "empty").df


def test_edges(spark):
    """Nulls in every column, empty and very long texts, repeated rows, rows that share an id, and clashing columns."""
    docs = table(spark, SF, "documents")
    kinds = ", ".join(f"{c} {t}" for c, t in docs.dtypes)
    first = docs.where("length(text) > 600").orderBy("doc_id").first()
    other = docs.where("length(text) > 600").orderBy(F.desc("doc_id")).first()
    row = lambda **k: tuple({"doc_id": 10**6, "text": None, "lang": None, "source": None, "n_chars": None, **k}[c] for c in docs.columns)
    odd = [row(doc_id=None, text=first["text"]), row(doc_id=None), row(text=""), row(doc_id=first["doc_id"], text=other["text"][::-1]), tuple(first), tuple(first), row(doc_id=10**6 + 1, text=" ".join(f"w{i * 7919 % 9973}" for i in range(60_000)), source="x")]
    names = ["__quality", "__gone", "__th", "__id", "__n_removed", "__spans", "__evidence", "__bad_id", "th", "h", "size", "rep", "kept"]
    x = docs.unionByName(spark.createDataFrame(odd, kinds)).withColumns({n: F.lit("x") for n in names})
    for name, stage in corpus_pipeline.STAGES:
        before = x
        x = Written(stage(spark, x, SF), name).df
        if name != "mixture":
            assert x.columns == before.columns and all({r[0] for r in x.select(n).distinct().collect()} <= {"x"} for n in names)
        ids = Counter(r["doc_id"] for r in x.select("doc_id").collect())
        if name == "near_dedup":  # the reversed text that shares an id is no copy of anything
            assert x.where(F.col("doc_id") == first["doc_id"]).where(F.length("text") == len(other["text"])).count() <= 1
            assert ids[None] == Counter(r["doc_id"] for r in before.select("doc_id").collect())[None]
    assert x.count() > 0
