"""Benchmark decontamination (operator 8): a broadcast hash set of benchmark windows, DataFrame functions only.

Words are runs of characters other than ASCII punctuation, space and control, with A-Z lower-cased.  A window is ten
consecutive words of an item; an item of fewer words, but not none, is one window.  The hash set of windows is keyed on
the longest word of each; the scan looks up each word of a document, lays the windows of that word over it and
verifies all their words.  The set is written and measured; what is larger than ``SLICE_BYTES`` is broadcast in slices of
that size, one scan of the documents each, so that no word of a document is ever shuffled.

Null and empty texts have no words and are never hit; an empty benchmark hits nothing; repeated rows get equal results;
extra columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Written, table

#: Largest part of the set, in bytes of Parquet, that is broadcast at once.
SLICE_BYTES = 8 << 20
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text.  lower() does for pure ASCII; other texts must keep their other capitals."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(low, NOT_WORD), "")


def benchmark_windows(benchmark: DataFrame, n: int) -> DataFrame:
    """(anchor, ahead, length, phrase, items): one row per distinct window; its anchor is its longest word, the first of
    several, with ``ahead`` words before it."""
    b = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    b = b.withColumn("length", F.least(F.size("words"), F.lit(n)))
    at = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1))
    b = b.select("item_id", "length", "words", at.alias("at")).select("item_id", "length", F.slice("words", F.col("at"), F.col("length")).alias("words"))
    b = b.groupBy("length", F.concat_ws(" ", "words").alias("phrase")).agg(F.collect_set("item_id").alias("items"), F.first("words").alias("words"))
    longest = F.array_max(F.transform("words", lambda w, i: F.struct(F.length(w).alias("chars"), (-i).alias("at"))))
    b = b.withColumn("ahead", -longest["at"])
    return b.select(F.get("words", F.col("ahead")).alias("anchor"), "ahead", "length", "phrase", "items")


def hits(docs: DataFrame, benchmark: DataFrame, n: int = 10, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(doc_id, th, at, length, items): verified occurrences; at counts words from 0; th is a hash of the text."""
    keys = Written(benchmark_windows(benchmark, n), "bench")
    slices = max(1, math.ceil(keys.bytes() / slice_bytes))
    if slices > 1:
        part = F.pmod(F.xxhash64("anchor"), F.lit(slices))
        return reduce(DataFrame.unionByName, [_hits(docs, keys.df.where(part == i)) for i in range(slices)])
    return _hits(docs, keys.df)


def _hits(docs: DataFrame, keys: DataFrame) -> DataFrame:
    keys = F.broadcast(keys)  # SLICE_BYTES at most
    d = docs.select("doc_id", F.xxhash64("text").alias("th"), words_of(F.col("text")).alias("words"))
    # the outer form: for the inner one Catalyst infers a filter on the array and splits the text once more
    d = d.select("doc_id", "th", "words", F.posexplode_outer("words").alias("word_at", "word"))
    at = F.col("word_at") - F.col("ahead")
    same = F.concat_ws(" ", F.slice("words", F.greatest(at + 1, F.lit(1)), F.col("length"))) == F.col("phrase")
    hit = d.join(keys, (d["word"] == keys["anchor"]) & (at >= 0) & same)
    return hit.select("doc_id", "th", at.alias("at"), "length", "items")


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, spans (start and length in words), items: one row per row of docs."""
    h = hits(docs, benchmark, n, slice_bytes).groupBy("doc_id", "th").agg(
        F.array_sort(F.collect_set(F.struct("at", "length"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    covered = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["length"] - 1))))
    h = h.select(F.col("doc_id").alias("hit_id"), F.col("th").alias("hit_th"), F.size(covered).cast("long").alias("n_hit"), "spans", "items")
    d = docs.select("doc_id", F.xxhash64("text").alias("th"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    x = d.join(h, d["doc_id"].eqNullSafe(h["hit_id"]) & (d["th"] == h["hit_th"]), "left")
    return x.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), "spans", F.coalesce("items", F.array().cast("array<bigint>")).alias("items"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """The rows of docs in which no benchmark window occurs, all columns kept."""
    bad = Written(hits(docs, benchmark, n).select(F.col("doc_id").alias("__bad_id"), F.col("th").alias("__bad_th")).distinct(), "bad")
    b = bad.sized()
    return docs.join(b, docs["doc_id"].eqNullSafe(b["__bad_id"]) & (F.xxhash64(docs["text"]) == b["__bad_th"]), "left_anti")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    named = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return x.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", named).cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP8_SQL = rf"""
with b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bl as (select item_id, w, least(len(w), 10) as l from b where len(w) > 0),
bw as (select distinct item_id, l, array_to_string(w[i:i + l - 1], ' ') as phrase from (select *, unnest(range(1, len(w) - l + 2)) as i from bl)),
ls as (select distinct l from bw),
d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
dw as (select doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') as phrase from (select doc_id, w, l, unnest(range(1, len(w) - l + 2)) as i from d, ls where len(w) >= l)),
h as (select distinct dw.doc_id, dw.i, dw.l, bw.item_id from dw join bw on dw.l = bw.l and dw.phrase = bw.phrase),
n as (select doc_id, count(distinct p)::bigint as n_hit from (select doc_id, unnest(range(i, i + l)) as p from (select distinct doc_id, i, l from h)) group by doc_id),
t as (select doc_id, count(*)::bigint as n_items, sha256(string_agg(item_id::varchar, ',' order by item_id::varchar)) as sha from (select distinct doc_id, item_id from h) group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  coalesce(sha, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join n on d.doc_id = n.doc_id left join t on d.doc_id = t.doc_id"""
