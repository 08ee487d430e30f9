"""Target-distribution importance resampling (operator 12) over a persisted sparse matrix of counts.

Words are runs of bytes other than ASCII punctuation, space and control, with A-Z lower-cased; features are all runs of one
to ``n`` words, joined by one space; a feature's bucket is its crc32 modulo ``buckets``.  One pass over the texts writes the
document-by-bucket matrix of counts as blocks of compressed sparse rows (Parquet in the scratch folder), a block being a
bounded piece of the texts.  Column sums of the blocks, added up inside tasks before the exchange, give the distribution
of the documents; the target's comes in the same way.  A bucket's gain is the floored logarithm of the ratio of both,
smoothed by one per bucket; the product of the matrix with the gains gives each row's sum, and its floored mean the weight.
Gumbel noise of a hash of seed and doc_id makes the drawing without replacement a top-k, whose ranks are positions of a
sort by ranges; only (doc_id, counts, score) are sorted.

Only ``buckets`` sums and gains reach the driver.  Null and empty texts have no features and weight 0; documents under
``least_words`` words are never drawn; ties go to smaller doc_ids, null first, which hash as the empty string; rows of one doc_id
are drawn each by its own text; an empty target has gains of the smoothing alone; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textnp as tn
from .common import BYTES, Written, numbered, set_to, table

#: Bytes of a row group of blocks and of a batch of them: a block is large, and readers and workers hold many rows at once.
GROUP = 8 << 20
BATCH_BYTES = 16 << 20
BLOCK = "doc_id array<bigint>, words array<bigint>, starts array<bigint>, bucket array<int>, count array<int>"


def _word_table() -> bytes:
    """Bytes of words, A-Z lower-cased; all others become blanks."""
    return bytes(b if b >= 0x80 or chr(b).islower() or chr(b).isdigit() else b + 32 if chr(b).isupper() else 0x20 for b in range(256))


def _counted(buckets: int, n: int):
    def run(batches):
        letters = _word_table()
        for b in batches:
            for lo, buf, offs in tn.pieces(b.column(1)):
                raw = buf.tobytes().translate(letters)
                words, starts, columns, counts = [], [0], [], []
                for i in range(len(offs) - 1):
                    w = raw[offs[i] : offs[i + 1]].split()
                    tails = [b" " + x for x in w[1:]]
                    runs = hashes = list(map(crc32, w))
                    for k in range(1, n):
                        runs = list(map(crc32, tails[k - 1 :], runs))  # goes on from the run that is one word shorter
                        hashes = hashes + runs
                    column, count = np.unique(np.array(hashes, np.uint32) % np.uint32(buckets), return_counts=True)
                    words.append(len(w)), columns.append(column), counts.append(count), starts.append(starts[-1] + len(column))
                lists = [pa.array([x.tolist()], t) for x, t in ((b.column(0).slice(lo, len(words)), pa.list_(pa.int64())), (np.array(words), pa.list_(pa.int64())), (np.array(starts), pa.list_(pa.int64())))]
                long = [pa.ListArray.from_arrays(pa.array([0, starts[-1]], pa.int32()), pa.array(np.concatenate(x).astype(np.int32))) for x in (columns, counts)]
                yield pa.RecordBatch.from_arrays([*lists, *long], ["doc_id", "words", "starts", "bucket", "count"])

    return run


def count_matrix(docs: DataFrame, buckets: int, n: int, label: str, key: str = "doc_id") -> DataFrame:
    """(key, text) -> blocks of compressed sparse rows, written: row keys, words of each row, starts of rows, buckets, counts."""
    d = docs.select(F.col(key).cast("long").alias("doc_id"), "text")
    return Written(d.mapInArrow(_counted(buckets, n), BLOCK), label, GROUP).df


def _flat(batch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False)


def _summed(buckets: int):
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            total += np.bincount(_flat(b, "bucket"), _flat(b, "count"), buckets).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    return run


def column_sums(matrix: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket: summed inside tasks, then over them; ``buckets`` numbers reach the driver."""
    sums = matrix.select("bucket", "count").mapInArrow(_summed(buckets), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(ratio of the smoothed shares)) of each bucket."""
    b, s, t = len(documents), documents.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + b) / ((s + 1) * (t.sum() + b)))).astype(np.int64)


def _weighed(gain: np.ndarray):
    def run(batches):
        for b in batches:
            starts, ends = [], []
            at = 0
            for x in b.column(b.schema.get_field_index("starts")):
                x = np.array(x.as_py())
                starts.append(x[:-1] + at), ends.append(x[1:] + at)
                at += x[-1]
            starts, ends, count = np.concatenate(starts), np.concatenate(ends), _flat(b, "count").astype(np.int64)
            sums = lambda x: (lambda c: c[ends] - c[starts])(np.concatenate([[0], np.cumsum(x)]))
            features, value = sums(count), sums(count * gain[_flat(b, "bucket")])
            weight = value // np.maximum(features, 1)
            keys = b.column(b.schema.get_field_index("doc_id")).flatten()
            yield pa.RecordBatch.from_arrays([keys, pa.array(_flat(b, "words")), pa.array(features), pa.array(weight)], ["doc_id", "words", "n_features", "weight"])

    return run


def importance_resample(docs: DataFrame, target: DataFrame, percent: int = 25, buckets: int = 10000, n: int = 2, least_words: int = 20, seed: int = 7, target_key: str = "item_id") -> DataFrame:
    """doc_id, words, n_features, weight, score, rank: one row per row of docs; rank is null where it is not drawn."""
    with set_to(docs.sparkSession, {BYTES: str(BATCH_BYTES)}):
        return _resampled(docs, target, percent, buckets, n, least_words, seed, target_key)


def _resampled(docs: DataFrame, target: DataFrame, percent: int, buckets: int, n: int, least_words: int, seed: int, target_key: str) -> DataFrame:
    matrix = count_matrix(docs, buckets, n, "matrix")
    gain = gains(column_sums(matrix, buckets), column_sums(count_matrix(target, buckets, n, "target", target_key), buckets))
    x = matrix.mapInArrow(_weighed(gain), "doc_id bigint, words bigint, n_features bigint, weight bigint")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    x = x.withColumns({"score": (F.col("weight") + noise).cast("long"), "__short": F.col("words") < least_words})
    x = numbered(x, [F.col("__short"), F.col("score").desc(), F.col("doc_id"), F.col("n_features"), F.col("words")], "__at", "scores")
    eligible = matrix.select(F.sum(F.size(F.filter("words", lambda w: w >= least_words))).alias("n"))
    drawn = F.broadcast(eligible.select(F.floor(percent * F.coalesce("n", F.lit(0)) / 100).alias("__drawn")))  # one row
    rank = F.when(F.col("__at") < F.col("__drawn"), F.col("__at") + 1).cast("long")
    return x.crossJoin(drawn).select("doc_id", "words", "n_features", "weight", "score", rank.alias("rank"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("words")


#: crc32 of a text: its bytes are folded over the table of the 256 remainders.
CRC_TABLE = "list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)), lambda c, i: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end))"
CRC_BYTES = "list_transform(range(length(hex(encode({0}))) // 2), lambda i: (strpos('0123456789ABCDEF', substr(hex(encode({0})), (2 * i + 1)::int, 1)) - 1) * 16 + strpos('0123456789ABCDEF', substr(hex(encode({0})), (2 * i + 2)::int, 1)) - 1)"
CRC = f"xor(list_reduce(list_concat([4294967295], {CRC_BYTES}), lambda c, b: xor(crc_table[xor(c % 256, b) + 1], c // 256)), 4294967295)"
OP12_SQL = rf"""
with crc as (select {CRC_TABLE} as crc_table),
words as (
  select 0 as side, doc_id as id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
  union all select 1, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark),
f as (select side, id, unnest(w) as f from words union all select side, id, w[i] || ' ' || w[i + 1] from (select side, id, w, unnest(range(1, len(w))) as i from words)),
h as (select f, ({CRC.format('f')} % 10000)::int as bucket from (select distinct f from f), crc),
m as (select side, id, bucket, count(*) as n from f join h using (f) group by all),
totals as (select (sum(n) filter (where side = 0))::double as s, coalesce(sum(n) filter (where side = 1), 0)::double as t from m),
gains as (
  select bucket, floor(1000 * ln((coalesce(sum(n) filter (where side = 1), 0)::double + 1) * (any_value(s) + 10000) / ((coalesce(sum(n) filter (where side = 0), 0)::double + 1) * (any_value(t) + 10000))))::bigint as gain
  from m, totals group by bucket),
w as (select id, sum(n)::bigint as n_features, floor(sum(n * gain)::double / sum(n))::bigint as weight from m join gains using (bucket) where side = 0 group by id),
noise as (select doc_id, len(w) as n_words, ('0x' || substr(sha256('7:' || doc_id), 1, 8))::bigint as h from documents join words on side = 0 and id = doc_id),
scored as (
  select doc_id, n_words, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296.0::double))))::bigint as score from noise left join w on id = doc_id),
drawn as (select doc_id, row_number() over (order by score desc, doc_id) as rank from scored where n_words >= 20)
select s.doc_id, n_features, weight, score, case when rank <= (select floor(25 * count(*) / 100) from drawn) then rank end::bigint as rank
from scored s left join drawn d on s.doc_id = d.doc_id"""
