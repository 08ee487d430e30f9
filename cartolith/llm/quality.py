"""Quality classifier (operator 5): hierarchical empirical Bayes over document, path and host.

A logistic model of surface measures and of a document's words gives its evidence, log-odds free of the prior.  Words count
through the mean log-odds of ``BINS`` hashed bins, a naive Bayes model; the logistic weights are fitted on either half of
the labelled documents with the bins of the other half, and evidence takes the bins of both.  At most ``SAMPLE``
labelled documents (those of least hash) are read for the fit.  Host (``source``) and path (``source``, ``lang``) rates of good
documents are means of the model's probabilities over all documents, gathered by partial aggregation, and shrunk:
path toward host and host toward the global rate, each with a strength set by the method of moments, so sparse sites
follow their parents.  The posterior adds the shrunk path rate to the evidence.

Null and empty texts have measures of zero and so the score of an empty text; a null source or lang is a site of its own;
labels that are null or without document are passed over; with no labels of both kinds the evidence is 0; an empty
table gives an empty result; repeated rows get equal results; extra columns are passed through, those named
like the added ones are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textnp as tn
from .common import Written, table

SAMPLE = 20_000
MEASURES = ("size", "upper", "symbol", "bar", "digit", "same_next", "trailing", "wordlen", "distinct", "words")
BINS = 1 << 12
#: Greatest log-odds of a bin.
MOST = 3.0


def bins_of(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(52)).astype(np.int64)


def measures(buf: np.ndarray, offs: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """One row of MEASURES for each text: shares of bytes or of words, each in about 0 to 1; odds: log-odds of the bins of words."""
    n = len(offs) - 1
    kind = np.zeros(256, np.uint8)
    kind[65:91], kind[97:123], kind[48:58], kind[128:] = 1, 2, 3, 2
    kind[[*b"#$%&*!@^~+=<>{}[]\\_"]] = 4
    kind[[*b"|"]] = 5
    kind[[0x20, *range(9, 14)]] = 6
    k = kind[buf]
    upto = np.zeros((n, 7))
    row = np.repeat(np.arange(n), np.diff(offs))
    upto[:] = np.bincount(row * 7 + np.minimum(k, 6), minlength=n * 7).reshape(n, 7)
    size = np.maximum(np.diff(offs), 1)
    start, end, wrow = tn.runs(k != 6, offs)
    words = np.maximum(np.bincount(wrow, minlength=n), 1)
    h = tn.Quick(tn.codes(21, lower=True)[buf], tn.QUICK).of(start, end)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (wrow[1:] == wrow[:-1])
    mark = (end - start >= 3) & (k[end - 1] == 4) & (k[np.maximum(end - 2, 0)] == 4)
    own = np.sort((wrow.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20)))
    new = np.ones(len(own), bool)
    new[1:] = own[1:] != own[:-1]
    distinct = np.bincount((own[new] >> np.uint64(44)).astype(np.int64), minlength=n)
    per_word = lambda x: np.bincount(wrow, x, minlength=n) / words
    letters = np.maximum(upto[:, 1] + upto[:, 2], 1)
    # of 64 words or fewer all may differ; of more, ever fewer do
    return np.stack(
        [np.log1p(np.diff(offs)) / 12, upto[:, 1] / letters, upto[:, 4] / size, upto[:, 5] / words, upto[:, 3] / size, per_word(same), per_word(mark),
         np.minimum(per_word(end - start) / 20, 2), distinct / words, per_word(odds[bins_of(h)])], 1,
    )


def _binned(batches):
    """(y, half, text) -> counts of documents by half, y and bin; bin -1 counts all documents."""
    total = np.zeros((2, 2, BINS + 1), np.int64)
    for b in batches:
        y, half = b.column(0).to_numpy(), b.column(1).to_numpy()
        for lo, buf, offs in tn.pieces(b.column(2)):
            start, end, row = tn.runs(~tn.spaces()[buf], offs)
            own = np.unique(row * BINS + bins_of(tn.Quick(tn.codes(21, lower=True)[buf]).of(start, end)))
            row = own // BINS + lo
            np.add.at(total, (half[row], y[row], own % BINS), 1)
            at = np.arange(lo, lo + len(offs) - 1)
            np.add.at(total, (half[at], y[at], BINS), 1)
    half, y, at = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32)) for x in (half, y, at)] + [pa.array(total[half, y, at])], ["half", "y", "bin", "n"])


def log_odds(count: np.ndarray) -> np.ndarray:
    """(2, BINS + 1) counts of bad and good documents -> log-odds of good ones for each bin, less one standard error, 0 where that leaves none."""
    bad, good = count[0, :-1], count[1, :-1]
    if not count[0, -1] or not count[1, -1]:
        return np.zeros(BINS)
    odds = np.log((good + 0.5) / (count[1, -1] + 1)) - np.log((bad + 0.5) / (count[0, -1] + 1))
    return np.clip(np.sign(odds) * np.maximum(np.abs(odds) - np.sqrt(1 / (good + 0.5) + 1 / (bad + 0.5)), 0), -MOST, MOST)


def _measured(odds: np.ndarray):
    """(y, half, text) -> y, x: measures with the bins of the other half."""

    def run(batches):
        for b in batches:
            half = b.column(1).to_numpy()
            for lo, buf, offs in tn.pieces(b.column(2)):
                x = [measures(buf, offs, odds[k]) for k in (1, 0)]
                x = np.where(half[lo : lo + len(offs) - 1, None] == 0, x[0], x[1])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, len(x)), pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))], ["y", "x"])

    return run


def design(x: np.ndarray) -> np.ndarray:
    """Measures, the square roots of all but the log-odds, and an intercept."""
    return np.concatenate([x, np.sqrt(x[:, :-1]), np.ones((len(x), 1))], 1)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 40) -> np.ndarray:
    """Weights of the log-odds of y, without the prior of the sample: Newton steps on the penalised likelihood."""
    w = np.zeros(2 * len(MEASURES))
    if len(y) == 0 or y.min() == y.max():
        return w
    d = design(x)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        s = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((d * s[:, None]).T @ d + ridge * np.eye(len(w)), d.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    m = y.mean()
    w[-1] -= np.log(m / (1 - m))
    return w


def _evidence(weights: np.ndarray, odds: np.ndarray, names: list[str]):
    def run(batches):
        for b in batches:
            out = [design(measures(buf, offs, odds)) @ weights for _, buf, offs in tn.pieces(b.column(names.index("text")))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(out) if out else np.zeros(0))], [*names, "__evidence"])

    return run


def with_evidence(docs: DataFrame, weights: np.ndarray, odds: np.ndarray) -> DataFrame:
    schema = T.StructType([*docs.schema.fields, T.StructField("__evidence", T.DoubleType())])
    return docs.mapInArrow(_evidence(weights, odds, docs.columns), schema)


def learned(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the measures, and log-odds of the bins of words."""
    drawn = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", F.col("quality").cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample)
    drawn = Written(drawn, "labelled").sized()
    half = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(2)).cast("int")
    x = Written(docs.select("doc_id", "text").join(drawn, "doc_id").select("y", half.alias("half"), "text"), "labelled-texts").df
    count = np.zeros((2, 2, BINS + 1))
    for r in x.mapInArrow(_binned, "half int, y int, bin int, n bigint").groupBy("half", "y", "bin").agg(F.sum("n").alias("n")).collect():  # 4 * BINS rows at most
        count[r["half"], r["y"], r["bin"]] = r["n"]
    rows = x.mapInArrow(_measured(np.stack([log_odds(count[k]) for k in (0, 1)])), "y int, x array<double>").collect()
    return fit(np.array([r["x"] for r in rows]).reshape(len(rows), len(MEASURES)), np.array([r["y"] for r in rows], float)), log_odds(count.sum(0))


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _strength(n: Column, total: Column, parent: Column) -> Column:
    """Of the beta prior, by moments: parent variance over the spread between sites, less one; 1 to 1e6."""
    rate, inner = total / n, parent * (1 - parent)
    spread = (F.sum(n * (rate - parent) * (rate - parent)) - F.sum(inner)) / F.sum(n)
    return F.least(F.greatest(F.avg(inner) / F.greatest(spread, F.lit(1e-9)) - 1, F.lit(1.0)), F.lit(1e6))


def site_rates(scored: DataFrame, host: str, path: str) -> DataFrame:
    """(host, path, __evidence) -> __host, __path, __host_rate, __rate: shrunk rates of good documents."""
    good = 1 / (1 + F.exp(-F.least(F.greatest(F.col("__evidence"), F.lit(-30.0)), F.lit(30.0))))
    sites = Written(scored.groupBy(F.col(host).alias("__host"), F.col(path).alias("__path")).agg(F.count("*").cast("double").alias("n"), F.sum(good).alias("good")), "sites").df
    hosts = sites.groupBy("__host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    root = hosts.agg((F.sum("good") / F.sum("n")).alias("root"))
    hosts = hosts.crossJoin(F.broadcast(root))  # one row
    k = hosts.agg(_strength(F.col("n"), F.col("good"), F.col("root")).alias("k"))
    hosts = hosts.crossJoin(F.broadcast(k)).select(F.col("__host").alias("h"), "root", ((F.col("good") + F.col("k") * F.col("root")) / (F.col("n") + F.col("k"))).alias("__host_rate"))
    sites = sites.join(hosts, F.col("__host").eqNullSafe(F.col("h"))).drop("h")
    k = sites.agg(_strength(F.col("n"), F.col("good"), F.col("__host_rate")).alias("k"))
    return sites.crossJoin(F.broadcast(k)).select("__host", "__path", "__host_rate", ((F.col("good") + F.col("k") * F.col("__host_rate")) / (F.col("n") + F.col("k"))).alias("__rate"))


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """All columns of docs and __evidence, __host_rate, __path_rate, __quality (posterior probability of a good document)."""
    docs = docs.drop("__evidence", "__host_rate", "__path_rate", "__quality")
    model = learned(docs, labels)
    rates = Written(site_rates(with_evidence(docs.select("text", host, path), *model), host, path), "rates").sized()
    x = with_evidence(docs, *model)
    x = x.join(rates, x[host].eqNullSafe(rates["__host"]) & x[path].eqNullSafe(rates["__path"]), "left").drop("__host", "__path")
    return x.withColumn("__quality", 1 / (1 + F.exp(-F.least(F.greatest(F.col("__evidence") + _logit(F.col("__rate")), F.lit(-500.0)), F.lit(500.0))))).withColumnRenamed("__rate", "__path_rate")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, evidence, host_rate, path_rate, score, keep (score >= 0.5)."""
    x = classify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), table(spark, sf_dir, "labels"))
    return x.select(
        "doc_id", F.col("__evidence").alias("evidence"), F.col("__host_rate").alias("host_rate"), F.col("__path_rate").alias("path_rate"),
        F.col("__quality").alias("score"), (F.col("__quality") >= 0.5).alias("keep"),
    )
