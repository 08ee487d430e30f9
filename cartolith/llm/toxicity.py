"""Toxicity (operator 3): noisy-channel deobfuscation, then a learned lexicon and a logistic score.

A character trigram model is counted over all documents.  A token that is not plainly a word is read as a lattice:
each character may stand for itself, for a letter it imitates (leetspeak), for nothing (separators, repeats) or,
for ``*``, for any letter; spaced-out letters are joined first.  Viterbi search under the character model restores
the likeliest word: its states are the last two letters, all of them are kept, and the word is read off back-pointers, so
it is exact and linear in the token.  Tokens past ``STRETCH`` characters are read in overlapping stretches.  Of the restored
words and their beginnings, those that mark toxic documents make a lexicon.  Labelled documents of remainders 0 and 2 of
crc32(doc_id) modulo 3 are learned from, remainder 1 is held out: a logistic model of measures of a lexicon's hits (how
many, how dense, how sure) is fitted on either part with the lexicon of the other part, and scores take the lexicon
of both.  Each part of the fit takes at most ``SAMPLE`` labelled documents of either
class, those of least hash, whose words bound the lexicon; scoring reads every whole text.

Null and empty texts have no hits and get the score of a clean text; labels that are null are passed over; with no labels of
both kinds all scores are 0; a null doc_id counts as held out = false; repeated rows get equal results; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Written, table

SAMPLE = 5000
#: Characters of a token read at once, and those that two stretches share.
STRETCH, SHARED = 64, 16
#: Log-odds, less one standard error, and toxic documents that an entry of the lexicon needs.
SURE, SEEN = 1.5, 4
THRESHOLD = 0.7

# What characters imitate.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "#": "h", "*": "abcdefghijklmnopqrstuvwxyz",
}
#: Costs of a leet letter, of any letter for ``*``, of dropping a digit, a symbol that imitates, another mark, a repeat.
IMITATED, WILD, NO_DIGIT, NO_SYMBOL, NO_MARK, REPEAT = 0.5, 2.5, 6.0, 3.0, 1.0, 1.5
#: Ends of a lattice, the likeliest first, whose words are looked up.
READINGS = 3

EDGE = re.compile(r"^[\W_]+|[\W_]+$")
DECORATION = re.compile(r"([^\w\s])\1{2,}")
REPEATED = re.compile(r"(\w)\1+")
THRICE = re.compile(r"(\w)\1\1")


def letter(c: str) -> int:
    """Class of a lower-case character, 1 to 63; 0 for what is no letter."""
    if "a" <= c <= "z":
        return ord(c) - 96
    return 27 + ord(c) % 37 if c.isalpha() else 0


def letters() -> np.ndarray:
    return np.array([letter(chr(i)) if not 0xD800 <= i < 0xE000 else 0 for i in range(0x3000)], np.uint8)


def _trigrams(batches):
    look, total = letters(), np.zeros(64**3, np.int64)
    for b in batches:
        for text in b.column(0).to_pylist():
            if text:
                code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
                x = np.where(code < 0x3000, look[np.minimum(code, 0x2FFF)], 27 + code % 37).astype(np.int32)
                x = np.concatenate([np.zeros(2, np.int32), x, np.zeros(1, np.int32)])
                if len(x) < 4000:
                    np.add.at(total, (x[:-2] << 12) + (x[1:-1] << 6) + x[2:], 1)
                else:
                    total += np.bincount((x[:-2] << 12) + (x[1:-1] << 6) + x[2:], minlength=64**3)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["gram", "n"])


def language_model(counts: np.ndarray) -> np.ndarray:
    """-log p(third | first two) for all classes, trigrams backed by bigrams and single letters."""
    c3 = counts.reshape(64, 64, 64).astype(float)
    c2, c1 = c3.sum(0), c3.sum((0, 1))
    p1 = (c1 + 1) / (c1.sum() + 64)
    p2 = (c2 + 5 * p1) / (c2.sum(1, keepdims=True) + 5)
    p3 = (c3 + 3 * p2[None]) / (c3.sum(2, keepdims=True) + 3)
    return -np.log(p3)


class Decoder:
    """Restores tokens; the model is an array of 64 x 64 x 64 costs."""

    def __init__(self, cost: np.ndarray):
        self.cost = cost.reshape(-1).tolist()

    def viterbi(self, token: str) -> list[str]:
        """The likeliest words, best first."""
        cost, before = self.cost, ""
        hidden = token.count("*")
        wild = hidden <= len(token) - hidden  # of more hidden letters than shown ones no word can be told
        now: dict[tuple[int, int], float] = {(0, 0): 0.0}
        trace: list[dict[tuple[int, int], tuple[tuple[int, int], str]]] = []
        for c in token:
            options: list[tuple[str, float]] = []
            if c.isalpha():
                options.append((c, 0.0))
                if c == before:
                    options.append(("", REPEAT))
            else:
                if (like := LOOKS_LIKE.get(c)) is not None and (wild or c != "*"):
                    options += [(x, IMITATED if len(like) < 3 else WILD) for x in like]
                options.append(("", NO_DIGIT if c.isdigit() else NO_SYMBOL if like else NO_MARK))
            before = c
            then: dict[tuple[int, int], float] = {}
            back: dict[tuple[int, int], tuple[tuple[int, int], str]] = {}
            for x, extra in options:
                z = letter(x) if x else 0
                for (a, b), spent in now.items():
                    if not x:
                        key, total = (a, b), spent + extra
                    elif a == b == z and c == x:
                        continue  # no word has a letter three times
                    else:
                        key, total = (b, z), spent + extra + cost[(a << 12) + (b << 6) + z]
                    if key not in then or total < then[key]:
                        then[key], back[key] = total, ((a, b), x)
            if not then:  # a letter thrice that nothing drops
                then, back = dict(now), {k: (k, "") for k in now}
            now = then
            trace.append(back)
        ends = sorted((spent + cost[(a << 12) + (b << 6)], (a, b)) for (a, b), spent in now.items())[:READINGS]
        out = []
        for _, state in ends:
            word = []
            for back in reversed(trace):
                state, x = back[state]
                word.append(x)
            out.append("".join(reversed(word)))
        return out

    def restore(self, token: str) -> list[str]:
        """The words that a lower-case token may stand for: the likeliest readings of its lattice, best first, then the
        letters imitated as they stand, with and without repeats.  A token without letters stays as it is."""
        core = EDGE.sub("", token)
        if core.isalpha() and not THRICE.search(core):
            edge = token.replace(core, "", 1)
            if not any(x in LOOKS_LIKE for x in edge) or DECORATION.search(edge) or edge.strip("!.,;:?") == "":
                return list(dict.fromkeys([core, REPEATED.sub(r"\1", core)]))
        token = DECORATION.sub("", token)
        if not any(c.isalpha() for c in token):
            return [core]
        plain = ["".join(LOOKS_LIKE.get(c, c)[i] for c in token if c.isalpha() or len(LOOKS_LIKE.get(c, "*" * 9)) < 9) for i in (0, -1)]
        plain += [REPEATED.sub(r"\1", x) for x in plain]
        stretches = [token[i : i + STRETCH] for i in range(0, max(len(token) - SHARED, 1), STRETCH - SHARED)]
        return list(dict.fromkeys([*(w for x in stretches for w in self.viterbi(x)), *plain]))


def spaced(tokens: list[str]) -> list[str]:
    """Runs of three or more single characters, joined."""
    out, run = [], []
    for t in [*tokens, ""]:
        if len(t) == 1:
            run.append(t)
        else:
            if len(run) > 2:
                out.append("".join(run))
            run = []
    return out


def features(word: str) -> list[str]:
    return [word, *("^" + word[:k] for k in (4, 5, 6, 7) if len(word) > k)] if len(word) > 2 else []


MEASURES = 5


class Scorer(dict):
    """token -> weight of its best lexicon entry, 0 where it has none; what was met of late is kept."""

    def __init__(self, cost: np.ndarray, lexicon: dict[str, float]):
        super().__init__()
        self.decoder, self.lexicon = Decoder(cost), lexicon

    def weight(self, word: str) -> float:
        return max((self.lexicon.get(f, 0.0) for f in features(word)), default=0.0)

    def __missing__(self, token: str) -> float:
        if len(self) > 300_000:
            self.clear()
        w = self[token] = max(map(self.weight, self.decoder.restore(token)), default=0.0)
        return w

    def measures(self, text: str | None) -> tuple[float, ...]:
        """Of the hits: distinct ones, occurrences, sum of weights, greatest weight, share of the words."""
        tokens = (text or "").lower().split()
        count = Counter(tokens)
        hits = [(w, n) for t, n in count.items() if (w := self[t])]
        if sum(n for t, n in count.items() if len(t) == 1) > 2:
            for run in spaced(tokens):
                words = [w for i in range(0, max(len(run) - SHARED, 1), STRETCH - SHARED) for w in self.decoder.restore(run[i : i + STRETCH])]
                w = max((self.lexicon.get(word[i:j], 0.0) for word in words for i in range(len(word)) for j in range(i + 3, min(len(word), i + 14) + 1)), default=0.0)
                hits += [(w, 1)] if w else []
        if not hits:
            return (0.0,) * MEASURES
        many = sum(n for _, n in hits)
        return math.log1p(len(hits)), math.log1p(many), math.log1p(sum(w for w, _ in hits)), max(w for w, _ in hits), math.sqrt(many / len(tokens))


def _counted(cost: np.ndarray):
    def run(batches):
        decoder, count = Decoder(cost), [Counter() for _ in range(4)]
        for b in batches:
            for text, toxic, rest in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                tokens = (text or "").lower().split()
                words = {w for t in set(tokens) for w in decoder.restore(t)[:1]}
                count[toxic + rest].update({f for w in words for f in features(w)})
        rows = list(set().union(*count))
        for lo in range(0, len(rows), 50_000):
            part = rows[lo : lo + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *(pa.array([c[f] for f in part], pa.int64()) for c in count)], ["feature", "c0", "t0", "c2", "t2"])

    return run


def _measured(cost: np.ndarray, lexicons: dict[int, dict[str, float]]):
    """Measures of documents of either part with the lexicon of the other."""

    def run(batches):
        s = {rest: Scorer(cost, lexicons[2 - rest]) for rest in (0, 2)}
        for b in batches:
            x = np.array([s[rest].measures(t) for t, rest in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)]).reshape(-1)
            yield pa.RecordBatch.from_arrays([b.column(1), pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * MEASURES), pa.array(x))], ["toxic", "x"])

    return run


def _scored(cost: np.ndarray, lexicon: dict[str, float], w: np.ndarray | None):
    def run(batches):
        s = Scorer(cost, lexicon)
        for b in batches:
            x = np.array([(*s.measures(t), 1.0) for t in b.column(1).to_pylist()]).reshape(b.num_rows, MEASURES + 1)
            score = np.zeros(len(x)) if w is None else 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score)], ["doc_id", "score"])

    return run


def logistic(x: np.ndarray, y: np.ndarray, toxic_share: float, ridge: float = 0.05) -> np.ndarray | None:
    """Newton steps; classes are weighed back to their shares among all labels."""
    if len(y) == 0 or y.min() == y.max():
        return None
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    weight = np.where(y == 1, toxic_share / y.mean(), (1 - toxic_share) / (1 - y.mean()))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        s = np.maximum(weight * p * (1 - p), 1e-9)
        step = np.linalg.solve((x * s[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def remainder(doc_id) -> F.Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def model(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """Character costs, lexicon and logistic weights."""
    grams = docs.select("text").mapInArrow(_trigrams, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = np.zeros(64**3)
    for r in grams.collect():  # 64 ** 3 rows at most
        counts[r["gram"]] = r["n"]
    cost = language_model(counts)
    known = labels.where("toxic in (0, 1) and doc_id is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"), remainder("doc_id").alias("rest")).where("rest <> 1").distinct()
    known = Written(known, "known").df
    share = known.agg(F.avg("toxic")).first()[0] or 0.0
    drawn = None
    for rest in (0, 2):
        for toxic in (0, 1):
            part = known.where(f"rest = {rest} and toxic = {toxic}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
            drawn = part if drawn is None else drawn.unionByName(part)
    drawn = Written(drawn, "drawn").sized()
    texts = Written(docs.select("doc_id", "text").join(drawn, "doc_id").select("text", "toxic", "rest"), "drawn-texts").df
    sizes = {(r["rest"], r["toxic"]): r["n"] for r in texts.groupBy("rest", "toxic").agg(F.count("*").alias("n")).collect()}
    seen = texts.select("text", "toxic", "rest").mapInArrow(_counted(cost), "feature string, c0 bigint, t0 bigint, c2 bigint, t2 bigint")
    seen = seen.groupBy("feature").agg(*(F.sum(k).alias(k) for k in ("c0", "t0", "c2", "t2")))

    def sure(parts: tuple[int, ...]) -> F.Column:
        """The log-odds of toxic documents less one standard error."""
        t, c = (sum((F.col(f"{k}{rest}") for rest in parts), F.lit(0)) for k in "tc")
        nt, nc = (sum(sizes.get((rest, toxic), 0) for rest in parts) for toxic in (1, 0))
        odds = F.log((t + 0.5) / (nt + 1.0)) - F.log((c + 0.5) / (nc + 1.0)) - F.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
        return F.when((t >= SEEN) & (odds >= SURE) & F.lit(nt > 0 and nc > 0), odds)

    parts = {0: (0,), 2: (2,), 1: (0, 2)}
    lexicons: dict[int, dict[str, float]] = {k: {} for k in parts}
    for r in seen.select("feature", *(sure(rests).alias(f"w{k}") for k, rests in parts.items())).where("coalesce(w0, w2, w1) is not null").collect():
        for k in parts:
            if r[f"w{k}"] is not None:
                lexicons[k][r["feature"]] = r[f"w{k}"]
    lexicon = lexicons.pop(1)
    rows = texts.select("text", "toxic", "rest").mapInArrow(_measured(cost, lexicons), "toxic int, x array<double>").collect()
    weights = logistic(np.array([r["x"] for r in rows]).reshape(len(rows), MEASURES), np.array([r["toxic"] for r in rows], float), share)
    return cost.astype(np.float32), lexicon, weights


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, held_out, score, predicted."""
    cost, lexicon, weights = model(docs, labels)
    kind = dict(docs.dtypes)["doc_id"]
    x = docs.select("doc_id", "text").mapInArrow(_scored(cost, lexicon, weights), f"doc_id {kind}, score double")
    return x.select("doc_id", F.coalesce(remainder("doc_id") == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
