"""Byte-level BPE encoding and decoding (operator 11) as a reduction of a monoid over a tree of halves.

A text is cut into the matches of the tokenizer's pattern, on whose ends no token crosses.  The elements of the monoid are
encoded strings of bytes; joining two gives the encoding of their concatenation.  A match is halved recursively down to
single bytes and its halves are joined: tokens at the boundary are encoded anew in a window, which doubles on each side until
the tokens outside it provably stay.

The proof: merges go by rank, then from the left, so a string is encoded as (t1 .. tn) exactly if each neighbouring pair is
the encoding of its own bytes.  (In the first merge that crosses a boundary, between ti and ti+1, all merges before were inside
tokens, so the bytes of the pair alone see the same merges and this one too; and a pair of an encoding sees no merge across.)
Outside the window all pairs are such already, inside too; so the two pairs at the window's ends decide.

As in tiktoken, a match that is a token itself is that token.  Matches are found for many texts at once from a table of the
classes of code points.  The encodings of short strings and of pairs are kept in bounded tables of a worker.  Nothing is
shuffled: a text is one row and one task.  The vocabulary (a file of the driver, read once) is broadcast; its size is fixed by
the file, not by the input.

Null and empty texts have no tokens and decode to no bytes; special tokens are ordinary text; repeated rows get equal
results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textnp as tn
from .common import table

LETTER, NUMBER, OTHER, SPACE = range(4)
#: Longest string whose encoding a worker keeps, and how many encodings it keeps.
KEPT_BYTES, KEPT = 64, 1 << 18
#: Longest window that is merged by scanning its ranks; longer ones use a heap.
SCANNED = 48
NONE = 1 << 60


def vocabulary(path: str) -> list[bytes]:
    """Tokens by rank, of a file of lines "base64 rank"."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    by_rank = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [by_rank.get(k, b"") for k in range(max(by_rank) + 1)]


def character_classes() -> bytes:
    """Letter, number, other or white space, for each code point, by the character tables of the tokenizer's own library."""
    import tiktoken

    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    kind = np.full(0x110000, OTHER, np.uint8)
    for k, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        only = tiktoken.Encoding("one class", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        found = only.decode(only.encode_ordinary(every))  # what the pattern does not match is left out
        kind[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = k
    return kind.tobytes()


def code_points(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offset and code point of each character of UTF-8."""
    if not len(buf) or buf.max() < 0x80:
        return np.arange(len(buf)), buf.astype(np.int64)
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    lead = buf[at].astype(np.int64)
    cp = lead.copy()
    for size, low, mask in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
        here = np.flatnonzero(lead >= low) if size == 4 else np.flatnonzero((lead >= low) & (lead < low + (0x20 if size == 2 else 0x10)))
        x = lead[here] & mask
        for k in range(1, size):
            x = x << 6 | (buf[at[here] + k] & 0x3F)
        cp[here] = x
    return at, cp


def matches(buf: np.ndarray, offs: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the matches of the pattern

        's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

    in the texts of a piece.  Runs of one class are matches, but: a blank before a run of another class goes with it; of
    white space before other characters the last one is on its own; and a lone apostrophe that no blank precedes takes the
    letters of a contraction with it, the rest of whose run is a match of its own.
    """
    at, cp = code_points(buf)
    n = len(cp)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z
    kind = classes[cp]
    first = np.zeros(n + 1, bool)  # of a text
    first[np.searchsorted(at, offs)] = True
    first[n] = True
    run = first.copy()
    run[1:n] |= kind[1:] != kind[:-1]
    blank_before = np.zeros(n, bool)
    blank_before[1:] = (cp[:-1] == 0x20) & ~first[1:n]
    space = kind == SPACE
    start = run[:n] & (space | ~blank_before)
    last_space = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:n]) if n > 1 else np.zeros(0, np.int64)
    start[last_space] = True
    lone = np.flatnonzero((cp == 0x27) & run[:n] & run[1:] & ~blank_before & ~first[1:])
    if len(lone):
        c1 = cp[lone + 1]
        two = lone + 2 < n
        c2 = np.where(two & ~first[np.minimum(lone + 2, n)], cp[np.minimum(lone + 2, n - 1)], 0)
        short = np.isin(c1, [ord(c) for c in "stmd"])
        long = ((c1 == ord("r")) | (c1 == ord("v"))) & (c2 == ord("e")) | (c1 == ord("l")) & (c2 == ord("l"))
        start[lone[short | long] + 1] = False
        after = np.concatenate([lone[short] + 2, lone[long] + 3])
        start[after[after < n]] = True
    begin = at[start]
    end = np.append(begin[1:], len(buf))
    return begin, end


class Encoder:
    """Encodes byte strings of one match each."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.rank = {t: k for k, t in enumerate(tokens) if t}
        self.byte = [self.rank.get(bytes([b]), -1) for b in range(256)]
        if -1 in self.byte:
            raise ValueError("the vocabulary lacks single bytes")
        self.kept: dict[bytes, tuple[int, ...]] = {}
        self.pairs: dict[int, tuple[int, ...]] = {}

    def __call__(self, match: bytes) -> tuple[int, ...]:
        whole = self.rank.get(match)
        return (whole,) if whole is not None else self.encode(match)

    def encode(self, s: bytes) -> tuple[int, ...]:
        """The tree: halves are encoded, then joined."""
        known = self.kept.get(s)
        if known is not None:
            return known
        if len(s) == 1:
            return (self.byte[s[0]],)
        half = len(s) // 2
        out = self.join(self.encode(s[:half]), self.encode(s[half:]))
        if len(s) <= KEPT_BYTES:
            if len(self.kept) >= KEPT:
                self.kept.clear()
            self.kept[s] = out
        return out

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of both one after the other."""
        window = self.pair(left[-1], right[0])
        if len(window) == 2 and window[0] == left[-1]:
            return left + right
        i = j = 1
        while True:
            moved_left = i < len(left) and not self.stable(left[-i - 1], window[0])
            moved_right = j < len(right) and not self.stable(window[-1], right[j])
            if not (moved_left or moved_right):
                return left[: len(left) - i] + window + right[j:]
            i = min(2 * i, len(left)) if moved_left else i
            j = min(2 * j, len(right)) if moved_right else j
            window = self.merge(b"".join([self.tokens[t] for t in left[len(left) - i :] + right[:j]]))

    def stable(self, a: int, b: int) -> bool:
        pair = self.pair(a, b)
        return len(pair) == 2 and pair[0] == a

    def pair(self, a: int, b: int) -> tuple[int, ...]:
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT:
                self.pairs.clear()
            known = self.pairs[key] = self.merge(self.tokens[a] + self.tokens[b])
        return known

    def merge(self, s: bytes) -> tuple[int, ...]:
        """Encodes a window: the neighbours of least rank are merged, the first of equal ones, as long as there are any."""
        if len(s) > SCANNED:
            return self._merge_by_heap(s)
        get, n = self.rank.get, len(s)
        cut = list(range(n + 1))
        rank = [get(s[k : k + 2], NONE) for k in range(n - 1)]
        while rank:
            least = min(rank)
            if least == NONE:
                break
            k = rank.index(least)
            del cut[k + 1], rank[k]
            if k < len(rank):
                rank[k] = get(s[cut[k] : cut[k + 2]], NONE)
            if k:
                rank[k - 1] = get(s[cut[k - 1] : cut[k + 1]], NONE)
        return tuple([self.rank[s[a:b]] for a, b in zip(cut, cut[1:])])

    def _merge_by_heap(self, s: bytes) -> tuple[int, ...]:
        get, n = self.rank.get, len(s)
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        heap: list[tuple[int, int, int]] = []  # rank, start, end of the merged string

        def offer(a: int) -> None:
            b = after[a]
            if b < n and (r := get(s[a : end[b]])) is not None:
                heappush(heap, (r, a, end[b]))

        for k in range(n - 1):
            offer(k)
        while heap:
            _, a, e = heappop(heap)
            b = after[a] if alive[a] else n
            if b >= n or end[b] != e:
                continue
            alive[b] = False
            end[a], after[a] = e, after[b]
            if after[b] < n:
                before[after[b]] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        out, k = [], 0
        while k < n:
            out.append(self.rank[s[k : end[k]]])
            k = after[k]
        return tuple(out)


def _ready(shared) -> tuple[Encoder, np.ndarray]:
    """Encoder and classes, made once per worker process and kept beside the broadcast value."""
    made = shared.value
    if "encoder" not in made:
        made["encoder"], made["kind"] = Encoder(made["tokens"]), np.frombuffer(made["classes"], np.uint8)
    return made["encoder"], made["kind"]


def encode_piece(buf: np.ndarray, offs: np.ndarray, encoder: Encoder, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of the texts of a piece and the offsets of texts in them."""
    begin, end = matches(buf, offs, kind)
    raw = buf.tobytes()
    found = [encoder(raw[a:b]) for a, b in zip(begin.tolist(), end.tolist())]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    before = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.fromiter(chain.from_iterable(found), np.int32, int(before[-1]))
    return ids, before[np.searchsorted(begin, offs)]


def _encoded(shared, keep: int):
    def run(batches):
        encoder, kind = _ready(shared)
        for b in batches:
            for lo, buf, offs in tn.pieces(b.column(keep)):
                ids, at = encode_piece(buf, offs, encoder, kind)
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([b.column(k).slice(lo, len(at) - 1) for k in range(keep)] + [lists], [*b.schema.names[:keep], "tokens"])

    return run


def _decoded(shared, keep: int):
    def run(batches):
        tokens = shared.value["tokens"]
        size = np.array([len(t) for t in tokens])
        for b in batches:
            lists = b.column(keep)
            if lists.null_count:
                lists = lists.fill_null(pa.scalar([], lists.type))
            ids, at = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            ends = np.concatenate([[0], np.cumsum(size[ids])])
            lo = 0
            while lo < len(lists):
                hi = max(lo + 1, min(lo + 4096, int(np.searchsorted(at, at[lo] + tn.PIECE, "right")) - 1))
                leaves = (b"".join([tokens[t] for t in ids[k : min(k + tn.PIECE, at[hi])].tolist()]) for k in range(at[lo], at[hi], tn.PIECE))
                data, offs = b"".join(leaves), ends[at[lo : hi + 1]] - ends[at[lo]]
                out = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(offs.astype(np.int32)), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([b.column(k).slice(lo, hi - lo) for k in range(keep)] + [out], [*b.schema.names[:keep], "bytes"])
                lo = hi

    return run


class Tokenizer:
    """A vocabulary file, read by the driver and broadcast; encodes and decodes columns of DataFrames."""

    def __init__(self, spark: SparkSession, path: str):
        self.shared = spark.sparkContext.broadcast({"tokens": vocabulary(path), "classes": character_classes()})

    def encode(self, docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
        """The columns ``keep`` and tokens, an array of ids: one row per row of docs."""
        d = docs.select(*keep, text)
        kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields[:-1]]
        return d.mapInArrow(_encoded(self.shared, len(keep)), ", ".join([*kinds, "tokens array<int>"]))

    def decode(self, encoded: DataFrame, keep: list[str], tokens: str = "tokens") -> DataFrame:
        """The columns ``keep`` and bytes: one row per row of encoded."""
        d = encoded.select(*keep, tokens)
        kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields[:-1]]
        return d.mapInArrow(_decoded(self.shared, len(keep)), ", ".join([*kinds, "bytes binary"]))


def op11_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    t = Tokenizer(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    x = t.encode(table(spark, sf_dir, "documents"), ["doc_id"])
    joined = F.array_join(F.col("tokens").cast("array<string>"), ",")
    x = x.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), F.sha2(joined.cast("binary"), 256).alias("ids_sha256"), "tokens")
    return t.decode(x, ["doc_id", "n_tokens", "ids_sha256"]).select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"))
