"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The pieces of a long pre-token stand in a linked list. Each neighbouring pair with a rank is
queued in the bucket of its rank; two levels of bitmaps over the ranks give the lowest filled
bucket by find-first-set. A bucket yields its leftmost position first, and an
entry whose pair has changed since is skipped. Each merge touches two neighbours, so the work
grows as n log n with the length of a pre-token.

Pre-tokens recur, so each worker remembers the ids of a bounded number of short ones; what is
forgotten is only encoded again.

Defined results: a null text is the empty text, with no ids; the rest follows the tiktoken
library, special tokens being ordinary text. Rows are independent of each other: repeated rows
give repeated results and other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file of lines "base64 rank"."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


#: Ranks go up to 256 x len(BITS).
BITS = [1 << i for i in range(1 << 10)]


class Tokenizer:
    """``remember``: how many pre-tokens each of two generations of the memory holds."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, remember: int = 500_000):
        self.ranks, self.remember = ranks, remember
        self.split = regex.compile(pattern).findall
        self.words = [0] * ((max(ranks.values(), default=0) >> 8) + 1)
        self.pairs = {k: v for k, v in ranks.items() if len(k) == 2}
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token.

        The rank queue: ``buckets`` holds positions by rank, a heap each; ``top`` has a bit for
        each of ``words`` that isn't zero, and a word a bit for each of its 256 ranks that has a
        bucket. All are empty again in the end.
        """
        rank_of = self.ranks.get
        if (whole := rank_of(piece)) is not None:
            return [whole]
        n = len(piece)
        end = list(range(1, n + 1))  # the part that starts at i is piece[i:end[i]]; 0 once it is part of another
        before = list(range(-1, n))
        words, buckets, top, pair = self.words, {}, 0, self.pairs.get
        for i in range(n - 1):
            if (r := pair(piece[i : i + 2])) is not None:
                if r in buckets:
                    buckets[r].append(i)  # in order, so a heap
                else:
                    buckets[r] = [i]
                    w = r >> 8
                    words[w] |= BITS[r & 255]
                    top |= BITS[w]
        while top:
            w = (top & -top).bit_length() - 1
            bits = words[w]
            bit = bits & -bits
            rank = (w << 8) + bit.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                words[w] = bits = bits ^ bit
                if not bits:
                    top ^= BITS[w]
            j = end[i]
            if not j or j >= n or rank_of(piece[i : (to := end[j])]) != rank:
                continue  # stale
            end[j] = 0
            end[i] = to
            before[to] = i
            if to < n and (r := rank_of(piece[i : end[to]])) is not None:
                if r in buckets:
                    heappush(buckets[r], i)
                else:
                    buckets[r] = [i]
                    w = r >> 8
                    words[w] |= BITS[r & 255]
                    top |= BITS[w]
            if (p := before[i]) >= 0 and (r := rank_of(piece[p:to])) is not None:
                if r in buckets:
                    heappush(buckets[r], p)
                else:
                    buckets[r] = [p]
                    w = r >> 8
                    words[w] |= BITS[r & 255]
                    top |= BITS[w]
        return [rank_of(piece[i:j]) for i, j in enumerate(end) if j]

    def packed(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        split = self.split(text)
        parts = list(map(self.known.get, split))
        if None in parts:
            for i, part in enumerate(parts):
                if part is None:
                    parts[i] = self._learnt(split[i])
        return b"".join(parts)

    def _learnt(self, word: str) -> bytes:
        got = self.known.get(word) or self.older.get(word)
        if got is None:
            got = array("I", self.merge(word.encode())).tobytes()
        if len(word) <= 32:
            if len(self.known) >= self.remember:
                self.known, self.older = {}, self.known
            self.known[word] = got
        return got

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), dtype="<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def _tokens(source: tuple[str, str], cache: dict = {}) -> Tokenizer:  # noqa: B006  one for each worker
    if source not in cache:
        cache[source] = Tokenizer(load_ranks(source[0]), source[1])
    return cache[source]


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>): the ids of every text. ``ranks_path``: a file that each worker can read, such as that of an installed package."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokens((ranks_path, pattern))
        for batch in batches:
            got = [tok.packed(t or "") for t in batch.column(1).to_pylist()]
            offsets = np.cumsum([0, *(len(b) // 4 for b in got)], dtype=np.int32)
            values = np.frombuffer(b"".join(got), dtype="<i4")
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(id, ids) -> (id, ids, decoded binary)."""

    def run(batches):
        tok = _tokens((ranks_path, pattern))
        for batch in batches:
            out = [tok.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["id", "ids", "decoded"])

    return encoded.select("id", "ids").mapInArrow(run, "id long, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, with_ids: bool = False) -> DataFrame:
    """(id, the columns of ``keep``, n_tokens, ids_sha256, decoded_sha256, with ``with_ids`` also ids), encoded and decoded in one pass over the rows."""
    keep = keep or []
    names = ["id", *keep, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]

    def run(batches):
        tok = _tokens((ranks_path, pattern))
        for batch in batches:
            counts, digests, texts, ids = [], [], [], []
            for text in batch.column(len(keep) + 1).to_pylist():
                packed = tok.packed(text or "")
                own = np.frombuffer(packed, dtype="<u4")
                counts.append(len(own))
                digests.append(hashlib.sha256(packed).hexdigest())
                texts.append(hashlib.sha256(tok.decode(own.tolist())).hexdigest())
                if with_ids:
                    ids.append(own.view("<i4"))
            columns = [*batch.columns[: len(keep) + 1], pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    own = docs.select(F.col(id_col).cast("long").alias("id"), *keep, F.col(text_col).alias("text"))
    kinds = dict(own.dtypes)
    schema = ", ".join(["id long", *(f"`{c}` {kinds[c]}" for c in keep), "n_tokens long, ids_sha256 string, decoded_sha256 string", *["ids array<int>"] * with_ids])
    return own.mapInArrow(run, schema)
