"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A window is ``window`` consecutive words of an item (the whole item if it has fewer). Its
shingles of up to ``shingle`` words are ordered by rarity, that is by how many documents hold
them. Exact containment needs all of them, so a prefix of one, the rarest, is enough to find
every candidate. A document position with that shingle gives the only start at which the
window can lie (positional bound); starts before the text or windows that run past its end are
out (length bound); the rest is verified word by word.

The benchmark is read in blocks of at most ``block`` windows, whose index alone is broadcast (a longer
item is parted, its windows whole); each block is matched against all documents. With one block this is
two passes over the documents and no shuffle of them; with more, only what was hit in a text, under a
digest of the text, is written down for each block and joined at the end. No word of a hot passage is
ever a join key.

Defined results: a null text or item has no words; an item without words has no window; equal
items under several ids all count; a null item id never names an item but its windows are hit.
Rows are independent, so repeated ones give repeated results; texts of any length are taken whole; an
empty table has no rows, an empty benchmark hits nothing; all columns are kept, the operator's own
being named hit_spans, n_words and items (an input column of such a name is replaced).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import checkpointed

#: A-Z in lower case; a space for each ASCII character that is no letter or digit. Bytes of other characters stay.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
MUL = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """The words in UTF-8: runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``, A-Z lower-cased before."""
    return text.encode().translate(PLAIN).split() if text else []


class Index:
    """The windows of a block of items. After ``order`` it also has each window's rarest shingle."""

    def __init__(self, items: list[tuple], window: int, shingle: int):
        self.vocabulary: dict[bytes, int] = {}
        self.windows: dict[tuple[int, ...], list] = defaultdict(list)
        for item, part in items:
            own = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in part]
            for i in range(max(1, len(own) - window + 1) if own else 0):
                got = self.windows[tuple(own[i : i + window])]
                if item is not None and item not in got:
                    got.append(item)
        self.shingles: dict[tuple[int, ...], int] = {}
        for w in self.windows:
            k = min(shingle, len(w))
            for i in range(len(w) - k + 1):
                self.shingles.setdefault(w[i : i + k], len(self.shingles))
        self.shingle = shingle
        self._keys({s: s for s in self.shingles})

    def _keys(self, heads: dict) -> None:
        """heads: what is to be found in documents, by shingle."""
        self.heads = heads
        self.lengths = {}
        for k in sorted({len(s) for s in heads}):
            of = [s for s in heads if len(s) == k]
            keys = self.hashed(np.array([s for s in of], dtype=np.uint64).T)
            self.lengths[k] = np.unique(keys)

    @staticmethod
    def hashed(columns) -> np.ndarray:
        h = np.zeros(len(columns[0]), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for c in columns:
                h = (h ^ c) * MUL
                h ^= h >> np.uint64(29)
        return h

    def order(self, frequency: dict[int, int]) -> None:
        """Keeps each window's rarest shingle, the first such on a tie."""
        heads = defaultdict(list)
        for w in self.windows:
            k = min(self.shingle, len(w))
            at = min(range(len(w) - k + 1), key=lambda i: (frequency.get(self.shingles[w[i : i + k]], 0), i))
            heads[w[at : at + k]].append((at, w))
        self._keys(dict(heads))

    def places(self, ids: np.ndarray) -> Iterator[tuple[int, tuple]]:
        """(position, shingle) of all heads in a document."""
        known = ids > 0
        if not known.any():
            return
        run = np.concatenate([[0], np.cumsum(known)])
        for k, keys in self.lengths.items():
            n = len(ids) - k + 1
            if n < 1:
                continue
            at = np.flatnonzero(run[k:] - run[:-k] == k)
            if not len(at):
                continue
            h = self.hashed([ids[at + i] for i in range(k)])
            pos = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            for p in at[keys[pos] == h].tolist():
                s = tuple(ids[p : p + k].tolist())
                if s in self.heads:
                    yield p, s

    def ids(self, own: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, own, repeat(0)), dtype=np.uint64, count=len(own))

    def hits(self, ids: np.ndarray) -> tuple[list[list[int]], set]:
        """(merged spans of hit words, items with an occurring window)."""
        spans, items = [], set()
        for p, s in self.places(ids):
            for at, w in self.heads[s]:
                start = p - at
                if start >= 0 and start + len(w) <= len(ids) and tuple(ids[start : start + len(w)].tolist()) == w:
                    spans.append((start, start + len(w)))
                    items.update(self.windows[w])
        return merged(spans), items


def merged(spans: list) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block: int) -> Iterator[list[tuple]]:
    """The items' words, as many at a time as have ``block`` windows; one partition at a time reaches the driver."""
    now, n = [], 0
    for item, text in benchmark.select(F.col(item_col).cast("string"), text_col).toLocalIterator():
        own = words(text)
        for at in range(0, max(1, len(own) - window + 1) if own else 0, block):
            part = own[at : at + block + window - 1]
            size = max(1, len(part) - window + 1)
            if now and n + size > block:
                yield now
                now, n = [], 0
            now.append((item, part))
            n += size
    if now:
        yield now


def _frequency(docs: DataFrame, text_col: str, shared) -> dict[int, int]:
    """In how many documents each shingle of the block occurs; those that occur nowhere are left out."""

    def run(batches):
        index, got = shared.value, defaultdict(int)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for s in {s for _, s in index.places(index.ids(words(text)))}:
                    got[index.shingles[s]] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.int64()), pa.array(list(got.values()), pa.int64())], names=["s", "n"])

    counts = docs.select(text_col).mapInArrow(run, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
    return dict(map(tuple, counts.collect()))  # as many rows as the block has shingles, at most


def hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10, shingle: int = 5, block: int = 200_000) -> DataFrame:
    """``docs`` with n_words, hit_spans (merged [start, end) in words) and items (sorted ids of items with occurring windows)."""
    spark = docs.sparkSession
    now = docs.drop("n_words", "hit_spans", "items")
    kept = now.columns
    none = {"hit_spans": F.expr("cast(array() as array<array<bigint>>)"), "items": F.expr("cast(array() as array<string>)")}
    blocks = _blocks(benchmark, item_col, item_text_col, window, block)
    first, found = Index(next(blocks, []), window, shingle), None
    key = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    for items in blocks:
        texts = now.select(key.alias("k"), F.col(text_col).alias("text"))
        more = _matched(spark, now, texts.withColumns({"n_words": F.lit(None).cast("long"), **none}), ["k", "text"], "text", text_col, Index(items, window, shingle))
        more = checkpointed(more.filter(F.size("hit_spans") > 0).select("k", "hit_spans", "items").distinct())
        found = more if found is None else found.unionByName(more)
    if found is None:
        return _matched(spark, now, now.withColumns({"n_words": F.lit(None).cast("long"), **none}), kept, text_col, text_col, first)
    found = found.groupBy("k").agg(F.flatten(F.collect_list("hit_spans")).alias("s"), F.flatten(F.collect_list("items")).alias("i"))  # as many as there are blocks
    joined = now.select("*", key.alias("__k")).join(found.withColumnsRenamed({"k": "__k", "s": "__s", "i": "__i"}), "__k", "left").select(*kept, F.lit(None).cast("long").alias("n_words"), F.coalesce("__s", none["hit_spans"]).alias("hit_spans"), F.coalesce("__i", none["items"]).alias("items"))
    return _matched(spark, now, joined, kept, text_col, text_col, first)


def _matched(spark, docs: DataFrame, now: DataFrame, kept: list[str], text_col: str, docs_text: str, index: Index) -> DataFrame:
    """``now`` (the columns of ``kept``, n_words, hit_spans, items) with the words counted and the hits of a block added; ``docs`` are all documents."""
    if index.windows:
        index.order(_frequency(docs, docs_text, spark.sparkContext.broadcast(index)))
    shared, at, width = spark.sparkContext.broadcast(index), kept.index(text_col), len(kept)

    def run(batches):
        index = shared.value
        for batch in batches:
            counts, spans, found = [], [], []
            for text, s, i in zip(batch.column(at).to_pylist(), batch.column(width + 1).to_pylist(), batch.column(width + 2).to_pylist()):
                w = words(text)
                more, new = index.hits(index.ids(w)) if index.windows else ([], set())
                counts.append(len(w))
                spans.append(merged(s + more) if s else more)
                found.append(sorted({*i, *new}))
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(found, pa.list_(pa.string()))], names=[*batch.schema.names[:width], "n_words", "hit_spans", "items"])

    return now.mapInArrow(run, now.schema)
