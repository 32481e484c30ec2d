"""SimHash near-dedup: fingerprints, pigeonhole blocks, verified Hamming links, components.

Two fingerprints that differ in at most ``distance`` bits leave at least ``agree`` of
``distance + agree`` blocks of bits untouched. Every choice of ``agree`` blocks makes one key,
so close pairs share a key, and a key is wide enough (27 bits for 4 and 3) that chance
companions stay few as the corpus grows. Tables that grow with the input are merged, never
broadcast: estimates know neither compression nor how many keys a row makes. Equal fingerprints are one member, so that copies
never meet each other; a key with more than ``chunk`` members is cut into chunks, whose pairs
go to different tasks. No member is left out.

Defined results: a null or wordless text has fingerprint zero and links like any other; a row
whose id is null keeps its fingerprint and takes the component of the rows that share it (null
if they have none); repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, forest
from .shared import checkpointed

SEED = 42


def hashes(text: str | None, words: int) -> Iterator[np.ndarray]:
    """The hashes of the shingles of ``words`` words, over the whole text, in pieces; nothing for a wordless text."""
    parts = text.encode().lower().split() if text else []  # bytes: A-Z only, and the six ASCII white-space characters
    if not parts:
        return
    joined = b" ".join(parts)
    ends = list(accumulate((len(p) + 1 for p in parts)))
    starts = [0, *ends[:-1]]
    width = min(words, len(parts))
    n = len(parts) - width + 1
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 16):
        to = min(n, at + (1 << 16))
        yield np.array([digest(joined[s : e - 1], SEED) for s, e in zip(starts[at:to], ends[at + width - 1 : to + width - 1])], dtype="<u8")


def fingerprint(text: str | None, words: int = 4) -> int:
    """The 64-bit SimHash of the shingles of ``words`` words."""
    return bits(hashes(text, words))


def bits(parts: Iterable[np.ndarray]) -> int:
    """The fingerprint of hashes in pieces: each bit that more than half of them have."""
    n, ones = 0, np.zeros(64, dtype=np.int64)
    for h in parts:
        n += len(h)
        ones += np.add.reduce(np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """(id, fp): the fingerprint as a signed 64-bit number."""

    def run(batches):
        for batch in batches:
            out = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], names=["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, fp long")


def masks(distance: int, agree: int) -> list[int]:
    """One mask for each choice of ``agree`` of ``distance + agree`` blocks of the 64 bits."""
    n = distance + agree
    edges = [round(i * 64 / n) for i in range(n + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(blocks, agree)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _close(distance: int):
    """Over rows (g, fp, rep) sorted by g: the links within each g, as stars."""

    def links(g, fp, rep):
        held_a, held_b, held = [], [], 0
        for d in range(1, len(g)):
            same = g[d:] == g[:-d]
            if not same.any():
                break
            at = np.flatnonzero(same & (np.bitwise_count(fp[d:] ^ fp[:-d]) <= distance))
            if len(at):
                held_a.append(rep[at])
                held_b.append(rep[at + d])
                held += len(at)
            if held > 1 << 20:
                a, b = forest(np.concatenate(held_a), np.concatenate(held_b))
                held_a, held_b, held = [a], [b], len(a)
        if not held:
            return None
        a, b = forest(np.concatenate(held_a), np.concatenate(held_b))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches):
        rest = None
        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            now[1] = now[1].view(np.uint64)
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now)]
            if not len(now[0]):
                continue
            cut = int(np.searchsorted(now[0], now[0][-1]))  # the last group may go on in the next batch
            rest = [x[cut:] for x in now]
            if cut and (out := links(*(x[:cut] for x in now))):
                yield out
        if rest is not None and (out := links(*rest)):
            yield out

    return run


def hamming_links(members: DataFrame, distance: int = 4, agree: int = 3, chunk: int = 512) -> DataFrame:
    """``members`` (rep, fp), fp unique -> (a, b): edges that connect exactly what links of up to ``distance`` bits connect.

    A group of a key is handled in pieces of at most two chunks, each giving a spanning star
    of its links rather than all its pairs.
    """
    key = F.explode(F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(masks(distance, agree))]))
    keyed = members.select("rep", "fp", key.alias("k"))
    shared = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    pieces = F.ceil(F.col("n") / chunk)
    own = F.pmod(F.xxhash64("fp", "k"), pieces)
    spread = keyed.join(shared.hint("merge"), "k").select("rep", "fp", "k", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("other"))
    dealt = spread.select(F.xxhash64("k", F.least("own", "other"), F.greatest("own", "other")).alias("g"), "fp", "rep")
    return dealt.repartition("g").sortWithinPartitions("g").mapInArrow(_close(distance), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, distance: int = 4, agree: int = 3) -> DataFrame:
    """(id, fp, component): each row's fingerprint and the smallest id reachable over links of up to ``distance`` bits."""
    prints = checkpointed(fingerprints(docs, id_col, text_col, words))
    members = prints.groupBy("fp").agg(F.min("id").alias("rep"))
    return named(prints, members, hamming_links(members.filter("rep is not null"), distance, agree), "fp")


def named(prints: DataFrame, members: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """(id, key, component) of ``prints``, whose ``key`` has ``rep`` in ``members``; ``edges`` (a, b) link reps."""
    # ids that stand on several rows with different texts join these texts: the row's id is the node
    ties = prints.filter("id is not null").groupBy("id").agg(F.min(key).alias("one"), F.max(key).alias("other")).filter("one <> other").select("id")
    multi = prints.join(ties.hint("merge"), "id", "left_semi").join(members.hint("merge"), key).select(F.col("id").alias("a"), F.col("rep").alias("b"))
    grouped = components(edges.unionByName(multi)).withColumnsRenamed({"node": "rep", "component": "found"})
    found = members.join(grouped.hint("merge"), "rep", "left").select(key, F.coalesce("found", "rep").alias("component"))
    return prints.join(found.hint("merge"), key, "left").select("id", key, "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, distance: int = 4, agree: int = 3) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (of rows that share it one; of rows without any id, all stay)."""
    return kept(docs, near_duplicates(docs, id_col, text_col, words, distance, agree), id_col)


def kept(docs: DataFrame, found: DataFrame, id_col: str) -> DataFrame:
    """``docs`` with one row of each component of ``found`` (id, component)."""
    gone = checkpointed(found.filter("component < id").select(F.col("id").alias("__id")).distinct())
    left = docs.join(gone, docs[id_col] == F.col("__id"), "left_anti")
    twice = checkpointed(found.filter("component = id").groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("id").alias("__id")))
    if twice.isEmpty():
        return left
    many = left.join(twice, left[id_col] == F.col("__id"), "left_semi").dropDuplicates([id_col])
    return left.join(twice, left[id_col] == F.col("__id"), "left_anti").unionByName(many)
