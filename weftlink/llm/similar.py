"""Near-dedup by SimHash and shingle sets: pigeonhole blocks, min-hash bands, verified exact Jaccard similarity, components.

A document is the set of its shingles' hashes, with the SimHash fingerprint of ``simhash`` over the shingles.
Fingerprints that differ in at most four bits are found by ``simhash.hamming_links``, over the same pigeonhole
blocks as op1's, and are the first candidates. At a similarity of 0.8 few pairs are that close, so bands find
the rest: ``BANDS`` bands of ``ROWS`` minima each make its keys;
a pair at similarity s shares a key with probability 1 - (1 - s^ROWS)^BANDS, which is 1 - 3e-6 at 0.8
and nearer to 1 above, and pairs far below share none. Each candidate is verified on the whole sets.
Equal sets are one member. A first round compares the pairs that fingerprints link, and each member with one leader of each of its keys,
which joins most of what belongs together. In a second round the members of each key whose members are
still in different components are compared across these: a key's members are dealt into chunks, any two
of which meet in one task, which holds their sets and returns a spanning forest of the links, never the
pairs themselves. No pair that shares a key is left out.

Defined results: a null or wordless text has the empty set, which is similar to itself only; ids that
are null or repeated are treated as in ``simhash``; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from .components import components, forest
from .shared import checkpointed

BANDS, ROWS = 32, 5
#: Members of a key that are compared with each other at a time.
CHUNK = 256
_DRAWN = np.random.default_rng(simhash.SEED).integers(0, 1 << 64, (2, BANDS * ROWS, 1), dtype=np.uint64)
_TIMES, _PLUS = _DRAWN[0] | np.uint64(1), _DRAWN[1]


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """The distinct hashes of the text's shingles, sorted."""
    return _set(list(simhash.hashes(text, words)))


def _set(parts: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, dtype="<u8")


def keys(own: np.ndarray) -> list[int]:
    """One signed key for each band; none for the empty set."""
    if not len(own):
        return []
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(own), 512):
        np.minimum(low, (own[at : at + 512] * _TIMES + _PLUS).min(axis=1), out=low)
    return np.array([xxhash.xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(low.reshape(BANDS, ROWS))], dtype=np.uint64).view(np.int64).tolist()


def _signature(own: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(own.tobytes(), simhash.SEED)).view(np.int64))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5) -> DataFrame:
    """(id, sig, fp, size, keys): a hash of the whole set, the fingerprint over its shingles, repeats included, the set's size and the keys of its bands."""

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                parts = list(simhash.hashes(text, words))
                s = _set(parts)
                rows.append((_signature(s), int(np.uint64(simhash.bits(parts)).view(np.int64)), len(s), keys(s)))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names=["id", "sig", "fp", "size", "keys"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, sig long, fp long, size long, keys array<long>")


def _sets(docs: DataFrame, needed: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(sig, own): the sets of the members ``needed`` (sig, rep), once each."""

    def run(batches):
        for batch in batches:
            for text in batch.column(0):  # one by one: sets are larger than texts
                own = shingles(text.as_py(), words)
                yield pa.RecordBatch.from_arrays([pa.array([_signature(own)]), pa.array([own.view(np.int64)], pa.list_(pa.int64()))], names=["sig", "own"])

    texts = docs.join(needed.select(F.col("rep").alias("__rep")).distinct(), F.col(id_col).cast("long") == F.col("__rep"), "left_semi")
    made = texts.select(F.col(text_col).alias("text")).mapInArrow(run, "sig long, own array<long>")
    return made.join(needed, "sig", "left_semi").groupBy("sig").agg(F.first("own").alias("own"))


def _links(mine: np.ndarray, c: np.ndarray, sig: np.ndarray, own: pa.ListArray, least: float) -> tuple[np.ndarray, np.ndarray] | None:
    """A spanning forest of the links between members of different components; if they are of two chunks, of links between these."""
    edges = own.offsets.to_numpy().astype(np.int64)
    values, size, n = own.values.to_numpy()[edges[0] : edges[-1]], np.diff(edges), len(sig)
    wanted = np.triu(c[:, None] != c, 1) & (np.minimum(size[:, None], size) >= least * np.maximum(size[:, None], size) - 1e-6)
    if (mine != mine[0]).any():
        wanted &= mine[:, None] != mine
    if not wanted.any():
        return None
    _, token, count = np.unique(values, return_inverse=True, return_counts=True)
    held = count > 1  # tokens of one member alone are shared with none
    column = np.cumsum(held) - 1
    row, token = np.repeat(np.arange(n), size)[held[token]], column[token[held[token]]]
    by = np.argsort(token, kind="stable")
    row, token = row[by], token[by]
    shared, width = np.zeros((n, n), dtype=np.float32), 4096
    bounds = np.searchsorted(token, np.arange(0, int(held.sum()) + width, width))
    for at, (x, y) in enumerate(zip(bounds, bounds[1:])):
        block = np.zeros((n, width), dtype=np.float32)
        block[row[x:y], token[x:y] - at * width] = 1
        shared += block @ block.T
    shared = shared.astype(np.int64)  # exact: counts below 2^24
    a, b = np.nonzero(wanted & (shared / np.maximum(1, size[:, None] + size - shared) >= least))
    return forest(sig[a], sig[b]) if len(a) else None


def _across(least: float):
    """Over rows (g, mine, c, sig, own) sorted by g: the links of each g."""

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            g = table["g"].to_numpy()
            if not len(g):
                continue
            cut = int(np.searchsorted(g, g[-1]))  # the last group may go on in the next batch
            rest = table.slice(cut)
            yield from groups(table.slice(0, cut))
        if rest is not None:
            yield from groups(rest)

    def groups(table: pa.Table):
        table = table.combine_chunks()
        g = table["g"].to_numpy()
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(g)), dtype=bool), g[1:] != g[:-1]]))
        for x, y in zip(first.tolist(), [*first[1:].tolist(), len(g)]):
            if y - x > 1:
                part = table.slice(x, y - x)
                own = part["own"].combine_chunks()
                own = own.chunk(0) if isinstance(own, pa.ChunkedArray) else own
                if got := _links(*(part[k].to_numpy() for k in ("mine", "c", "sig")), own, least):
                    yield pa.RecordBatch.from_arrays([pa.array(got[0]), pa.array(got[1])], names=["a", "b"])

    return run


def fingerprint_links(known: DataFrame) -> DataFrame:
    """(a, b): sigs of ``known`` (sig, fp, size), a < b, whose SimHash fingerprints differ in at most four bits: edges that connect all that these connect."""
    filled = known.filter("size > 0").select("sig", "fp")
    one = filled.groupBy("fp").agg(F.min("sig").alias("rep"))
    alike = filled.join(one, "fp").filter("sig <> rep").select(F.col("rep").alias("a"), F.col("sig").alias("b"))
    edges = simhash.hamming_links(one).unionByName(alike)
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, least: float = 0.8) -> DataFrame:
    """(id, sig, component): the smallest id reachable over pairs of Jaccard similarity ``least`` or more."""
    prints = checkpointed(signatures(docs, id_col, text_col, words))
    members = checkpointed(prints.groupBy("sig").agg(F.min("id").alias("rep"), F.first("size").alias("size"), F.first("keys").alias("keys"), F.min("fp").alias("fp")))
    known = members.filter("rep is not null")
    keyed = known.select("sig", "rep", "size", F.posexplode("keys").alias("i", "k")).select("sig", "rep", "size", F.xxhash64("i", "k").alias("k"))
    lead = keyed.groupBy("k").agg(F.min_by(F.struct("sig", "size"), F.xxhash64("sig", "k")).alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    near = checkpointed(keyed.join(lead, "k").select("k", "sig", "rep", "size", "lead"))
    close = checkpointed(fingerprint_links(known))
    needed = near.select("sig", "rep").unionByName(known.select("sig", "rep").join(close.select(F.explode(F.array("a", "b")).alias("sig")).distinct(), "sig", "left_semi")).distinct()
    sets = checkpointed(_sets(docs, needed, id_col, text_col, words))
    fits = lambda x, y: F.least(x, y) >= least * F.greatest(x, y) - 1e-6  # noqa: E731  sizes at which the similarity can be reached

    def verified(pairs: DataFrame) -> DataFrame:
        """Of (a, b) those that are similar."""
        both = pairs.join(sets.select(F.col("sig").alias("b"), F.col("own").alias("own_b")), "b").join(sets.select(F.col("sig").alias("a"), F.col("own").alias("own_a")), "a")
        shared = both.select("a", "b", F.size(F.array_intersect("own_a", "own_b")).alias("n"), (F.size("own_a") + F.size("own_b")).alias("of"))
        return checkpointed(shared.filter(F.col("n") / (F.col("of") - F.col("n")) >= least).select("a", "b"))

    ordered = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    led = near.filter((F.col("sig") != F.col("lead.sig")) & fits(F.col("size"), F.col("lead.size"))).select(*ordered(F.col("sig"), F.col("lead.sig"))).distinct()
    links = verified(led.unionByName(close.select("a", "b")).distinct())
    joined = components(links).withColumnsRenamed({"node": "sig", "component": "c"})
    apart = near.join(joined, "sig", "left").select("k", "sig", F.coalesce("c", "sig").alias("c"))
    mixed = apart.groupBy("k").agg(F.min("c").alias("least_c"), F.max("c").alias("most_c"), F.count(F.lit(1)).alias("n")).filter("least_c < most_c").select("k", "n")
    pieces = F.ceil(F.col("n") / CHUNK)
    dealt = apart.join(mixed, "k").withColumn("mine", F.pmod(F.xxhash64("sig", "k"), pieces)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)))
    dealt = dealt.select(F.xxhash64("k", F.least("mine", "other"), F.greatest("mine", "other")).alias("g"), "mine", "c", "sig").join(sets, "sig")
    across = dealt.select("g", "mine", "c", "sig", "own").repartition("g").sortWithinPartitions("g").mapInArrow(_across(least), "a long, b long")
    links = links.unionByName(across)

    of = lambda s: known.select(F.col("sig").alias(s), F.col("rep").alias(f"rep_{s}"))
    edges = links.join(of("a"), "a").join(of("b"), "b").select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))
    return simhash.named(prints, members, edges, "sig")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, least: float = 0.8) -> DataFrame:
    """``docs`` with one row of each component, as in ``simhash.keep_one``."""
    return simhash.kept(docs, similar(docs, id_col, text_col, words, least), id_col)
