"""Line dedup: later copies of repeated runs of lines are deleted.

The corpus is a sequence of line ids for each document (lines without a word left out). Suffixes
are ranked by distributed prefix doubling: the rank of the first 2h lines is made of the ranks
of the first h and of the h that follow, and is named by the first position that has it
(documents in order of id). Only suffixes that begin with lines that occur again take part, and
a rank that a single position has drops out, so each round is smaller than the last. A line of
very many positions is dealt over several tasks.

A run of lines counts if it has ``min_words`` words or more. Suffixes whose first m lines agree
are an interval of the suffix array with a common prefix of m at least; two ranks, of the first
and of the last 2^k of the m lines, tell them apart. It is enough to look at the shortest runs
with enough words, forward from a line or backward from it: each line of a repeated run lies in
one of them, and their unions are the maximal repeated runs. All positions but the first in an
interval lose the run's lines. Doubling ends once the ranks reach the longest of the shortest
runs, which has at most ``min_words`` lines.

Defined results: a null text stays null and has no lines; a null id comes after all others;
rows that repeat (id and text) are one document; a run may repeat within a document; blank lines
stay unless they lie in a deleted run; all columns are kept, those named n_lines and
removed_lines being replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import checkpointed, joined_back, row_key

LAST = (1 << 63) - 1


def counted(text: str) -> list[tuple[int, bytes, int]]:
    """(line number, line, words) of the lines that have a word."""
    return [(i, raw, n) for i, raw in enumerate(text.encode().split(b"\n")) if (n := len(raw.split()))]


def shortest_runs(sizes: list[int], least: int) -> list[set[int]]:
    """For each line the lengths of the runs that begin with it and are the shortest with ``least`` words, forward or backward."""
    out: list[set[int]] = [set() for _ in sizes]
    end, words = 0, 0
    for start in range(len(sizes)):  # forward
        while end < len(sizes) and words < least:
            words += sizes[end]
            end += 1
        if words >= least:
            out[start].add(end - start)
        words -= sizes[start]
    start, words = len(sizes), 0
    for end in range(len(sizes), 0, -1):  # backward
        while start > 0 and words < least:
            start -= 1
            words += sizes[start]
        if words >= least:
            out[start].add(end - start)
        words -= sizes[end - 1]
    return out


def line_table(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(o, k, i, h1, h2, runs): a row for each line with a word; (o, k, i) is its position, h1 and h2 its 128-bit hash."""

    def run(batches):
        for batch in batches:
            o, k, i, h, runs = [], [], [], [], []
            for order, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                lines = counted(text)
                o += [order] * len(lines)
                k += [key] * len(lines)
                i += range(len(lines))
                h += [xxhash.xxh3_128_digest(raw) for _, raw, _ in lines]
                runs += [sorted(x) for x in shortest_runs([n for *_, n in lines], min_words)]
            for at in range(0, len(o), 50_000):
                cut = slice(at, at + 50_000)
                both = np.frombuffer(b"".join(h[cut]), dtype="<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(o[cut], pa.int64()), pa.array(k[cut], pa.int64()), pa.array(i[cut], pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(runs[cut], pa.list_(pa.int32()))],
                    names=["o", "k", "i", "h1", "h2", "runs"],
                )

    own = docs.filter(F.col(text_col).isNotNull()).select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("o"), row_key(id_col, text_col).alias("k"), F.col(text_col))
    return own.mapInArrow(run, "o long, k long, i long, h1 long, h2 long, runs array<int>")


def _first(frame: DataFrame, keys: list[str], rows: int | None = None) -> DataFrame:
    """``frame`` with ``r``, the first position among rows with equal keys; rows whose keys no other row has are left out. ``rows``, where hot keys are to be dealt: how many there are."""
    low = frame.groupBy(*keys).agg(F.min(F.struct("o", "k", "i")).alias("r"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return frame.join(low.drop("n"), keys) if rows is None else joined_back(frame, checkpointed(low), keys, rows, ["o", "k", "i"])


def later_copies(lines: DataFrame, min_words: int) -> DataFrame:
    """(o, k, i, m): runs of m lines from line i on that also stand at an earlier position."""
    level = checkpointed(_first(lines, ["h1", "h2"], lines.count()).select("o", "k", "i", "r", "runs").distinct())
    runs = level.select("o", "k", "i", F.explode("runs").alias("m"))
    rank, out, size = level.select("o", "k", "i", "r"), None, 1
    while True:
        here = runs.filter((F.col("m") >= size) & (F.col("m") < 2 * size)).join(rank, ["o", "k", "i"])
        ends = rank.select("o", "k", (F.col("i") + size).alias("stop"), F.col("r").alias("tail"))
        pairs = here.withColumn("stop", F.col("i") + F.col("m")).join(ends, ["o", "k", "stop"])
        named = _first(pairs.select("o", "k", "i", "m", F.col("r").alias("front"), "tail"), ["m", "front", "tail"])
        found = named.filter("struct(o, k, i) <> r").select("o", "k", "i", "m")
        out = found if out is None else out.unionByName(found)
        if 2 * size > min_words:
            return out
        ahead = rank.select("o", "k", (F.col("i") - size).alias("i"), F.col("r").alias("tail"))
        both = rank.withColumnRenamed("r", "front").join(ahead, ["o", "k", "i"])
        rank = checkpointed(_first(both, ["front", "tail"]).select("o", "k", "i", "r"))
        size *= 2


def without(text: str, runs: list[tuple[int, int]]) -> tuple[str, list[int], int]:
    """(text without the runs of lines that have words, numbers of the deleted lines, lines before)."""
    lines, full = text.split("\n"), [i for i, *_ in counted(text)]
    gone = np.zeros(len(lines) + 1, dtype=np.int64)
    for i, m in runs:
        gone[full[i]] += 1
        gone[full[i + m - 1] + 1] -= 1
    gone = np.cumsum(gone[:-1]) > 0
    return "\n".join(x for x, g in zip(lines, gone) if not g), np.flatnonzero(gone).tolist(), len(lines)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 10) -> DataFrame:
    """``docs`` with the lines deleted, n_lines (before) and removed_lines (their numbers, from 0)."""
    docs = docs.drop("n_lines", "removed_lines")
    lines = checkpointed(line_table(docs, id_col, text_col, min_words))
    spans = later_copies(lines, min_words).groupBy("o", "k").agg(F.collect_list(F.struct("i", "m")).alias("__runs"))
    spans = checkpointed(spans)
    own = docs.withColumns({"__o": F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)), "__k": row_key(id_col, text_col)})
    found = spans.withColumnsRenamed({"o": "__o", "k": "__k"})
    marked = own.join(found, ["__o", "__k"], "left").select(*docs.columns, "__runs")
    at, width = docs.columns.index(text_col), len(docs.columns)
    kept = docs.columns

    def run(batches):
        for batch in batches:
            texts, removed, counts = [], [], []
            for text, runs in zip(batch.column(at).to_pylist(), batch.column(width).to_pylist()):
                new, gone, n = (text, [], (text.count("\n") + 1) if text is not None else 0) if not runs else without(text, [(r["i"], r["m"]) for r in runs])
                texts.append(new)
                removed.append(gone)
                counts.append(n)
            columns = list(batch.columns[:width])
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(removed, pa.list_(pa.int64()))], names=[*kept, "n_lines", "removed_lines"])

    schema = docs.limit(0).withColumns({"n_lines": F.lit(None).cast("long"), "removed_lines": F.lit(None).cast("array<bigint>")}).schema
    return marked.mapInArrow(run, schema)
