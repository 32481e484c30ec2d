"""Sharding by a minimax contiguous partition of ordered atomic groups.

Rows of equal text are one group, which no cut may split; a group is known by the SHA-256 of its
text, and groups stand in the order of these digests. The smallest capacity is found for which a
greedy pass over the group sizes needs no more than the wished number of shards, and the greedy
cuts at that capacity are the shards' bounds.

The sizes never reach the driver one by one. It holds sums over ranges, a range being the groups
whose digests begin alike. A capacity is feasible if the greedy pass that only cuts between ranges
makes do with the shards, and infeasible if even the pass that starts each shard after the range
in which the last one was cut does not. Where neither tells, or a cut lies in a range of several
groups, the ranges between both passes are split by further digits of the digest, until the ranges
that matter hold one group each. The capacity and the cuts are those of the pass over all groups.

Defined results: a null or empty text counts ``overhead`` bytes and is a group with its like;
a group larger than the rest is a shard's whole capacity; fewer groups than shards leave empty
shards; repeated rows lie in one shard with a slot each; an empty table has no rows and no cuts;
a null id is an id like others; other columns are not read. Slots depend on the rows' ids and
texts alone, so every run numbers alike.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import checkpointed, partitions

#: Hex digits of a SHA-256, and of the part of a row's mix that chooses its piece.
DIGITS, MIXED = 64, 4
#: Equal rows are numbered in steps of so many, so that no row is expanded to an unbounded array.
STEP = 1 << 12


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """(id, h, size, crc, n): the group's digest, the bytes, the CRC-32 of the text, and how many rows are alike; one row for each id and text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.sha2(text.cast("binary"), 256).alias("h"),
        (F.octet_length(text).cast("long") + overhead).alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("crc"),
    )
    return rows.groupBy("id", "h").agg(F.first("size").alias("size"), F.first("crc").alias("crc"), F.count(F.lit(1)).alias("n"))


class Ranges:
    """Ranges of digests in order: the digits that begin them, total size, number of groups."""

    def __init__(self, rows: list[tuple[str, int, int]]):
        self.rows = sorted(rows)
        self.sums = [0, *accumulate(r[1] for r in self.rows)]

    def walk(self, capacity: int, shards: int, late: bool) -> list[int]:
        """Where each shard ends: the index of the first range that isn't in it, for up to ``shards`` shards.

        A shard ends before the first range that doesn't fit, which is where the pass over all groups
        ends it or earlier. ``late`` ends it after that range if it has several groups: where the pass
        over all groups ends it or later. The shards suffice if the last end is that of the ranges.
        """
        ends, at, n = [], 0, len(self.rows)
        while at < n and len(ends) < shards:
            at = bisect_right(self.sums, self.sums[at] + capacity) - 1
            if late and at < n and self.rows[at][2] > 1:
                at += 1
            ends.append(at)
        return ends + [at] * (shards - len(ends))

    def least(self, low: int, high: int, shards: int, late: bool) -> int:
        """The smallest capacity from ``low`` on with which the walk comes to the end, ``high`` if none below does."""
        n = len(self.rows)
        while low < high:
            middle = (low + high) // 2
            if self.walk(middle, shards, late)[-1] == n:
                high = middle
            else:
                low = middle + 1
        return low


def minimax_cuts(split: Callable[[list[str], int], list[tuple[str, int, int]]], largest: int, shards: int, digits: int = 3) -> tuple[int, list[str]]:
    """(capacity, what begins the first digest of shards 1, 2, ...), shards that need no rows left out.

    ``split(heads, k)``: (first k digits, size, groups) of the groups whose digests begin with one of
    ``heads``, all of one length; ``largest``: the largest group's size.
    """
    now = Ranges(split([""], digits))
    n = len(now.rows)
    if not n:
        return 0, []
    low, high = max(-(-now.sums[-1] // shards), largest), now.sums[-1]
    while True:
        low = now.least(low, high, shards, late=True)  # no capacity below suffices
        high = now.least(low, high, shards, late=False)  # this one does
        # the ends of the pass over all groups, for every capacity in between, lie between these
        first, last = now.walk(low, shards, late=False), now.walk(high, shards, late=True)
        unsure = {i for a, b in zip(first, last) for i in range(a, min(b, n - 1) + 1) if now.rows[i][2] > 1}
        if not unsure:
            if low != high:
                raise AssertionError("the ranges that matter hold one group each, but the capacity is open")
            return low, [now.rows[i][0] for i in sorted(set(first)) if i < n]
        rows = [r for i, r in enumerate(now.rows) if i not in unsure]
        for length in sorted({len(now.rows[i][0]) for i in unsure}):
            heads = [now.rows[i][0] for i in unsure if len(now.rows[i][0]) == length]
            rows += split(heads, min(DIGITS, length + (2 if 256 * len(heads) <= 1 << 15 else 1)))
        now = Ranges(rows)
        n = len(now.rows)


def minimax(groups: DataFrame, shards: int) -> tuple[int, list[str]]:
    """``groups`` (h, size), h unique -> as ``minimax_cuts``. The first ranges are of three digits, or of more if the shards are many."""
    spark = groups.sparkSession

    def split(heads: list[str], k: int) -> list[tuple[str, int, int]]:
        own = groups.select(F.substring("h", 1, k).alias("f"), "size")
        if heads != [""]:  # ranges of which a shard may end in one: by far fewer than all, whatever the input
            length = len(heads[0])
            table = spark.createDataFrame([(x,) for x in heads], "head string")
            own = own.join(F.broadcast(table), F.substring("f", 1, length) == F.col("head"), "left_semi")
        return [tuple(r) for r in own.groupBy("f").agg(F.sum("size"), F.count(F.lit(1))).collect()]

    digits = 3
    while 16**digits < 32 * shards:
        digits += 1
    return minimax_cuts(split, groups.agg(F.max("size")).first()[0] or 0, shards, digits)


def slots(rows: DataFrame, pieces: int) -> DataFrame:
    """``rows`` (id, h, shard, n, ...) with ``slot``, each row n times: gapless from 0 in each shard, in the order of a mix of text and id.

    A shard is numbered in pieces, each by its own task; rows that are alike are counted, not moved.
    """
    mix = F.md5(F.concat_ws(":", F.col("h"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"))
    piece = F.floor(F.conv(F.substring("mix", 1, MIXED), 16, 10).cast("long") * pieces / 16**MIXED)
    dealt = rows.withColumn("mix", mix).withColumn("piece", piece)
    counts = dealt.groupBy("shard", "piece").agg(F.sum("n").alias("m"))  # shards x pieces rows
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "piece", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("offset"))
    own = Window.partitionBy("shard", "piece").orderBy("mix", "id", "h").rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.withColumn("own", F.coalesce(F.sum("n").over(own), F.lit(0))).join(offsets, ["shard", "piece"]).withColumn("from", F.col("offset") + F.col("own"))
    stepped = first.withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / STEP))))
    last = F.least(F.col("n"), (F.col("step") + 1) * STEP) - 1
    return stepped.withColumn("slot", F.explode(F.sequence(F.col("step") * STEP, last))).withColumn("slot", F.col("from") + F.col("slot")).drop("mix", "piece", "own", "offset", "from", "step", "n")


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """(id, h, size, crc, shard, slot)."""
    rows = checkpointed(sized(docs, id_col, text_col, overhead))
    groups = checkpointed(rows.groupBy("h").agg(F.sum(F.col("size") * F.col("n")).alias("size")))
    _, firsts = minimax(groups, shards)
    number = F.size(F.filter(F.array(*map(F.lit, firsts)), lambda f: f <= F.col("h"))) if firsts else F.lit(0)
    return slots(rows.withColumn("shard", number.cast("int")), max(64, partitions(docs)))
