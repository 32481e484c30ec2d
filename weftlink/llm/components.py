"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import checkpointed


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges (a, b) as stars: (smallest member, other member) of each component that they form."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    other = label != np.arange(len(ids))
    return ids[label[other]], ids[other]


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b), both not null -> (node, component): the smallest node each node is connected with.

    Only nodes that stand in an edge to another node are returned. Both steps aggregate a minimum
    (combined on the map side) and join it back: a hub's edges stream through one task's sort-merge
    join, but are never held there, nor is a table broadcast through the driver; the rounds needed grow with the logarithm of the size of a component.
    """
    now = checkpointed(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct())
    sign = _sign(now)
    while sign[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low.hint("merge"), "u").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(low.hint("merge"), "b")
        small = joined.select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b")), F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
        now = checkpointed(small.filter("a <> b").distinct())
        last, sign = sign, _sign(now)
        if last == sign:
            break
    stars = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return stars.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
