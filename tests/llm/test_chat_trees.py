"""Reply trees with ids in any order, cycles, repeated ids, ties and long texts, against a plain walk."""

import random

from pyspark.sql import functions as F

from weftlink.llm import chat

SCHEMA = "conv long, node long, parent long, role string, text string, score double"


def formatted(spark, rows, **options):
    made = chat.format_trees(spark.createDataFrame(rows, SCHEMA), **options)
    return made.withColumns({"turns": chat.read_back(F.col("formatted")), "loss": chat.masked_text(F.col("formatted"), F.col("loss_spans"))}).collect()


def walked(rows):
    """(conv, texts) of each root-to-leaf path; a cycle is cut above its smallest node."""
    nodes = {(c, n): (p, t) for c, n, p, _, t, _ in rows}
    up = {(c, n): ((c, p) if (c, p) in nodes else None) for (c, n), (p, _) in nodes.items()}
    for start in sorted(up):
        ring, at = [], start
        while at is not None and at not in ring:
            ring.append(at)
            at = up[at]
        if at is not None:
            up[min(ring[ring.index(at) :])] = None
    inner, out = set(up.values()), []
    for leaf in up:
        if leaf not in inner:
            path, at = [], leaf
            while at is not None:
                path.append(nodes[at][1])
                at = up[at]
            out.append((leaf[0], path[::-1]))
    return sorted(out)


def test_ids_in_any_order_and_cycles(spark):
    rng = random.Random(5)
    rows = []
    for conv in range(25):
        ids = rng.sample(range(-50, 1000), rng.randint(1, 14))
        for n in ids:
            rows.append((conv, n, rng.choice([None, 5000, *ids, *ids]), rng.choice(["user", "assistant"]), f"t{conv}.{n}", 0.0))
    rows += [(90, 50, None, "user", "first", 0.0), (90, 7, 50, "assistant", "reply", 0.0)]
    ring = list(range(200, 213))
    rows += [(91, n, ring[(i + 1) % 13], "user", f"r{n}", 0.0) for i, n in enumerate(ring)] + [(91, 5, 204, "user", "off the ring", 0.0)]
    got = sorted((r.conv, [t.text for t in r.turns]) for r in formatted(spark, rows))
    assert got == walked(rows)
    assert [x for c, x in got if c == 90] == [["first", "reply"]]


def test_repeated_ids_lose_nothing(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "b", 0.0), (1, 2, 1, "assistant", "a", 0.0), (1, 2, 1, "assistant", "a", 0.0), (1, 3, 2, "user", "more", 0.0)]
    got = sorted(([t.text for t in r.turns], r.leaf, r.variant) for r in formatted(spark, rows))
    assert got == [(["q", "a", "more"], 3, 0), (["q", "b"], 2, 1)]


def test_ranks_ties_and_top(spark):
    rows = [(1, 1, None, "user", "q", 1.0)] + [(1, n, 1, "assistant", f"a{n}", s) for n, s in ((9, 2.0), (4, 2.0), (7, None), (5, 3.0))]
    got = sorted((r.branch, r.leaf, r.score) for r in formatted(spark, rows))
    assert got == [(1, 5, 4.0), (2, 4, 3.0), (3, 9, 3.0), (4, 7, 1.0)]
    assert sorted((r.branch, r.leaf, r.loss) for r in formatted(spark, rows, top=2)) == [(1, 5, "a5"), (2, 4, "a4")]


def test_long_texts(spark):
    long = "<|im_end|>\\0\n" * 60_000
    (row,) = formatted(spark, [(1, 1, None, "user", long, 0.0), (1, 2, 1, "assistant", long, 0.0)])
    assert [t.text for t in row.turns] == [long, long] and row.loss == long


def test_no_python_in_the_plan(spark):
    plan = chat.linear(spark.sql("SELECT * FROM VALUES (1L, 0L, 'user', 'x') AS t(conv_id, turn, role, text)"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapPartitions" not in plan
