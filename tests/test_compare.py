"""Candidates over distinct texts and features of distinct pairs, against brute force and the column expressions."""

import random

import pytest

from weftlink.functions import compare
from weftlink.functions.similarity import FEATURES, pair_features
from weftlink.operators import blocking, matching


def _slow(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


@pytest.mark.parametrize("words", [0, 16])
def test_distances(words, monkeypatch):
    monkeypatch.setattr(compare, "WORDS", words)
    rng = random.Random(1)
    text = lambda n: "".join(rng.choice("abcd é") for _ in range(n))
    a = [text(rng.choice([0, 1, 5, 63, 64, 65, 130, 200])) for _ in range(200)]
    b = [text(rng.choice([0, 3, 64, 129])) if rng.random() < 0.5 else "".join(c for c in x if rng.random() > 0.1) for x in a]
    assert compare.distances(a, b).tolist() == [_slow(x, y) for x, y in zip(a, b)]


def test_texts_that_meet_one_text_are_compared_together(monkeypatch):
    """Side by side they don't touch each other, whatever their characters; long ones take a few steps together instead of one run for each."""
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("ab\0é😀") for _ in range(n))
    b = [text(n) for n in (0, 1, 40, 90)]
    pairs = [(text(rng.choice([0, 1, 2, 30, 31, 63, 64, 65])), rng.choice(b)) for _ in range(300)]
    steps = []
    own = compare._distances
    monkeypatch.setattr(compare, "_distances", lambda texts, other: steps.append(len(other)) or own(texts, other))
    assert compare.distances(*map(list, zip(*pairs))).tolist() == [_slow(x, y) for x, y in pairs]
    assert sum(steps) == 1 + 40 + 90


def _records(spark):
    """A hundred copies of one record in each source, whose pairs are never all made, and others that share some words."""
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop") * 3
    rows = [(source, f"S{source}-{i}", "US", "acme tool works", f"{i % 7} main street") for source in (1, 2, 3) for i in range(100)]
    rows += [(source, f"S{source}-{100 + i}", "", " ".join(word() for _ in range(rng.randrange(6))), f"{rng.randrange(9)} {word()} road") for source in (1, 2, 3) for i in range(150)]
    frame = spark.createDataFrame(rows, "source int, entity_id string, country string, norm_name string, norm_address string")
    return frame.filter("source = 1").drop("source"), frame.filter("source > 1").selectExpr("*", "struct(source, entity_id) AS target_row")


def test_pairs_meet_as_texts_only(spark):
    """Scores are those of distinct texts: 100 queries of one text and its 200 targets are one pair of texts, not 20,000 pairs."""
    s1, targets = _records(spark)
    index = blocking.Index(targets, 1.0)
    limits = {"name": 0.18, "address": 0.18}
    asked = s1.withColumnRenamed("entity_id", "source1_entity_id")
    reached = index._reaching(asked.filter("norm_name = 'acme tool works'"), ["source1_entity_id"], ("name",), lambda f, met, rare: True)
    assert reached.count() == 100 and index.scored(reached, limits).count() == 1
    found = index.field_candidates(asked, limits, fields=("name",)).filter("source1_entity_id = 'S1-7'").orderBy("rank").collect()
    assert [r.entity_id for r in found] == sorted(f"S2-{i}" for i in range(100))[:50] and {r.score for r in found} == {1.0}


def test_fields_are_scored_one_at_a_time(spark, monkeypatch):
    """What is dealt by tokens lies on disk for one field at a time, and all fields come out."""
    s1, targets = _records(spark)
    scored, own = [], blocking.written
    monkeypatch.setattr(blocking, "written", lambda df: own(df) if "score" not in df.columns else scored.append(own(df)) or scored[-1])
    found = blocking.Index(targets, 1.0).field_candidates(s1.withColumnRenamed("entity_id", "source1_entity_id"), {"name": 0.18, "address": 0.18})
    assert [{r.field for r in x.select("field").distinct().collect()} for x in scored] == [{"name"}, {"address"}]
    assert {r.field for r in found.select("field").distinct().collect()} == {"name", "address"}


def test_features_are_those_of_the_column_expressions(spark):
    s1, targets = _records(spark)
    ranked = blocking.Index(targets, 1.0).candidates(s1).limit(400).select("source1_entity_id", "entity_id", "rank").localCheckpoint()
    key = lambda r: (r.source1_entity_id, r.entity_id)
    fast = {key(r): r for r in matching.compared(ranked, s1, targets).collect()}
    slow = {key(r): r for r in pair_features(matching.pairs(ranked, s1, targets)).collect()}
    assert fast.keys() == slow.keys() and len(fast) == 400
    assert all(fast[k][f] == pytest.approx(slow[k][f], abs=1e-12) for k in fast for f in FEATURES)
