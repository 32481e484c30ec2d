"""Histograms and distances against plain versions; references that are given, trusted or all there is."""

import math
import random
import unicodedata
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from weftlink.llm import quality

from test_operators import docs

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_classes_match_brute_force():
    rng = random.Random(1)
    names = {"Ll": 0, "Lu": 1, "Lt": 1}
    for _ in range(300):
        text = "".join(rng.choice(["a", "Z", "é", "É", "7", " ", "\n", ".", "«", "#", "€", "😀", "漢", "ß", "\x00", "​", "½", "—", chr(rng.randrange(0xD000)), chr(rng.randrange(0x10000, 0x1F000))]) for _ in range(rng.randrange(50)))
        want = [0] * quality.N_CLASSES
        for c in text:
            kind = unicodedata.category(c)
            want[5 if c in quality.SENTENCE else 4 if c.isspace() or kind[0] == "Z" else names.get(kind, {"L": 2, "M": 2, "N": 3, "P": 6, "S": 6}.get(kind[0], 7))] += 1
        assert quality.class_counts(text).tolist() == want


def test_distance_matches_the_formula():
    rng = random.Random(2)
    for _ in range(100):
        p, qs = [rng.choice([0, rng.random()]) for _ in range(6)], [[rng.choice([0, rng.random()]) for _ in range(6)] for _ in range(3)]
        p[0] += 0.1
        for q, got in zip(qs, quality.distances(np.array(p), np.array(qs))):
            if not sum(q):
                assert got == 1
                continue
            a, b = [x / max(1, sum(p)) for x in p], [x / max(1, sum(q)) for x in q]
            kl = lambda x, y: sum(u * math.log2(u / ((u + v) / 2)) for u, v in zip(x, y) if u)
            assert math.isclose(got, math.sqrt(min(1, max(0, (kl(a, b) + kl(b, a)) / 2))), abs_tol=1e-9)


def corpus(rng):
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(4, 9)))
    prose = lambda n: " ".join(rng.choice(quality.COMMON["en"][:25]) if rng.random() < 0.3 else word() for _ in range(n))
    symbols = lambda n: " ".join(f"€{rng.randrange(999)}#{rng.choice('😀★→')}" for _ in range(n))
    return [(i, prose(200), "en", "s", None) for i in range(30)], [(100 + i, symbols(200), "en", "s", None) for i in range(200)]


def test_trusted_references_hold_against_a_corpus_of_junk(spark):
    good, junk = corpus(random.Random(3))
    rows = spark.createDataFrame(good + junk, SCHEMA)
    kept = lambda **o: {r.id for r in quality.quality(rows, **o).filter("kept").collect()}
    trusted = spark.createDataFrame([(i,) for i in range(10)] + [(None,), (5,)], "doc_id long")
    assert kept(trusted=trusted) == {r[0] for r in good}
    assert kept(references=quality.language_references(rows, trusted=trusted)) == {r[0] for r in good}
    assert {r.doc_id for r in quality.filter_quality(rows, trusted=trusted).collect()} == {r[0] for r in good}
    assert not kept() >= {r[0] for r in good}  # junk is the norm if nothing is trusted
    assert {r[0] for r in good} <= kept(references={})  # without references only the base rules hold


def test_references_count_all_documents(spark):
    good, junk = corpus(random.Random(4))
    rows = spark.createDataFrame(good + [(500, None, "en", "s", None), (501, "bonjour le monde", "xx", "s", None)], SCHEMA)
    got = quality.language_references(rows.repartition(5))
    classes, words = sum(quality.class_counts(t) for _, t, *_ in good), Counter(w for _, t, *_ in good for w in t.split())
    assert got["en"][0].tolist() == classes.tolist() and got["en"][1].sum() == sum(words.values())
    assert got["en"][1][quality.WORDS[b"the"]] == words["the"] and set(got) == {"", "en"}


def test_verdicts_match_the_rule(spark):
    """``kept`` of each row from the definitions: base rules, then distance from the own language's references."""
    good, junk = corpus(random.Random(6))
    rows = spark.createDataFrame(good[:10] + junk[:10] + [(900, "too short", "en", "s", None), (901, "same five words here now " * 30, "en", "s", None), (902, None, "en", "s", None)], SCHEMA)
    references = quality.language_references(docs(spark, [(r[0], r[1]) for r in good]))
    judge = quality.Judge(references, 0.3, None, 200, 50)
    for r in quality.quality(rows, references=references).join(rows.select(F.col("doc_id").alias("id"), "text"), "id").collect():
        counts, common, n = quality.histograms(r.text or "")
        classes = float(quality.distances(counts.astype(float), references["en"][0][None].astype(float))[0]) if counts.sum() >= 200 else 0
        word = float(quality.distances(np.append(common, n - common.sum()).astype(float), references["en"][1][None].astype(float))[0])
        near = n < judge.least[0] or word <= judge.limits[0]
        assert r.kept == (not r.base_failed and classes <= 0.3 and near), r.id
