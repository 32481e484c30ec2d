"""The pipeline's near-dedup against a brute-force version."""

import random

import corpus_pipeline
from weftlink.llm import similar

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sets(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_dedup_reaches_similarity_of_four_fifths(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = [(0, None), (1, ""), (2, "one two"), (3, "One  two")]
    for _ in range(60):
        base = [word() for _ in range(rng.choice([40, 150, 400]))]
        rows.append((len(rows), " ".join(base)))
        for _ in range(rng.randrange(4)):
            copy = list(base)
            for _ in range(rng.randrange(1, 1 + len(base) // 30)):
                copy[rng.randrange(len(copy))] = word()
            copy += [word() for _ in range(rng.randrange(12))]
            rows.append((len(rows), " ".join(copy)))
    own = {d: sets(t) for d, t in rows}
    alike = [(a, b) for a in own for b in own if a < b and (own[a] == own[b] or len(own[a] & own[b]) >= 0.8 * len(own[a] | own[b]))]
    assert sum(len(own[a] & own[b]) < 0.9 * len(own[a] | own[b]) for a, b in alike) > 15
    label = {d: d for d in own}
    while any(label[a] != label[b] for a, b in alike):
        for a, b in alike:
            label[a] = label[b] = min(label[a], label[b])
    docs = spark.createDataFrame([(d, t, "en", "s", None) for d, t in rows], SCHEMA)
    assert {r.id: r.component for r in similar.similar(docs).collect()} == label
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == {d for d in label if label[d] == d}
    assert similar.similar(docs.limit(0)).collect() == []


def test_large_groups_lose_no_link(spark, monkeypatch):
    """Hundreds of copies of one text, many of them less similar to each other than 0.8, in chunks of eight."""
    monkeypatch.setattr(similar, "CHUNK", 8)
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(120)]
    rows = []
    for i in range(220):
        copy = list(base)
        for at in rng.sample(range(len(copy)), rng.choice([1, 2, 3, 4, 5])):
            copy[at] = word()
        rows.append((i, " ".join(copy)))
    own = {d: sets(t) for d, t in rows}
    alike = [(a, b) for a in own for b in own if a < b and len(own[a] & own[b]) >= 0.8 * len(own[a] | own[b])]
    label = {d: d for d in own}
    while any(label[a] != label[b] for a, b in alike):
        for a, b in alike:
            label[a] = label[b] = min(label[a], label[b])
    assert len(set(label.values())) > 20
    docs = spark.createDataFrame([(d, t, "en", "s", None) for d, t in rows], SCHEMA)
    assert {r.id: r.component for r in similar.similar(docs).collect()} == label


def test_fingerprints_are_joined_in_blocks(spark):
    """The stage's SimHash step links what differs in four bits or fewer, by the blocks that op1 uses."""
    rng = random.Random(3)
    base = [" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)) for _ in range(12)]
    docs = spark.createDataFrame([(10 * i + k, t + " more" * k, "en", "s", None) for i, t in enumerate(base) for k in (0, 1)] + [(900, "", "en", "s", None)], SCHEMA)
    prints = similar.signatures(docs).collect()
    wanted = {tuple(sorted((p.sig, q.sig))) for p in prints for q in prints if p.sig < q.sig and p.size and q.size and ((p.fp ^ q.fp) & (1 << 64) - 1).bit_count() <= 4}
    members = similar.signatures(docs)
    assert len(wanted) >= 12 and {(r.a, r.b) for r in similar.fingerprint_links(members).collect()} == wanted
