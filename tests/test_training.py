import inspect
import random

from pyspark.sql import functions as F

from weftlink.operators import learn
from weftlink.plans import catalog


def test_train_score_leaves_out_no_round_and_no_target(spark, monkeypatch):
    seen = {}
    fit, pool = learn.fit, learn.negative_pool
    rounds = inspect.signature(fit).parameters["iterations"].default

    def few(rows, **options):
        seen["rounds"] = options.pop("iterations", rounds)
        return fit(rows, iterations=2, **options)

    def all_of(targets, *limits):
        seen["limits"] = inspect.signature(pool).bind(targets, *limits)
        seen["limits"].apply_defaults()
        found = pool(targets, *limits)
        seen["left out"] = targets.count() - found.count()
        return found

    monkeypatch.setattr(learn, "fit", few)
    monkeypatch.setattr(learn, "negative_pool", all_of)
    assert catalog.QUERIES["train_score"](spark, "/root/testdata/sf0.001").count() == 24
    limits = seen["limits"].arguments
    assert (rounds, seen["rounds"], limits["step"], limits["cap"], seen["left out"]) == (180, 180, 1, None, 0)


def test_a_pool_without_a_cap_has_all_targets(spark):
    targets = spark.range(learn.POOL_CAP + 5000).select(F.col("id").cast("string").alias("entity_id"))
    pool = learn.negative_pool(targets, 1, None)
    assert pool.count() == learn.POOL_CAP + 5000 and learn.negative_pool(targets, 1).count() == learn.POOL_CAP
    places = {r.entity_id: r.at for r in learn.numbered(pool).collect()}
    assert places == {x: i for i, x in enumerate(sorted(places))} and len(places) == learn.POOL_CAP + 5000
    assert learn.numbered(pool.limit(0)).count() == 0


def test_hard_negatives_match_brute_force(spark):
    rng = random.Random(11)
    words = [f"word{i}" for i in range(60)] + ["the", "of"]
    text = lambda most: list(dict.fromkeys(rng.choice(words) for _ in range(rng.randint(0, most))))
    place = lambda: rng.choice(["US", "France", "", None])
    pool = [(f"t{i:03}", place(), text(4)) for i in range(90)] + [("t007", "India", ["word1", "word2"])]  # an id of two sources
    queries = [(f"q{i}", place(), rng.sample([p[0] for p in pool], rng.randint(0, 3)), [f"none{j}" for j in range(rng.choice([0, 0, 9]))] + text(25)) for i in range(80)]
    index = {}
    for id_, country, tokens in sorted(pool, key=lambda p: p[0]):
        for t in tokens:
            if len(t) > learn.TOKEN_LENGTH:
                index.setdefault(t, []).append((id_, country))
    want = {}
    for most in (1, 6):
        for q, own, true, tokens in queries:
            found = [x for t in tokens for x, c in index.get(t, [])[: learn.PER_TOKEN] if x not in true and (not own or not c or own == c)]
            want[most, q] = set(list(dict.fromkeys(found))[:most])
    asked = spark.createDataFrame(queries, "source1_entity_id string, country string, true_ids array<string>, name_tokens array<string>")
    targets = spark.createDataFrame(pool, "entity_id string, country string, name_tokens array<string>")
    for most in (1, 6):
        got = {q[0]: set() for q in queries}
        for r in learn.hard_negatives(asked, targets, "name", most).collect():
            got[r.source1_entity_id].add(r.entity_id)
        assert got == {q: x for (m, q), x in want.items() if m == most}
