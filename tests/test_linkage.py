import itertools
import random

import pytest
from pyspark.sql import functions as F

from weftlink.functions import dicts
from weftlink.functions.normalize import normalize, normalized_name, without_legal_forms
from weftlink.functions.similarity import FEATURES, pair_features, profile
from weftlink.operators import blocking, learn, matching, metrics
from weftlink.plans.resolve import resolve
from weftlink.sources import tables

NAMES = {
    "Shree Krishna Medical Store Pvt. Ltd.": "shree krishna medical store", "Apple Inc.": "apple", "Obsidian, LLC": "obsidian", "Obsidian,-LLC": "obsidian",
    "Obsidian, [[LLC]]": "obsidian", "[Corp] Dick Regional Armada": "dick regional armada", "LLC Crystal Staffing Solutions": "crystal staffing solutions",
    "CRYSTAL STAFFING SOLUTIONS-L.L.C.": "crystal staffing solutions", "Consulting Nyasa Nursing Private Limited": "consulting nyasa nursing",
    "Consulting Nyasa Nursing Private Ltd": "consulting nyasa nursing", "Consulting Nyasa Nursing PRIVATE LIMITED": "consulting nyasa nursing",
    "Consulting Nyasa Nursing Private": "consulting nyasa nursing", "Raj Investments LLP": "raj investments", "Thermal & Fils SASU": "thermal and fils",
    "Grillons Lycee SAS": "grillons lycee", "ZNB Club SARL": "znb club", "Elephant Centre EURL": "elephant centre", "Collège Jean SA": "college jean",
    "Hendricks & Flowers": "hendricks and flowers", "Chordia + Partners": "chordia and partners", "<< Team Ecole": "team ecole",
    "Apex Mfg & Tech Solns": "apex manufacturing and technology solutions", "एसएस फूड प्राइवेट लिमिटेड": "ss food", "Ss Food Private Limited": "ss food",
    "Raj Investments எல்எல்பி": "raj investments", "Korbrixx D.B.A. Obsidian, LLC": "obsidian", "John Doe d/b/a Acme Tools": "acme tools",
    "Tata Motors": "ta motors", "": "", "None": "", "null": "", "<NULL>": "", None: "", "Vision Partners Corp": "vision partners",
}
ADDRESSES = [
    ("12, M.G. Road, Anand", None, "12 mg road anand"), ("85 Wayne Ave", None, "85 wayne avenue"), ("3315 Fremont St", None, "3315 fremont street"),
    ("3315 Fremont Saint", None, "3315 fremont street"), ("154 BD du President Wilson", None, "154 boulevard du president wilson"),
    ("16 R. DES GRILLONS", None, "16 rue des grillons"), ("Peoria, IL", "US", "peoria illinois"), ("Ticonderoga, NY", "US", "ticonderoga new york"),
    ("Chennai, TN", "India", "chennai tamil nadu"), ("Mumbai, MH", "India", "mumbai maharashtra"), ("Ghaziabad, UP", "India", "ghaziabad uttar pradesh"),
    ("BHANDUP WEST, MUMBAI, महाराष्ट्र", None, "bhandup west mumbai maharashtra"), ("CHENNAI, தமிழ்நாடு", None, "chennai tamil nadu"),
    ("GHAZIABAD, उत्तर प्रदेश", None, "ghaziabad uttar pradesh"), ("630 45th Terrace", None, "630 45 terrace"), ("630 45nd Terrace", None, "630 45 terrace"),
    ("AF-0684, Nandgram", None, "af 684 nandgram"), ("022 Allée Des Grillons", None, "22 allee des grillons"), ("", None, ""), (None, None, ""),
    ("<NULL>", None, ""), ("1064 Newton Rd, Unit 11, IA", "US", "1064 newton road unit 11 iowa"), ("Pune, AR", "France", "pune arkansas"),
]


def test_names(spark):
    rows = spark.createDataFrame([(k, v) for k, v in NAMES.items()], "raw string, want string").withColumn("got", normalized_name(F.col("raw"))).collect()
    assert [(r.raw, r.got) for r in rows] == [(r.raw, r.want) for r in rows]


def test_addresses(spark):
    rows = normalize(spark.createDataFrame([("x", a, c, w) for a, c, w in ADDRESSES], "business_name string, business_address string, country string, want string")).collect()
    assert [(r.business_address, r.norm_address) for r in rows] == [(r.business_address, r.want) for r in rows]


def test_strict_trade_names(spark):
    got = spark.range(1).select(normalized_name(F.lit("Tata Motors"), strict_dba=True), normalized_name(F.lit("A dba Bee Tools"), strict_dba=True)).first()
    assert tuple(got) == ("tata motors", "bee tools")


def test_legal_forms_are_stripped_as_by_the_loop(spark):
    forms = [f.split() for f in dicts.LEGAL_FORMS]

    def loop(words):
        while True:
            hit = next((f for f in forms if len(words) > len(f) and words[-len(f) :] == f), None)
            if hit:
                words = words[: -len(hit)]
                continue
            hit = next((f for f in forms if len(words) > len(f) and words[: len(f)] == f), None)
            if not hit:
                return words
            words = words[len(hit) :]

    rng = random.Random(7)
    vocabulary = sorted({w for f in forms for w in f}) + ["acme", "tools"]
    cases = [*itertools.product(["acme", "private", "limited", "pvt", "co"], repeat=3), *(tuple(rng.choice(vocabulary) for _ in range(rng.randint(1, 6))) for _ in range(3000))]
    rows = spark.createDataFrame([(" ".join(c), " ".join(loop(list(c)))) for c in cases], "raw string, want string").withColumn("got", without_legal_forms(F.col("raw")))
    assert rows.filter("got <> want").collect() == []


def _features(spark, *pairs):
    df = spark.createDataFrame(pairs, "n1 string, a1 string, n2 string, a2 string")
    return pair_features(profile(profile(df, "a", "n1", "a1"), "b", "n2", "a2")).select(FEATURES).collect()


def test_features(spark):
    same, other, empty = _features(spark, ("google inc", "1600 amphitheatre pkwy") * 2, ("apple", "california", "starbucks", "seattle"), ("", "", "", ""))
    assert [same[i] for i in (0, 1, 10, 11)] == [1, 1, 1, 1] and abs(same[2] - 1) < 1e-9
    assert other[0] < 0.3 and [other[i] for i in (1, 4, 10, 11)] == [0] * 4
    assert len(same) == 14 and empty[0] == 1 and [empty[i] for i in (1, 2, 10, 12)] == [0] * 4


def test_f05(spark):
    truth = spark.createDataFrame([("a", ["S2-00047", "S3-00812"]), ("b", []), ("c", ["x"])], "source1_entity_id string, true_ids array<string>")
    pred = spark.createDataFrame([("a", ["S2-00047", "S3-00812", "S2-00193"]), ("c", [])], "source1_entity_id string, matched_entity_ids array<string>")
    both = metrics.with_predictions(truth, pred)
    got = {r[0]: r[1] for r in both.select("source1_entity_id", metrics.entity_f05(F.col("true_ids"), F.col("pred_ids"))).collect()}
    assert got == {"a": pytest.approx(0.714, abs=1e-3), "b": 1.0, "c": 0.0}
    row = metrics.macro_f05(both).first()
    assert row.singleton_accuracy == 1.0 and row.total_queries == 3 and row.precision == pytest.approx(2 / 3)
    assert metrics.macro_f05(both.limit(0)).first().macro_f05 == 0.0


def test_lowest_threshold_wins_ties(spark):
    truth = spark.createDataFrame([("a", ["x"])], "source1_entity_id string, true_ids array<string>")
    scored = spark.createDataFrame([("a", "x", 0.9), ("a", "y", 0.55)], "source1_entity_id string, entity_id string, probability double")
    assert metrics.best_threshold(metrics.threshold_sweep(truth, scored)) == (0.56, 1.0)


def test_parameters():
    for bad in ({"max_document_frequency": 0}, {"top_k_per_field": 0}, {"name_threshold": 1.5}):
        with pytest.raises(ValueError):
            blocking.check_parameters(**bad)


def _sources(spark):
    schema = "entity_id string, business_name string, business_address string, country string"
    s1 = spark.createDataFrame([("S1-1", "Acme Tools LLC", "12 Main St", "US"), ("S1-2", "Zed Bakery", "9 Oak Ave", "US"), ("S1-3", None, None, None)], schema)
    s2 = spark.createDataFrame([("S2-1", "ACME TOOLS", "12 Main Street", "US"), ("S2-2", "Acme Tools", "99 Other Rd", "India")], schema)
    s3 = spark.createDataFrame([(f"S3-{i}", f"Filler {i}", f"{i} Road", "US") for i in range(150)], schema)
    return s1, s2, s3


def test_resolve(spark):
    got = {r[0]: r[1] for r in resolve(*_sources(spark), threshold=0.8).collect()}
    assert got == {"S1-1": ["S2-1"], "S1-2": [], "S1-3": []}


def test_candidates_and_empty_tables(spark):
    s1, s2, s3 = _sources(spark)
    got = {r[0]: [c.entity_id for c in r[1]] for r in blocking.generate_candidate_pairs(s1, s2, s3).collect()}
    assert got["S1-1"][0] == "S2-1" and got["S1-2"] == ["S3-9"] and got["S1-3"] == []
    assert [r[1] for r in blocking.generate_candidate_pairs(s1, s2.limit(0), s3.limit(0)).collect()] == [[], [], []]
    with pytest.raises(ValueError):
        normalize(s1.drop("business_name"))


def test_match_cap_and_order(spark):
    rows = [("a", f"t{i}", i, 0.9 if i < 8 else 0.95) for i in range(10)] + [("a", "t0", 20, 0.99), ("a", "low", 21, 0.5)]
    got = matching.top_matches(spark.createDataFrame(rows, "source1_entity_id string, entity_id string, rank int, probability double")).orderBy("place").collect()
    assert [r.entity_id for r in got] == ["t0", "t8", "t9", "t1", "t2", "t3"]


def test_tsv_round_trip_cache_and_resume(spark, tmp_path):
    s1, *_ = _sources(spark)
    tables.write_tsv(s1.fillna(""), str(tmp_path / "s1"))
    back = tables.read_tsv(spark, str(tmp_path / "s1"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, s1.fillna("").collect()))
    first = tables.ensure_normalized(spark, str(tmp_path / "s1"), str(tmp_path / "cache"))
    again = tables.ensure_normalized(spark, str(tmp_path / "s1"), str(tmp_path / "cache"))
    assert first.inputFiles() == again.inputFiles() and "norm_name" in first.columns
    done = spark.createDataFrame([("S1-1",)], "source1_entity_id string")
    assert {r.entity_id for r in tables.not_yet_written(s1, done).collect()} == {"S1-2", "S1-3"}


def test_hard_negatives_respect_truth_and_country(spark):
    queries = spark.createDataFrame([("q", "US", ["t1"], ["acme", "tools"])], "source1_entity_id string, country string, true_ids array<string>, name_tokens array<string>")
    pool = spark.createDataFrame([("t1", "US", ["acme"]), ("t2", "India", ["acme"]), ("t3", "", ["tools"])], "entity_id string, country string, name_tokens array<string>")
    assert [tuple(r) for r in learn.hard_negatives(queries, pool, "name", 4).collect()] == [("q", "t3")]


def test_pairs_of_unknown_queries_and_repeated_ids(spark):
    s1, s2, s3 = map(normalize, _sources(spark))
    schema = "entity_id string, business_name string, business_address string, country string"
    s3 = normalize(spark.createDataFrame([("S2-2", "Other Name", "1 Elm St", "US")], schema)).unionByName(s3)
    ranked = spark.createDataFrame([("S1-1", "S2-1", 1), ("S1-1", "S2-2", 2), ("nobody", "S2-1", 1), ("S1-1", "none", 3)], "source1_entity_id string, entity_id string, rank int")
    rows = {(r.source1_entity_id, r.entity_id): r for r in pair_features(matching.pairs(ranked, s1, blocking.target_rows(s2, s3))).collect()}
    assert set(rows) == {("S1-1", "S2-1"), ("S1-1", "S2-2"), ("nobody", "S2-1")}
    assert rows["S1-1", "S2-2"].b_name == "other name" and rows["S1-1", "S2-1"].exact_name_match == 1
    unknown = rows["nobody", "S2-1"]
    assert (unknown.a_name, unknown.a_country, unknown.a_numbers, unknown.name_tfidf_cosine, unknown.name_levenshtein) == ("", "", [], 0, 0)


def test_gram_counts_match_brute_force(spark):
    from collections import Counter

    from weftlink.functions.similarity import bag

    rng = random.Random(5)
    texts = ["", "a", "ab", "abc", "aaaa", "é😀é😀é", *("".join(rng.choice("abé ") for _ in range(rng.randrange(60))) for _ in range(200))]
    for r in spark.createDataFrame([(t,) for t in texts], "t string").withColumn("b", bag(F.col("t"))).collect():
        want = Counter([r.t[i : i + 3] for i in range(len(r.t) - 2)] or [r.t] * bool(r.t))
        assert r.b == dict(want), r.t


def test_random_negatives_are_one_for_each_positive(spark):
    queries = spark.createDataFrame([(f"q{i}", [f"t{i}", f"t{i + 1}"]) for i in range(30)], "source1_entity_id string, true_ids array<string>")
    pool = spark.createDataFrame([(f"t{i}",) for i in range(500)], "entity_id string")
    got = learn.random_negatives(queries, pool, F.col("true_ids")).collect()
    assert len(got) >= 55 and len({r.entity_id for r in got}) > 40 and all(r.entity_id not in (f"t{r.source1_entity_id[1:]}",) for r in got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, learn.random_negatives(queries.repartition(3), pool.repartition(2), F.col("true_ids")).collect()))
    assert learn.random_negatives(queries, pool.limit(0), F.col("true_ids")).count() == 0


def test_a_half_written_cache_is_made_anew(spark, tmp_path):
    import os

    s1, *_ = _sources(spark)
    tables.write_tsv(s1.fillna(""), str(tmp_path / "s1"))
    first = tables.ensure_normalized(spark, str(tmp_path / "s1"), str(tmp_path / "cache"))
    folder = next((tmp_path / "cache").glob("*.normalized"))
    for part in [folder / "_SUCCESS", *sorted(folder.glob("part-*"))[1:]]:
        os.remove(part)
    assert tables.ensure_normalized(spark, str(tmp_path / "s1"), str(tmp_path / "cache")).count() == s1.count() == 3
    assert first.columns and tables.exists(spark, str(folder / "_SUCCESS"))


def test_load_records_takes_the_last_of_an_id(spark):
    rows = spark.createDataFrame([("a", "Old Name", "1 St", "US"), ("a", "Zed Name", "1 St", "US"), (" ", "blank", "", "")], "entity_id string, business_name string, business_address string, country string")
    assert [(r.entity_id, r.norm_name) for r in tables.load_records(rows).collect()] == [("a", "zed name")]
