"""The steps of a run on files, and the rules that their output keeps."""

import random

import pytest

from weftlink.operators import blocking, learn
from weftlink.plans import commands
from weftlink.sources import tables
from weftlink.streaming.queries import candidates_of_stream

SCHEMA = tables.ENTITY


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Sixty businesses, each in one or both target sources under a changed name, and fillers."""
    folder, rng = tmp_path_factory.mktemp("files"), random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstu") for _ in range(7))
    s1, s2, s3, truth = [], [], [], []
    for i in range(60):
        name, address = f"{word()} {word()}", f"{rng.randint(1, 99)} {word()} St"
        s1.append((f"S1-{i}", f"{name} LLC", address, "US"))
        ids = []
        if i % 3:
            s2.append((f"S2-{i}", name.upper(), address.replace(" St", " Street"), "US"))
            ids.append(f"S2-{i}")
        if i % 2:
            s3.append((f"S3-{i}", f"{name} Inc.", address, ""))
            ids.append(f"S3-{i}")
        truth.append((f"S1-{i}", ",".join(ids)))
    s3 += [(f"S3-f{i}", f"{word()} {word()}", f"{rng.randint(1, 99)} {word()} Road", "India") for i in range(150)]
    paths = {}
    for name, rows, schema in (("source1", s1, SCHEMA), ("source2", s2, SCHEMA), ("source3", s3, SCHEMA), ("truth", truth, tables.TRUTH)):
        tables.write_tsv(spark.createDataFrame(rows, schema), paths.setdefault(name, str(folder / name)))
    return folder, paths


def test_block_resume_infer_and_check(spark, files):
    folder, paths = files
    sources = {k: v for k, v in paths.items() if k != "truth"}
    whole, part = str(folder / "candidates"), str(folder / "resumed")
    assert commands.write_candidates(spark, **sources, output=whole, cache_dir=str(folder / "cache"), index_dir=str(folder / "index")) == 60
    rows = tables.read_tsv(spark, whole, tables.CANDIDATES)
    tables.write_tsv(rows.filter("source1_entity_id < 'S1-3'"), part)
    done = tables.read_tsv(spark, part, tables.CANDIDATES).count()
    assert 0 < done < 60 and commands.write_candidates(spark, **sources, output=part, resume=True) == 60 - done
    assert sorted(map(tuple, tables.read_tsv(spark, part, tables.CANDIDATES).collect())) == sorted(map(tuple, rows.collect()))
    assert commands.write_candidates(spark, **sources, output=part, resume=True) == 0

    matches = str(folder / "matches")
    counts = commands.run_inference(spark, whole, **sources, output=matches, threshold=0.8)
    assert counts["queries"] == 60 and counts["pairs_scored"] >= counts["matches"] > 60 and counts["singletons"] < 15
    assert counts["average_matches"] == counts["matches"] / 60
    assert set(commands.check_output(spark, matches, whole, **sources).values()) == {0}
    broken = spark.createDataFrame([("S1-1", "S2-1,S2-1,x"), ("S1-1", ""), ("who", "1,2,3,4,5,6,7")], tables.TRUTH)
    tables.write_tsv(broken, str(folder / "broken"))
    assert all(commands.check_output(spark, str(folder / "broken"), whole, **sources).values())


def test_candidate_files_are_read_in_order(spark, files):
    folder, _ = files
    tables.write_tsv(spark.createDataFrame([("q", "b, a1,,b,c0"), ("r", "")], tables.CANDIDATES), str(folder / "lists"))
    assert sorted(map(tuple, tables.read_candidates(spark, str(folder / "lists")).collect())) == [("q", "a1", 2), ("q", "b", 1), ("q", "c0", 3)]


def test_train_save_and_infer_with_the_model(spark, files):
    folder, paths = files
    model = str(folder / "model")
    report = commands.train(spark, **paths, model=model, num_queries=60, validation=0.3, iterations=3, depth=3, leaf=1, pool_step=1)
    assert report["total_queries"] > 5 and 0 <= report["macro_f05"] <= 1 and report["optimal_threshold"] >= 0.5
    fitted, facts = learn.load(model)
    assert facts["optimal_threshold"] == report["optimal_threshold"] and facts["metrics"]["total_queries"] == report["total_queries"]
    sources = {k: v for k, v in paths.items() if k != "truth"}
    candidates, out = str(folder / "for model"), str(folder / "scored")
    commands.write_candidates(spark, **sources, output=candidates)
    assert commands.run_inference(spark, candidates, **sources, output=out, model=model)["queries"] == 60
    assert set(commands.check_output(spark, out, candidates, **sources).values()) == {0}


def test_blocking_evaluation_and_command_line(spark, files, capsys):
    folder, paths = files
    got = commands.evaluate_blocking(spark, **paths, holdout=0.5)
    assert got["query_recall"] == got["edge_recall"] == 1.0 and got["mrr"] > 0.5 and 0 < got["reduction_ratio"] < 1
    with pytest.raises(ValueError):
        commands.evaluate_blocking(spark, **paths, name_threshold=2.0)
    flags = [x for k, v in paths.items() for x in (f"--{k}", v)]
    commands.main(["evaluate-blocking", *flags, "--holdout", "0.5"])
    assert '"query_recall": 1.0' in capsys.readouterr().out


def test_candidates_of_a_stream(spark, files, tmp_path):
    _, paths = files
    targets = blocking.target_rows(*(commands._records(spark, paths[x], None) for x in ("source2", "source3")))
    stream = spark.readStream.schema(SCHEMA).option("sep", "\t").option("header", True).csv(paths["source1"])
    index = blocking.Index(targets, path=str(tmp_path / "index"))
    candidates_of_stream(stream, index, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    own = commands._records(spark, paths["source1"], None)
    want = blocking.candidate_lists(own, index.candidates(own)).collect()
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch").collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 60


def test_blocking_matches_brute_force(spark):
    """Every candidate list against a plain version of the rules."""
    import math

    rng = random.Random(9)
    words = [f"w{i}" for i in range(40)]
    make = lambda p, n: [(f"{p}-{i}", " ".join(rng.choice(words[: rng.choice([5, 40])]) for _ in range(rng.randint(0, 5))), " ".join(rng.choice(words) for _ in range(rng.randint(0, 5))), "") for i in range(n)]
    s1, s2, s3 = make("S1", 30), make("S2", 120), make("S3", 120)
    frames = [spark.createDataFrame([(*r[:3], *r[1:3]) for r in rows], "entity_id string, business_name string, business_address string, norm_name string, norm_address string") for rows in (s1, s2, s3)]
    got = {r.source1_entity_id: [(c.entity_id, round(c.score, 6)) for c in r.candidates] for r in blocking.generate_candidate_pairs(*frames, max_document_frequency=0.1, top_k_per_field=7, max_candidates=9).collect()}
    targets = [(2, *r) for r in s2] + [(3, *r) for r in s3]
    n, found = len(targets), {r[0]: {} for r in s1}
    for field in (1, 2):
        tokens = {(t[0], t[1]): set(t[field + 1].split()) for t in targets}
        df = {w: sum(w in x for x in tokens.values()) for w in words}
        idf = {w: math.log((n + 1) / (c + 1)) + 1 for w, c in df.items() if 0 < c <= int(n * 0.1)}
        for q in s1:
            own = [w for w in sorted(set(q[field].split()), key=lambda w: (-idf.get(w, 0), w)) if w in idf]
            total, scores = sum(idf[w] for w in own), []
            for key, x in tokens.items():
                common = sum(idf[w] for w in own[:5] if w in x)
                union = total + sum(idf[w] for w in x if w in idf) - common
                if common and common >= 0.18 * union:
                    scores.append((-round(common / union, 6), key))
            for s, key in sorted(scores)[:7]:
                found[q[0]][key[1]] = max(found[q[0]].get(key[1], 0), -s)
    for q, scores in found.items():
        want = sorted(sorted(scores.items(), key=lambda x: (-x[1], [-ord(c) for c in x[0]]))[:9], key=lambda x: (-x[1], x[0]))
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want], abs=1e-5), q
        last = want[-1][1] + 1e-4 if want else 0
        assert {e for e, s in got[q] if s > last} == {e for e, s in want if s > last}, q
