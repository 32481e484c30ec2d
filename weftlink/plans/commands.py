"""The steps of a run, from file to file: blocking with resume, inference, training, evaluation, and checks of what they wrote.

``python -m weftlink.plans.commands --help``. Files are tab-separated with a header; a folder of such files is a file, too.
A step's output appears whole or not at all, by Spark's committer.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normalize import normalize
from ..operators import blocking, learn, matching, metrics
from ..sources import tables
from .resolve import mean_score


def _records(spark: SparkSession, path: str, cache_dir: str | None) -> DataFrame:
    return tables.ensure_normalized(spark, path, cache_dir) if cache_dir else normalize(tables.read_tsv(spark, path))


def _targets(spark: SparkSession, source2: str, source3: str, cache_dir: str | None) -> DataFrame:
    return blocking.target_rows(_records(spark, source2, cache_dir), _records(spark, source3, cache_dir))


def write_candidates(spark: SparkSession, source1: str, source2: str, source3: str, output: str, cache_dir: str | None = None, resume: bool = False, index_dir: str | None = None, max_document_frequency: float = 0.02, **parameters) -> int:
    """Candidate lists of the records of ``source1`` as a file; the number of rows written now. With ``resume`` only queries without a row in ``output`` are asked, and their rows added."""
    blocking.check_parameters(max_document_frequency, **parameters)
    queries = _records(spark, source1, cache_dir)
    done = resume and tables.exists(spark, output)
    if done:
        queries = tables.not_yet_written(queries, tables.read_tsv(spark, output, tables.CANDIDATES))
    index = blocking.Index(_targets(spark, source2, source3, cache_dir), max_document_frequency, index_dir)
    lists = blocking.candidate_lists(queries, index.candidates(queries, **parameters))
    rows = lists.select("source1_entity_id", F.array_join("candidates.entity_id", ",").alias("candidate_entity_ids"))
    before = tables.read_tsv(spark, output, tables.CANDIDATES).count() if done else 0
    tables.write_tsv(rows, output, "append" if done else "overwrite")
    return tables.read_tsv(spark, output, tables.CANDIDATES).count() - before


def run_inference(spark: SparkSession, candidates: str, source1: str, source2: str, source3: str, output: str, model: str | None = None, threshold: float | None = None, most: int = matching.MAX_MATCHES, cache_dir: str | None = None) -> dict:
    """Matches of candidate lists made before, as a file with a row for each of their queries; returns the counts of the run.

    Without a model a pair's score is the mean of its four string similarities.
    """
    ranked = tables.read_candidates(spark, candidates)
    fitted, facts = learn.load(model) if model else (None, {})
    threshold = threshold if threshold is not None else facts.get("optimal_threshold", matching.FALLBACK_THRESHOLD)
    pairs = matching.gated(matching.compared(ranked, _records(spark, source1, cache_dir), _targets(spark, source2, source3, cache_dir)))
    scored = learn.score(fitted, pairs) if fitted else pairs.withColumn("probability", mean_score())
    asked = tables.read_tsv(spark, candidates, tables.CANDIDATES).select(F.col("source1_entity_id").alias("entity_id")).distinct()
    observed = F.count(F.lit(1)).alias("pairs_scored")
    from pyspark.sql import Observation

    seen = Observation("inference")
    kept = scored.select("source1_entity_id", "entity_id", "rank", "probability").observe(seen, observed)
    lists = matching.match_lists(asked, matching.top_matches(kept, threshold, most))
    tables.write_tsv(lists.withColumn("matched_entity_ids", F.array_join("matched_entity_ids", ",")), output)
    return run_counts(tables.read_truth(spark, output)) | seen.get


def run_counts(lists: DataFrame) -> dict:
    """Queries, matches, queries without a match and matches for each query, of (source1_entity_id, true_ids)."""
    n = F.size("true_ids")
    row = lists.agg(F.count(F.lit(1)).alias("queries"), F.coalesce(F.sum(n), F.lit(0)).alias("matches"), F.count(F.when(n == 0, 1)).alias("singletons")).first().asDict()
    return row | {"average_matches": row["matches"] / max(1, row["queries"])}


def check_output(spark: SparkSession, matches: str, candidates: str, source1: str, source2: str, source3: str, most: int = matching.MAX_MATCHES) -> dict:
    """How many rows break each rule of an output: all zero if it is sound."""
    out, asked = tables.read_tsv(spark, matches, tables.TRUTH), tables.read_tsv(spark, source1).select(F.col("entity_id").alias("source1_entity_id")).distinct()
    lists = tables.id_lists(out, "matched_entity_ids")
    each = lists.select("source1_entity_id", F.explode("matched_entity_ids").alias("entity_id"))
    targets = tables.read_tsv(spark, source2).select("entity_id").unionByName(tables.read_tsv(spark, source3).select("entity_id")).distinct()
    return {
        "queries without a row": asked.join(out, "source1_entity_id", "left_anti").count(),
        "rows of unknown queries": out.join(asked, "source1_entity_id", "left_anti").count(),
        "queries with several rows": out.groupBy("source1_entity_id").count().filter("count > 1").count(),
        "ids repeated in a list": lists.filter(F.size("matched_entity_ids") > F.size(F.array_distinct("matched_entity_ids"))).count(),
        "lists that are too long": lists.filter(F.size("matched_entity_ids") > most).count(),
        "matches that were no candidates": each.join(tables.read_candidates(spark, candidates), ["source1_entity_id", "entity_id"], "left_anti").count(),
        "matches that don't exist": each.join(targets, "entity_id", "left_anti").count(),
    }


def first_queries(records: DataFrame, n: int | None) -> DataFrame:
    """The ``n`` queries that come first by a hash of their ids, all if ``n`` is None: the size of a training set, chosen alike in every run."""
    return records if n is None else records.orderBy(F.xxhash64("entity_id"), "entity_id").limit(n)


def train(spark: SparkSession, source1: str, source2: str, source3: str, truth: str, model: str, num_queries: int | None = 35_000, validation: float = 0.2, seed: int = 42, cache_dir: str | None = None, **options) -> dict:
    """Fits, chooses the threshold and saves the model; returns the metrics of the queries held out at that threshold."""
    queries = first_queries(_records(spark, source1, cache_dir), num_queries).withColumnRenamed("entity_id", "source1_entity_id")
    empty = F.expr("cast(array() as array<string>)")
    known = queries.join(tables.read_truth(spark, truth), "source1_entity_id", "left").withColumn("true_ids", F.coalesce("true_ids", empty))
    got = learn.train_and_evaluate(known, _targets(spark, source2, source3, cache_dir), validation, seed, **options)
    report = got.report.first().asDict()
    learn.save(got.model, model, got.threshold, {"metrics": report, "num_queries": num_queries, "seed": seed})
    return report | {"optimal_threshold": got.threshold}


def evaluate_blocking(spark: SparkSession, source1: str, source2: str, source3: str, truth: str, holdout: float = 0.2, seed: int = 42, cache_dir: str | None = None, **parameters) -> dict:
    """Blocking metrics of the held-out part of the queries against all targets."""
    blocking.check_parameters(**parameters)
    queries = _records(spark, source1, cache_dir)
    held = learn.split(queries, holdout, seed, "entity_id").filter("is_validation").drop("is_validation")
    index = blocking.Index(_targets(spark, source2, source3, cache_dir), parameters.pop("max_document_frequency", 0.02))
    empty = F.expr("cast(array() as array<string>)")
    known = held.select(F.col("entity_id").alias("source1_entity_id")).join(tables.read_truth(spark, truth), "source1_entity_id", "left").withColumn("true_ids", F.coalesce("true_ids", empty))
    return metrics.blocking_quality(known, index.candidates(held, **parameters), index.count).first().asDict()


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    steps = p.add_subparsers(dest="step", required=True)
    blocks = {"max-document-frequency": 0.02, "name-threshold": 0.18, "address-threshold": 0.18, "top-k-per-field": 50, "max-candidates": 100}
    files = {"block": ["output"], "infer": ["candidates", "output"], "train": ["truth", "model"], "evaluate-blocking": ["truth"], "check": ["matches", "candidates"]}
    for step, more in files.items():
        own = steps.add_parser(step)
        for name in ["source1", "source2", "source3", *more]:
            own.add_argument(f"--{name}", required=True)
        if step != "check":
            own.add_argument("--cache-dir")
        if step in ("block", "evaluate-blocking"):
            for name, value in blocks.items():
                own.add_argument(f"--{name}", type=type(value), default=value)
        if step == "block":
            own.add_argument("--resume", action="store_true")
            own.add_argument("--index-dir")
        if step == "infer":
            own.add_argument("--model")
            own.add_argument("--threshold", type=float)
        if step in ("infer", "check"):
            own.add_argument("--most", type=int, default=matching.MAX_MATCHES)
        if step == "train":
            own.add_argument("--num-queries", type=int, default=35_000)
            own.add_argument("--validation", type=float, default=0.2)
        if step == "evaluate-blocking":
            own.add_argument("--holdout", type=float, default=0.2)
        if step in ("train", "evaluate-blocking"):
            own.add_argument("--seed", type=int, default=42)
    given = vars(p.parse_args(args))
    run = {"block": write_candidates, "infer": run_inference, "train": train, "evaluate-blocking": evaluate_blocking, "check": check_output}[given.pop("step")]
    print(json.dumps(run(SparkSession.builder.getOrCreate(), **given), default=float))


if __name__ == "__main__":
    main()
