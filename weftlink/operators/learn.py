"""Training pairs, the boosted classifier, its threshold and its artifact.

Sampling is by seeded hashes of ids, so it doesn't depend on the order or number of partitions.
"""

from __future__ import annotations

import json
import math
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..checkpoints import written
from ..functions.normalize import tokens
from ..functions.similarity import FEATURES
from . import metrics
from .matching import compared

POOL_STEP, POOL_CAP, PER_TOKEN, TOKEN_LENGTH = 150, 40_000, 15, 3  # fixed values
FIRST_TOKENS = 6  # of a text are looked up before its others; any number gives the same pairs
ROWS_OF_A_TASK = 40_000  # in training, each level of each tree being a job


class Trained(NamedTuple):
    model: PipelineModel
    threshold: float
    sweep: DataFrame
    report: DataFrame


def with_tokens(records: DataFrame) -> DataFrame:
    """``records`` (norm_name, norm_address, ...) with name_tokens and addr_tokens, each token once."""
    return records.withColumns({f"{f}_tokens": F.array_distinct(tokens(F.coalesce(c, F.lit("")))) for f, c in (("name", "norm_name"), ("addr", "norm_address"))})


def split(queries: DataFrame, validation: float = 0.2, seed: int = 42, id_col: str = "source1_entity_id") -> DataFrame:
    """``queries`` with is_validation."""
    return queries.withColumn("is_validation", F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1_000_000)) < int(validation * 1_000_000))


def negative_pool(targets: DataFrame, step: int = POOL_STEP, cap: int | None = POOL_CAP, seed: int = 42) -> DataFrame:
    """One in ``step`` targets by hash, ``cap`` at most, which is a documented sample for training only; without a cap and with a step of 1 all targets."""
    h = F.xxhash64("entity_id", F.lit(seed))
    dealt = targets.filter(F.pmod(h, F.lit(step)) == 0)
    return dealt if cap is None else dealt.orderBy(h, "entity_id").limit(cap)


def numbered(pool: DataFrame) -> DataFrame:
    """(entity_id, at): the records' places from 0 in order of their ids, counted range by range."""
    n = int(pool.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(pool.select("entity_id").repartitionByRange(n, "entity_id").withColumn("range", F.spark_partition_id()))  # the ranges differ from run to run
    before = F.coalesce(F.sum("size").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("size")).select("range", before.alias("start"))  # a row for each range
    places = dealt.withColumn("place", F.row_number().over(Window.partitionBy("range").orderBy("entity_id")))
    return places.join(F.broadcast(starts), "range").select("entity_id", (F.col("start") + F.col("place") - 1).cast("long").alias("at"))


def token_index(pool: DataFrame, field: str, per_token: int = PER_TOKEN) -> DataFrame:
    """(token, entity_id, country, place): up to ``per_token`` pool records of each longer token."""
    rows = pool.select("entity_id", "country", F.explode(f"{field}_tokens").alias("token")).filter(F.length("token") > TOKEN_LENGTH)
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("token").orderBy("entity_id"))).filter(F.col("place") <= per_token)


def hard_negatives(queries: DataFrame, pool: DataFrame, field: str, most: int = 1, index: DataFrame | None = None) -> DataFrame:
    """(source1_entity_id, entity_id): the first pool records that share a token, are not true and whose country doesn't conflict.

    ``queries`` (source1_entity_id, country, true_ids, <field>_tokens); ``index``: the pool's ``token_index``, if it is there.
    """
    index = written(token_index(pool, field)) if index is None else index
    long = F.filter(F.transform(f"{field}_tokens", lambda x, i: F.struct(i.alias("at"), x.alias("token"))), lambda x: F.length(x["token"]) > TOKEN_LENGTH)
    asked = queries.select("source1_entity_id", F.col("country").alias("own"), "true_ids", long.alias("tokens"))
    first = asked.withColumns({"tokens": F.slice("tokens", 1, FIRST_TOKENS), "more": F.size("tokens") > FIRST_TOKENS})
    met = written(_enough(first, index, most))
    done = met.filter(F.col("stop").isNotNull()).select("source1_entity_id").distinct()
    rest = _enough(asked.filter(F.size("tokens") > FIRST_TOKENS).join(done, "source1_entity_id", "left_anti").withColumn("more", F.lit(False)), index, most)
    asked = met.filter(F.col("stop").isNotNull() | ~F.col("more")).unionByName(rest)
    found = asked.join(index, "token")
    found = found.filter(~F.array_contains("true_ids", F.col("entity_id")) & _no_conflict("own", "country"))
    best = found.groupBy("source1_entity_id", "entity_id").agg(F.min(F.struct("at", "place")).alias("order"))
    return best.withColumn("n", F.row_number().over(Window.partitionBy("source1_entity_id").orderBy("order", "entity_id"))).filter(F.col("n") <= most).select("source1_entity_id", "entity_id")


def _no_conflict(own: str, other: str) -> Column:
    a, b = F.coalesce(own, F.lit("")), F.coalesce(other, F.lit(""))
    return (a == "") | (b == "") | (a == b)


def _enough(asked: DataFrame, index: DataFrame, most: int) -> DataFrame:
    """``asked`` with a row for each of its tokens that the index has, up to ``stop``: the first that alone gives ``most`` records; later ones cannot come before these."""
    once = index.groupBy("token", "entity_id").agg(F.min(F.coalesce("country", F.lit(""))).alias("country"))
    own = once.groupBy("token", "country").agg(F.count(F.lit(1)).alias("n"))
    have = own.groupBy("token").agg(F.sum("n").alias("all"), F.map_from_entries(F.collect_list(F.struct("country", "n"))).alias("by"))
    met = asked.select("source1_entity_id", "own", "true_ids", "more", F.explode("tokens").alias("t")).select("*", "t.at", "t.token").drop("t").join(have, "token")
    of = lambda c: F.coalesce(F.try_element_at("by", c), F.lit(0))
    able = F.when(F.coalesce("own", F.lit("")) == "", F.col("all")).otherwise(of(F.lit("")) + of(F.col("own")))
    met = met.withColumn("stop", F.when(able - F.size("true_ids") >= most, F.col("at"))).drop("all", "by")
    return met.withColumn("stop", F.min("stop").over(Window.partitionBy("source1_entity_id"))).filter("stop IS NULL OR at <= stop")


def random_negatives(queries: DataFrame, pool: DataFrame, draws, seed: int = 42) -> DataFrame:
    """(source1_entity_id, entity_id): a pool record for each of the strings ``draws``, an array column; none where a true one is drawn."""
    places = pool.select("entity_id", "at") if "at" in pool.columns else numbered(pool)
    size = pool.count()
    if not size:
        return queries.select("source1_entity_id", F.lit("").alias("entity_id")).limit(0)
    drawn = queries.select("source1_entity_id", "true_ids", F.explode(draws).alias("draw")).withColumn("at", F.pmod(F.xxhash64("source1_entity_id", "draw", F.lit(seed)), F.lit(size)))
    return drawn.join(places, "at").filter(~F.array_contains("true_ids", F.col("entity_id"))).select("source1_entity_id", "entity_id")


def training_pairs(queries: DataFrame, pool: DataFrame, seed: int = 42, name: DataFrame | None = None, addr: DataFrame | None = None) -> DataFrame:
    """(source1_entity_id, entity_id, label, weight): each true pair; a name, an address and a random negative for each; for singletons the hard ones with weight 2.

    ``name``, ``addr``: the pool's token indexes, if they are there.
    """
    positive = queries.select("source1_entity_id", F.explode("true_ids").alias("entity_id")).withColumns({"label": F.lit(1.0), "weight": F.lit(1.0)})
    size = queries.select("source1_entity_id", F.greatest(F.size("true_ids"), F.lit(0)).alias("n"))
    hard = hard_negatives(queries, pool, "name", index=name).unionByName(hard_negatives(queries, pool, "addr", index=addr)).join(size, "source1_entity_id")
    hard = hard.select("source1_entity_id", "entity_id", F.lit(0.0).alias("label"), F.when(F.col("n") > 0, F.col("n")).otherwise(2).cast("double").alias("weight"))
    rand = random_negatives(queries, pool, F.col("true_ids"), seed).withColumns({"label": F.lit(0.0), "weight": F.lit(1.0)})
    return positive.unionByName(hard).unionByName(rand)


def validation_pairs(queries: DataFrame, pool: DataFrame, seed: int = 42, name: DataFrame | None = None, addr: DataFrame | None = None) -> DataFrame:
    """(source1_entity_id, entity_id): true pairs with six address, four name and two random negatives. ``name``, ``addr`` as in ``training_pairs``."""
    parts = [queries.select("source1_entity_id", F.explode("true_ids").alias("entity_id")), hard_negatives(queries, pool, "addr", 6, addr), hard_negatives(queries, pool, "name", 4, name), random_negatives(queries, pool, F.array(F.lit("first"), F.lit("second")), seed)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.distinct()


def featured(pairs: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """``pairs`` of known records with features in single precision; of targets that share an id the last source's counts."""
    known = pairs.join(queries.select("source1_entity_id").distinct(), "source1_entity_id", "left_semi")
    both = compared(known, queries.withColumnRenamed("source1_entity_id", "entity_id"), targets)
    return both.select(*pairs.columns, *(F.col(f).cast("float").cast("double").alias(f) for f in FEATURES))


def fit(rows: DataFrame, iterations: int = 180, step: float = 0.08, depth: int = 6, leaf: int = 25, seed: int = 42) -> PipelineModel:
    trees = GBTClassifier(maxIter=iterations, stepSize=step, maxDepth=depth, minInstancesPerNode=leaf, seed=seed, weightCol="weight", labelCol="label")
    rows = written(rows)
    tasks = math.ceil(rows.count() / ROWS_OF_A_TASK) or 1
    rows = written(rows.repartition(tasks, *rows.columns).sortWithinPartitions(*rows.columns))  # read many times, in the same order in every run
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), trees]).fit(rows)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).withColumn("probability", vector_to_array("probability")[1]).drop("features", "rawPrediction", "prediction")


def save(model: PipelineModel, path: str, threshold: float, more: dict | None = None) -> None:
    model.write().overwrite().save(f"{path}/model")
    facts = json.dumps({"optimal_threshold": threshold, "feature_names": FEATURES} | (more or {}))
    SparkSession.active().createDataFrame([(facts,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/facts")


def load(path: str) -> tuple[PipelineModel, dict]:
    return PipelineModel.load(f"{path}/model"), json.loads(SparkSession.active().read.text(f"{path}/facts").first()[0])


def train_and_evaluate(queries: DataFrame, targets: DataFrame, validation: float = 0.2, seed: int = 42, pool_step: int = POOL_STEP, pool_cap: int | None = POOL_CAP, **options) -> Trained:
    """Model, chosen threshold, sweep, and metrics at that threshold, the last two on the queries held out.

    ``queries``: normalized S1 rows (source1_entity_id, country, norm_name, norm_address) with true_ids; ``targets``: normalized S2 and S3 rows.
    ``pool_step`` of 1 and no ``pool_cap``: negatives come from all targets.
    """
    dealt = written(with_tokens(split(queries, validation, seed)).select("source1_entity_id", "country", "norm_name", "norm_address", "true_ids", "name_tokens", "addr_tokens", "is_validation"))
    train, held = dealt.filter("not is_validation"), dealt.filter("is_validation")
    pool = written(negative_pool(with_tokens(targets).select("entity_id", "country", "name_tokens", "addr_tokens"), pool_step, pool_cap))
    name, addr = (written(token_index(pool, f)) for f in ("name", "addr"))
    pool = written(numbered(pool))
    none = F.lit(None).cast("double")
    pairs = training_pairs(train, pool, seed, name, addr).withColumn("is_validation", F.lit(False))
    pairs = pairs.unionByName(validation_pairs(held, pool, seed, name, addr).withColumns({"label": none, "weight": none, "is_validation": F.lit(True)}))
    rows = written(featured(pairs, dealt.select("source1_entity_id", "country", "norm_name", "norm_address"), targets))
    model = fit(rows.filter("not is_validation").drop("is_validation"), seed=seed, **options)
    scored = written(score(model, rows.filter("is_validation")).select("source1_entity_id", "entity_id", "probability"))
    known = held.select("source1_entity_id", "true_ids")
    sweep = metrics.threshold_sweep(known, scored)
    threshold = metrics.best_threshold(sweep)[0]
    chosen = scored.filter(F.col("probability") >= threshold).groupBy("source1_entity_id").agg(F.collect_set("entity_id").alias("matched_entity_ids"))
    return Trained(model, threshold, sweep, metrics.macro_f05(metrics.with_predictions(known, chosen)))
