"""Gates over candidate pairs, and the ranked, capped list of matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import written
from ..functions import compare
from ..functions.similarity import profile

MAX_MATCHES = 6  # fixed value
FALLBACK_THRESHOLD = 0.82  # fixed value


def pairs(ranked: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """Candidates with both records' profiles, made of those records alone that are in a pair.

    A query that isn't known has empty fields; a target that isn't known drops out. Of targets that share an id the
    last source's counts (U2), of rows that share it within one the last in order of name, address and country.
    """
    of = lambda frame, id_, key: last_by_id(frame.join(ranked.select(F.col(id_).alias("entity_id")).distinct(), "entity_id", "left_semi")).select("entity_id", "country", "norm_name", "norm_address").withColumnRenamed("entity_id", key)
    a = profile(of(s1, "source1_entity_id", "source1_entity_id"), "a").select("source1_entity_id", F.col("country").alias("a_country"), *_own("a"))
    b = profile(of(targets, "entity_id", "entity_id"), "b").select("entity_id", F.col("country").alias("b_country"), *_own("b"))
    both = ranked.join(b, "entity_id").join(a, "source1_entity_id", "left")
    empty = profile(ranked.sparkSession.sql("SELECT '' AS norm_name, '' AS norm_address"), "a").select(*_own("a"))  # one row
    kinds = dict(empty.dtypes)
    nothing = {c: F.lit("").cast("string") if k == "string" else F.lit(0.0) if k == "double" else F.expr(f"cast({k.split('<')[0]}() as {k})") for c, k in kinds.items()}
    return both.withColumns({"a_country": F.coalesce("a_country", F.lit("")), **{c: F.coalesce(c, v) for c, v in nothing.items()}})


def compared(ranked: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """``ranked`` with both countries, the fourteen features, and what the gates ask of numbers and of the target's address.

    Which records a pair has is as in ``pairs``. Texts are compared once for each distinct pair of them; the rows of
    ``ranked`` carry hashes of their texts, and no text.
    """
    ranked = written(ranked)
    of = lambda frame, id_: written(last_by_id(frame.join(ranked.select(F.col(id_).alias("entity_id")).distinct(), "entity_id", "left_semi")).select("entity_id", "country", *(F.coalesce(c, F.lit("")).alias(c) for c in ("norm_name", "norm_address"))))
    a, b = of(s1, "source1_entity_id"), of(targets, "entity_id")
    key = lambda c: F.unhex(F.md5(c))
    light = lambda frame, x: frame.select(F.col("entity_id").alias("source1_entity_id" if x == "a" else "entity_id"), F.col("country").alias(f"{x}_country"), key("norm_name").alias(f"{x}_n"), key("norm_address").alias(f"{x}_d"))
    known = ranked.join(light(b, "b"), "entity_id").join(light(a, "a"), "source1_entity_id", "left")
    known = written(known.withColumns({"a_country": F.coalesce("a_country", F.lit("")), **{c: F.coalesce(c, key(F.lit(""))) for c in ("a_n", "a_d")}}))

    fields = (("name", "n"), ("addr", "d"))
    each = known.select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"a_{c}").alias("x"), F.col(f"b_{c}").alias("y")) for f, c in fields))).alias("e")).select("e.*").distinct()
    both = a.unionByName(b).select(F.explode(F.array("norm_name", "norm_address", F.lit(""))).alias("text"))
    texts = both.select(key("text").alias("k"), "text").groupBy("k").agg(F.min("text").alias("text"))
    met = each.join(texts.withColumnsRenamed({"k": "x", "text": "a"}), "x").join(texts.withColumnsRenamed({"k": "y", "text": "b"}), "y")
    told = written(met.select("field", "x", "y", "a", "b").mapInArrow(compare.compared, f"field string, x binary, y binary, {compare.COLUMNS}"))

    named = {"levenshtein": "{}_levenshtein", "jaccard": "{}_jaccard", "cosine": "{}_tfidf_cosine", "common": "common_{}_tokens", "len_diff": "{}_len_diff", "exact": "exact_{}_match", "ratio": "{}_token_ratio"}
    for f, c in fields:
        more = [] if f == "name" else ["numbers_match", "numbers_conflict", F.col("b_empty").alias("b_addr_empty")]
        own = told.filter(F.col("field") == f).select(F.col("x").alias(f"a_{c}"), F.col("y").alias(f"b_{c}"), *(F.col(k).alias(v.format(f)) for k, v in named.items()), *more)
        known = known.join(own, [f"a_{c}", f"b_{c}"]).drop(f"a_{c}", f"b_{c}")
    return known


def last_by_id(records: DataFrame) -> DataFrame:
    """One row for each entity_id: the one of the last source, then the last in order of name, address and country."""
    order = [F.col(c) for c in ("source", "norm_name", "norm_address", "country") if c in records.columns]
    rest = [c for c in records.columns if c != "entity_id"]
    best = records.groupBy("entity_id").agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return best.select("entity_id", "r.*")


def _own(prefix: str) -> list[str]:
    return [f"{prefix}_{x}" for x in ("name", "name_tokens", "name_grams", "name_norm", "addr", "addr_tokens", "addr_grams", "addr_norm", "numbers")]


def cheap_gate() -> Column:
    """The countries don't conflict, and a name or address token is shared."""
    a, b = F.coalesce("a_country", F.lit("")), F.coalesce("b_country", F.lit(""))
    return ((a == "") | (b == "") | (a == b)) & ((F.col("common_name_tokens") > 0) | (F.col("common_addr_tokens") > 0))


def precision_gate() -> Column:
    name = F.greatest("name_levenshtein", "name_jaccard", "name_token_ratio")
    addr = F.col("addr_levenshtein")
    return ~(
        (F.col("numbers_conflict") & (name < 0.60))
        | (F.col("b_addr_empty") & (name < 0.60))
        | ((F.col("common_name_tokens") == 0) & (name < 0.40) & ~(F.col("numbers_match") & (addr >= 0.85)))
        | ((name < 0.35) & (addr < 0.85))
    )


def gated(candidates: DataFrame) -> DataFrame:
    """Of ``compared`` candidates those that pass both gates."""
    return candidates.filter(cheap_gate() & precision_gate())


def top_matches(scored: DataFrame, threshold: float = FALLBACK_THRESHOLD, most: int = MAX_MATCHES) -> DataFrame:
    """``scored`` (source1_entity_id, entity_id, rank, probability) -> the same, at most ``most`` for each query, with ``place``."""
    own = Window.partitionBy("source1_entity_id", "entity_id").orderBy(F.desc("probability"), "rank")
    once = scored.filter(F.col("probability") >= threshold).withColumn("__n", F.row_number().over(own)).filter("__n = 1").drop("__n")
    return once.withColumn("place", F.row_number().over(Window.partitionBy("source1_entity_id").orderBy(F.desc("probability"), "rank"))).filter(F.col("place") <= most)


def match_lists(s1: DataFrame, matches: DataFrame) -> DataFrame:
    """(source1_entity_id, matched_entity_ids): every query has a row."""
    lists = matches.groupBy("source1_entity_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "entity_id"))), lambda x: x["entity_id"]).alias("matched_entity_ids"))
    return s1.select(F.col("entity_id").alias("source1_entity_id")).join(lists, "source1_entity_id", "left").withColumn("matched_entity_ids", F.coalesce("matched_entity_ids", F.expr("cast(array() as array<string>)")))
