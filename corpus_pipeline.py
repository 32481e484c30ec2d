"""From raw documents to token ids: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.llm import bpe, decontaminate, lines, quality, similar
from weftlink.llm.queries import RANKS, trusted
from weftlink.llm.shared import checkpoint_folder, read


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or stray from their language's references go.

    References are of the documents labelled good. Null and empty texts fail; a null language is compared with every
    reference, as all are if there is no column lang; rows are judged one by one, so repeated ones stay or go together.
    """
    own = docs if "lang" in docs.columns else docs.withColumn("lang", F.lit(None).cast("string"))
    return quality.filter_quality(own, trusted=trusted(spark, sf_dir)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go, and with them documents of which no word is left; n_chars follows the text.

    Null texts stay null, empty ones empty; of rows that are alike in id and text each counts as the same document, so none is a
    copy of the other; the smallest id keeps a run, a null id comes last. Columns named n_lines or removed_lines are kept.
    """
    text, own = F.col("text"), [c for c in docs.columns if c in ("n_lines", "removed_lines")]
    found = lines.dedup_lines(docs.withColumnsRenamed({c: f"__{c}" for c in own}))
    changed = F.size("removed_lines") > 0
    left = found.filter(~changed | text.rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(changed, F.length(text).cast("long")).otherwise(F.col("n_chars")))
    return left.drop(*own).withColumnsRenamed({f"__{c}": c for c in own}).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of pairs whose sets of five-word shingles have a similarity of 0.8 or more the document with the smallest id stays.

    Null, empty and wordless texts are alike; rows with a null id stay, since no id tells them apart; of rows that share
    an id one stays.
    """
    return similar.keep_one(docs, words=5, least=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go. Null and empty texts stay; rows are judged one by one; columns with the operator's names are kept."""
    own = [c for c in docs.columns if c in ("n_words", "hit_spans", "items")]
    found = decontaminate.hits(docs.withColumnsRenamed({c: f"__{c}" for c in own}), read(spark, sf_dir, "benchmark"))
    return found.filter(F.size("hit_spans") == 0).drop(*own).withColumnsRenamed({f"__{c}": c for c in own}).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of its round trip. A null text is the empty text, which has no ids; a row for each row."""
    keep = [c for c in ("lang", "source") if c in docs.columns]
    return bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=keep, with_ids=True).withColumnRenamed("id", "doc_id")


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("near-dedup", near_dedup), ("benchmark decontamination", decontamination), ("byte-level BPE", tokens)]
#: Line dedup, near-dedup and BPE have no SQL form; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what a stage has written goes once the next has read it."""
    docs, before = read(spark, sf_dir, "documents"), None
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(out := f"{folder}/{k}")
        docs = spark.read.parquet(out)
        if before:
            place = spark._jvm.org.apache.hadoop.fs.Path(before)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        before = out
    return docs
