"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checkpoints import checkpoint_folder, checkpointed  # noqa: F401


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def joined_back(frame: DataFrame, low: DataFrame, keys: list[str], rows: int, by: list[str]) -> DataFrame:
    """``frame`` joined on ``keys`` with ``low``: one row for each key, with ``n``, how many rows of ``frame`` have it.

    A key with more rows than a quarter of a mean partition (of ``rows`` rows in all, at least
    about as many as ``frame`` has) is dealt over several tasks by a hash of the columns ``by``,
    and its row of ``low`` is repeated for each. The keys to deal are broadcast; there are at
    most four for each shuffle partition, whatever the data, for each ``rows`` rows of ``frame``.
    """
    share = max(1, rows // (4 * partitions(frame)))
    pieces = F.ceil(F.col("n") / share)
    hot = low.filter(F.col("n") > share).select(*keys, pieces.alias("__pieces"))
    piece = F.coalesce(F.pmod(F.xxhash64(*by), F.col("__pieces")), F.lit(0).cast("long"))
    own = frame.join(F.broadcast(hot), keys, "left").withColumn("__piece", piece).drop("__pieces")
    dealt = low.withColumn("__piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1))).drop("n")
    return own.join(dealt, [*keys, "__piece"]).drop("__piece")


def row_key(id_col: str, text_col: str):
    """A key that equal (id, text) rows share: rows that repeat get the same verdict, wherever they are read."""
    return F.xxhash64(F.col(id_col), F.col(text_col))
