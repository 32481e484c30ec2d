"""Reading and writing records, candidates and matches; entity views over document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normalize import normalize

ENTITY = "entity_id string, business_name string, business_address string, country string"
TRUTH = "source1_entity_id string, matched_entity_ids string"
CANDIDATES = "source1_entity_id string, candidate_entity_ids string"


def read_tsv(spark: SparkSession, path: str, schema: str = ENTITY, limit: int | None = None) -> DataFrame:
    """Tab-separated text with a header; quotes are ordinary characters, an empty field is empty rather than missing."""
    df = spark.read.csv(path, sep="\t", header=True, schema=schema, quote="", escape="", nullValue="\0", emptyValue="", enforceSchema=False)
    df = df.fillna("")
    return df if limit is None else df.limit(limit)


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A folder of tab-separated files; Spark's committer shows a file only once it is whole."""
    df.write.csv(path, sep="\t", header=True, mode=mode, quote="", escape="", emptyValue="")


def id_lists(df: DataFrame, column: str) -> DataFrame:
    """The comma-joined ids of ``column`` as an array; blanks and empty ids dropped."""
    return df.withColumn(column, F.filter(F.transform(F.split(F.coalesce(column, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != ""))


def load_records(frame: DataFrame) -> DataFrame:
    """Rows with an id, one for each (the last name and address in order on ties), normalized without their country."""
    kept = frame.filter(F.trim("entity_id") != "")
    one = kept.groupBy("entity_id").agg(F.max(F.struct(*[c for c in kept.columns if c != "entity_id"])).alias("r"))
    return normalize(one.select("entity_id", "r.*"), country_col=None)


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """(source1_entity_id, true_ids) of a file of matches."""
    return id_lists(read_tsv(spark, path, TRUTH), "matched_entity_ids").withColumnRenamed("matched_entity_ids", "true_ids")


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """(source1_entity_id, entity_id, rank) of a file of candidate lists, each id once, at its first place."""
    lists = id_lists(read_tsv(spark, path, CANDIDATES), "candidate_entity_ids")
    each = lists.select("source1_entity_id", F.posexplode(F.array_distinct("candidate_entity_ids")).alias("at", "entity_id"))
    return each.select("source1_entity_id", "entity_id", (F.col("at") + 1).alias("rank"))


def fingerprint(spark: SparkSession, path: str) -> str:
    """Of the paths, sizes and times of the files under ``path``, through Spark's own file system layer."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    return files.agg(F.sha2(F.concat_ws("|", F.array_sort(F.collect_list(F.concat_ws("|", "path", "length", "modificationTime")))), 256)).first()[0][:16]


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder, in whatever store Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def ensure_normalized(spark: SparkSession, path: str, cache_dir: str) -> DataFrame:
    """The records of ``path``, normalized once for each state of its files and kept as Parquet under ``cache_dir``."""
    out = f"{cache_dir}/{fingerprint(spark, path)}.normalized"
    if exists(spark, f"{out}/_SUCCESS"):  # else not there, or only half of it
        return spark.read.parquet(out)
    raw = read_tsv(spark, path)
    if raw.isEmpty():
        raise ValueError(f"{path} has no records")
    normalize(raw).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def not_yet_written(queries: DataFrame, written: DataFrame) -> DataFrame:
    """Queries without a row in earlier output: what a resumed run has left to do."""
    return queries.join(written.select(F.col("source1_entity_id").alias("entity_id")), "entity_id", "left_anti")


ACCENTS = ("éèêëàâäáùûüúîïíìôöóòçñÿ", "eeeeaaaauuuuiiiioooocny")


def clean(text):
    low = F.lower(text)
    plain = F.when(low.rlike(r"[^\x00-\x7F]"), F.translate(low, *ACCENTS)).otherwise(low)
    return F.trim(F.regexp_replace(plain, r"[^a-z0-9]+", " "))


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over all cores if its input has fewer splits than there are: a small table is often one."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def entity_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records made of whole documents: (entity_id, source, business_name, business_address, country, norm_name, norm_address, text).

    The lines that aren't blank are taken two by two, the first as name and the second as address; a text without any
    is one empty record. The document's id says which source its records belong to.
    """
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text"))
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))
    line = lambda l, at: F.coalesce(F.get(l, at), F.lit(""))
    two = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size("l") / 2), F.lit(1)).cast("int") - 1), lambda i: F.struct(line(F.col("l"), 2 * i).alias("a"), line(F.col("l"), 2 * i + 1).alias("b")))
    rows = docs.select("doc_id", "lang", lines.alias("l")).select("doc_id", "lang", F.posexplode(two).alias("i", "e"))  # not beside l, which would be copied for each row
    source = (1 + F.col("doc_id") % 3).cast("int")
    out = rows.select(
        F.concat(F.lit("S"), source, F.lit("-"), "doc_id", F.lit("-"), "i").alias("entity_id"),
        source.alias("source"),
        F.col("e.a").alias("business_name"),
        F.col("e.b").alias("business_address"),
        F.when(F.col("lang") == "en", "US").when(F.col("lang") == "fr", "France").otherwise("").alias("country"),
    )
    return out.withColumns({"norm_name": clean(F.col("business_name")), "norm_address": clean(F.col("business_address")), "text": F.concat_ws("\n", "business_name", "business_address")})


def truth(entities: DataFrame) -> DataFrame:
    """(source1_entity_id, true_ids): of each target source the first record with the query's whole text."""
    key = F.sha2("text", 256)
    a = entities.filter("source = 1").select(F.col("entity_id").alias("source1_entity_id"), key.alias("k"))
    one = lambda n: F.min(F.when(F.col("source") == n, F.col("entity_id")))
    b = entities.filter("source > 1").groupBy(key.alias("k")).agg(F.array_compact(F.array(one(2), one(3))).alias("true_ids"))
    return a.join(b, "k", "left").select("source1_entity_id", F.coalesce("true_ids", F.expr("cast(array() as array<string>)")).alias("true_ids"))
