"""Queries by name over the entity views, and the same in DuckDB SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checkpoints import written
from ..functions import dicts
from ..functions import normalize as N
from ..functions.similarity import FEATURES
from ..operators import blocking, learn, matching, metrics
from ..sources.tables import entity_views, truth
from .resolve import mean_score

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.entities = entity_views(spark, sf_dir)

    @cached_property
    def records(self) -> DataFrame:
        """The entities without the texts that they are made of, written down: each step reads them."""
        return written(self.entities.select("entity_id", "source", "country", "norm_name", "norm_address"))

    @cached_property
    def s1(self) -> DataFrame:
        return self.records.filter("source = 1").drop("source")

    @cached_property
    def targets(self) -> DataFrame:
        return self.records.filter("source > 1").withColumn("target_row", F.struct("source", "entity_id"))

    @cached_property
    def truth(self) -> DataFrame:
        return truth(self.entities)

    @cached_property
    def index(self) -> blocking.Index:
        return blocking.Index(self.targets)

    def compared(self) -> DataFrame:
        return matching.compared(self.ranked, self.s1, self.targets)

    @cached_property
    def ranked(self) -> DataFrame:
        return written(self.index.candidates(self.s1))


BASE = r"""
WITH raw AS (SELECT doc_id, 1 + doc_id % 3 AS source, lang, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS l FROM documents),
rows AS (SELECT *, unnest(range(greatest((len(l) + 1) // 2, 1))) AS i FROM raw),
cut AS (SELECT 'S' || source || '-' || doc_id || '-' || i AS entity_id, source, coalesce(l[2 * i + 1], '') AS business_name, coalesce(l[2 * i + 2], '') AS business_address,
  CASE lang WHEN 'en' THEN 'US' WHEN 'fr' THEN 'France' ELSE '' END AS country FROM rows),
e AS MATERIALIZED (SELECT *, business_name || chr(10) || business_address AS text, trim(regexp_replace(regexp_replace(strip_accents(lower(business_name)), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) AS norm_name,
  trim(regexp_replace(regexp_replace(strip_accents(lower(business_address)), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) AS norm_address FROM cut),
tok AS MATERIALIZED (SELECT DISTINCT entity_id, source, field, token FROM (
  SELECT entity_id, source, 'name' AS field, unnest(string_split(norm_name, ' ')) AS token FROM e UNION ALL
  SELECT entity_id, source, 'address', unnest(string_split(norm_address, ' ')) FROM e) WHERE token <> ''),
n AS (SELECT count(*) AS n FROM e WHERE source > 1),
df AS MATERIALIZED (SELECT field, token, count(*) AS df FROM tok WHERE source > 1 GROUP BY ALL
  HAVING count(*) <= (SELECT greatest(1, least(floor(n * 0.02), 25000)) FROM n)),
idf AS MATERIALIZED (SELECT field, token, df, ln((n + 1) / (df + 1)) + 1 AS idf FROM df, n),
post AS MATERIALIZED (SELECT entity_id, source, field, token, idf FROM tok JOIN idf USING (field, token) WHERE source > 1),
tot AS MATERIALIZED (SELECT entity_id, source, field, sum(idf)::FLOAT AS total FROM post GROUP BY ALL),
q AS MATERIALIZED (SELECT entity_id AS source1_entity_id, field, token, idf, sum(idf) OVER (PARTITION BY entity_id, field) AS total,
  row_number() OVER (PARTITION BY entity_id, field ORDER BY idf DESC, token) AS rank FROM tok JOIN idf USING (field, token) WHERE source = 1),
sh AS (SELECT source1_entity_id, q.field, p.source, p.entity_id, sum(p.idf) AS common, any_value(q.total) AS qt FROM q JOIN post p USING (field, token) WHERE rank <= 5 GROUP BY ALL),
sc AS (SELECT source1_entity_id, sh.field, sh.source, sh.entity_id, round(common / (qt + total::DOUBLE - common), 9) AS score FROM sh JOIN tot USING (field, source, entity_id)
  WHERE qt + total::DOUBLE - common > 0 AND common >= 0.18 * (qt + total::DOUBLE - common)),
fc AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source1_entity_id, field ORDER BY score DESC, source, entity_id) AS rank FROM sc) WHERE rank <= 50),
best AS (SELECT source1_entity_id, entity_id, max(score) AS score FROM fc GROUP BY ALL),
ranked AS MATERIALIZED (SELECT source1_entity_id, entity_id, score, row_number() OVER (PARTITION BY source1_entity_id ORDER BY score DESC, entity_id) AS rank FROM best
  QUALIFY row_number() OVER (PARTITION BY source1_entity_id ORDER BY score DESC, entity_id DESC) <= 100),
one AS (SELECT text, source, min(entity_id) AS entity_id FROM e WHERE source > 1 GROUP BY ALL),
tr AS MATERIALIZED (SELECT a.entity_id AS source1_entity_id, list(b.entity_id) FILTER (b.entity_id IS NOT NULL) AS ids FROM e a LEFT JOIN one b ON a.text = b.text WHERE a.source = 1 GROUP BY ALL),
truth AS MATERIALIZED (SELECT source1_entity_id, coalesce(ids, []) AS true_ids FROM tr)
"""
GRAMS = r"""
, g0 AS (SELECT entity_id, 'name' AS field, norm_name AS s FROM e UNION ALL SELECT entity_id, 'addr', norm_address FROM e),
g1 AS (SELECT entity_id, field, s, unnest(range(1, greatest(length(s) - 2, 1) + 1)) AS i FROM g0 WHERE s <> ''),
gram AS MATERIALIZED (SELECT entity_id, field, substring(s, i, 3) AS g, count(*) AS c FROM g1 GROUP BY ALL),
gn AS MATERIALIZED (SELECT entity_id, field, sqrt(sum(c * c)) AS norm FROM gram GROUP BY ALL),
dot AS (SELECT r.source1_entity_id, r.entity_id, a.field, sum(a.c * b.c) AS d FROM ranked r JOIN gram a ON a.entity_id = r.source1_entity_id
  JOIN gram b ON b.entity_id = r.entity_id AND b.field = a.field AND b.g = a.g GROUP BY ALL),
cs AS MATERIALIZED (SELECT d.source1_entity_id, d.entity_id, d.field, d / (x.norm * y.norm) AS cosine FROM dot d JOIN gn x ON x.entity_id = d.source1_entity_id AND x.field = d.field
  JOIN gn y ON y.entity_id = d.entity_id AND y.field = d.field),
p0 AS (SELECT r.source1_entity_id, r.entity_id, r.rank, a.country AS ac, b.country AS bc, a.norm_name AS an, b.norm_name AS bn, a.norm_address AS aa, b.norm_address AS ba,
  list_distinct(list_filter(string_split(a.norm_name, ' '), lambda x: x <> '')) AS ant, list_distinct(list_filter(string_split(b.norm_name, ' '), lambda x: x <> '')) AS bnt,
  list_distinct(list_filter(string_split(a.norm_address, ' '), lambda x: x <> '')) AS aat, list_distinct(list_filter(string_split(b.norm_address, ' '), lambda x: x <> '')) AS bat,
  list_distinct(regexp_extract_all(a.norm_address, '\b\d+\b')) AS anum, list_distinct(regexp_extract_all(b.norm_address, '\b\d+\b')) AS bnum
  FROM ranked r JOIN e a ON a.entity_id = r.source1_entity_id JOIN e b ON b.entity_id = r.entity_id),
p1 AS (SELECT *, len(list_intersect(ant, bnt))::DOUBLE AS cn, len(list_intersect(aat, bat))::DOUBLE AS ca, len(ant) + len(bnt) AS tn, len(aat) + len(bat) AS ta FROM p0),
pf AS MATERIALIZED (SELECT p1.source1_entity_id, p1.entity_id, p1.rank, ac, bc, ba, anum, bnum,
  1 - levenshtein(an, bn) / greatest(length(an), length(bn), 1) AS name_levenshtein, CASE WHEN tn > 0 THEN cn / (tn - cn) ELSE 0 END AS name_jaccard,
  coalesce(x.cosine, 0) AS name_tfidf_cosine, 1 - levenshtein(aa, ba) / greatest(length(aa), length(ba), 1) AS addr_levenshtein,
  CASE WHEN ta > 0 THEN ca / (ta - ca) ELSE 0 END AS addr_jaccard, coalesce(y.cosine, 0) AS addr_tfidf_cosine, cn AS common_name_tokens, ca AS common_addr_tokens,
  abs(length(an) - length(bn))::DOUBLE AS name_len_diff, abs(length(aa) - length(ba))::DOUBLE AS addr_len_diff, (an <> '' AND an = bn)::INT::DOUBLE AS exact_name_match,
  (aa <> '' AND aa = ba)::INT::DOUBLE AS exact_addr_match, CASE WHEN tn > 0 THEN 2 * cn / tn ELSE 0 END AS name_token_ratio, CASE WHEN ta > 0 THEN 2 * ca / ta ELSE 0 END AS addr_token_ratio
  FROM p1 LEFT JOIN cs x ON x.source1_entity_id = p1.source1_entity_id AND x.entity_id = p1.entity_id AND x.field = 'name'
  LEFT JOIN cs y ON y.source1_entity_id = p1.source1_entity_id AND y.entity_id = p1.entity_id AND y.field = 'addr'),
gp0 AS (SELECT *, greatest(name_levenshtein, name_jaccard, name_token_ratio) AS nm, len(list_intersect(anum, bnum)) > 0 AS hit, len(anum) > 0 AND len(bnum) > 0 AS both_num FROM pf
  WHERE (ac = '' OR bc = '' OR ac = bc) AND (common_name_tokens > 0 OR common_addr_tokens > 0)),
gp AS MATERIALIZED (SELECT *, round((name_levenshtein + name_tfidf_cosine + addr_levenshtein + addr_tfidf_cosine) / 4, 9) AS probability FROM gp0
  WHERE NOT (both_num AND NOT hit AND nm < 0.60) AND NOT (ba = '' AND nm < 0.60) AND NOT (common_name_tokens = 0 AND nm < 0.40 AND NOT (hit AND addr_levenshtein >= 0.85))
  AND NOT (nm < 0.35 AND addr_levenshtein < 0.85)),
m AS MATERIALIZED (SELECT source1_entity_id, entity_id, probability, row_number() OVER (PARTITION BY source1_entity_id ORDER BY probability DESC, rank) AS place FROM gp WHERE probability >= 0.82
  QUALIFY place <= 6),
pred AS MATERIALIZED (SELECT truth.source1_entity_id, true_ids, coalesce(ids, []) AS pred_ids FROM truth LEFT JOIN (SELECT source1_entity_id, list(entity_id) AS ids FROM m GROUP BY 1) USING (source1_entity_id)),
f AS (SELECT *, len(list_intersect(true_ids, pred_ids)) AS tp FROM pred),
ef AS MATERIALIZED (SELECT *, CASE WHEN len(true_ids) = 0 THEN (len(pred_ids) = 0)::INT::DOUBLE WHEN tp = 0 THEN 0
  ELSE 1.25 * (tp / len(pred_ids)) * (tp / len(true_ids)) / (0.25 * (tp / len(pred_ids)) + tp / len(true_ids)) END AS f05 FROM f)
"""
R = lambda c: F.round(c, 6).alias(c)


def rounded(*names: str) -> str:
    return ", ".join(f"round({x}, 6) AS {x}" for x in names)


@query(BASE + "SELECT field, token, df FROM df")
def token_document_frequency(spark, sf_dir):
    return Views(spark, sf_dir).index.frequency


@query(BASE + "SELECT field, token, df, round(idf, 6) AS idf FROM idf")
def token_idf(spark, sf_dir):
    return Views(spark, sf_dir).index.idf.select("field", "token", "df", R("idf"))


@query(BASE + "SELECT entity_id, field, round(total::DOUBLE, 3) AS total FROM tot")
def target_rarity_totals(spark, sf_dir):
    return Views(spark, sf_dir).index.totals.select("target_row.entity_id", "field", F.round(F.col("total").cast("double"), 3).alias("total"))


@query(BASE + "SELECT source1_entity_id, field, token, round(idf, 6) AS idf, round(total, 6) AS total, rank FROM q WHERE rank <= 5")
def query_rare_tokens(spark, sf_dir):
    v = Views(spark, sf_dir)
    rows = blocking.token_rows(v.s1.withColumnRenamed("entity_id", "source1_entity_id"), "source1_entity_id")
    return blocking.query_tokens(rows, v.index.idf).filter(F.col("rank") <= blocking.PROBES).select("source1_entity_id", "field", "token", R("idf"), R("total"), F.col("rank").cast("long"))


def _field(spark, sf_dir, field):
    v = Views(spark, sf_dir)
    found = v.index.field_candidates(v.s1.withColumnRenamed("entity_id", "source1_entity_id"), {"name": 0.18, "address": 0.18}, fields=(field,))
    return found.select("source1_entity_id", "entity_id", R("score"))


@query(BASE + "SELECT source1_entity_id, entity_id, round(score, 6) AS score FROM fc WHERE field = 'name'")
def name_candidates(spark, sf_dir):
    return _field(spark, sf_dir, "name")


@query(BASE + "SELECT source1_entity_id, entity_id, round(score, 6) AS score FROM fc WHERE field = 'address'")
def address_candidates(spark, sf_dir):
    return _field(spark, sf_dir, "address")


@query(BASE + "SELECT source1_entity_id, entity_id, round(score, 6) AS score, rank FROM ranked")
def blocked_candidates(spark, sf_dir):
    return Views(spark, sf_dir).ranked.select("source1_entity_id", "entity_id", R("score"), F.col("rank").cast("long"))


@query(BASE + "SELECT e.entity_id AS source1_entity_id, coalesce(string_agg(r.entity_id, ',' ORDER BY r.rank), '') AS candidate_entity_ids FROM e LEFT JOIN ranked r ON r.source1_entity_id = e.entity_id WHERE e.source = 1 GROUP BY e.entity_id")
def candidate_lists(spark, sf_dir):
    v = Views(spark, sf_dir)
    lists = blocking.candidate_lists(v.s1, v.ranked)
    return lists.select("source1_entity_id", F.array_join(F.col("candidates.entity_id"), ",").alias("candidate_entity_ids"))


def _features(names):
    def run(spark, sf_dir):
        return Views(spark, sf_dir).compared().select("source1_entity_id", "entity_id", *map(R, names))

    return run, BASE + GRAMS + f"SELECT source1_entity_id, entity_id, {rounded(*names)} FROM pf"


for _name, _names in {
    "pair_levenshtein": FEATURES[0:4:3], "pair_jaccard": FEATURES[1:5:3], "pair_trigram_cosine": FEATURES[2:6:3], "pair_dice": FEATURES[12:14],
    "pair_exact": FEATURES[10:12], "pair_length_diff": FEATURES[8:10], "pair_common_tokens": FEATURES[6:8], "pair_features": FEATURES,
}.items():
    QUERIES[_name], ORACLES[_name] = _features(_names)


@query(BASE + GRAMS + "SELECT source1_entity_id, entity_id, len(list_intersect(anum, bnum)) > 0 AS numbers_match, len(anum) > 0 AND len(bnum) > 0 AND len(list_intersect(anum, bnum)) = 0 AS numbers_conflict FROM p0")
def house_number_overlap(spark, sf_dir):
    return Views(spark, sf_dir).compared().select("source1_entity_id", "entity_id", "numbers_match", "numbers_conflict")


@query(BASE + GRAMS + "SELECT source1_entity_id, entity_id, round(probability, 6) AS score FROM gp")
def gated_pairs(spark, sf_dir):
    return matching.gated(Views(spark, sf_dir).compared()).select("source1_entity_id", "entity_id", F.round(mean_score(), 6).alias("score"))


def _matches(v: Views) -> DataFrame:
    scored = matching.gated(v.compared()).withColumn("probability", mean_score())
    return matching.top_matches(scored.select("source1_entity_id", "entity_id", "rank", "probability"))


@query(BASE + GRAMS + "SELECT source1_entity_id, entity_id, round(probability, 6) AS score, place FROM m")
def matches_topk(spark, sf_dir):
    return _matches(Views(spark, sf_dir)).select("source1_entity_id", "entity_id", F.round("probability", 6).alias("score"), F.col("place").cast("long"))


@query(BASE + GRAMS + "SELECT e.entity_id AS source1_entity_id, coalesce(string_agg(m.entity_id, ',' ORDER BY m.place), '') AS matched_entity_ids FROM e LEFT JOIN m ON m.source1_entity_id = e.entity_id WHERE e.source = 1 GROUP BY e.entity_id")
def match_lists(spark, sf_dir):
    v = Views(spark, sf_dir)
    return matching.match_lists(v.s1, _matches(v)).select("source1_entity_id", F.array_join("matched_entity_ids", ",").alias("matched_entity_ids"))


def _predicted(v: Views) -> DataFrame:
    return metrics.with_predictions(v.truth, matching.match_lists(v.s1, _matches(v)))


@query(BASE + GRAMS + "SELECT source1_entity_id, round(f05, 6) AS f05 FROM ef")
def entity_f05(spark, sf_dir):
    return _predicted(Views(spark, sf_dir)).select("source1_entity_id", F.round(metrics.entity_f05(F.col("true_ids"), F.col("pred_ids")), 6).alias("f05"))


@query(BASE + GRAMS + """SELECT round(avg(f05), 6) AS macro_f05, round(coalesce(sum(tp) FILTER (len(true_ids) > 0) / sum(len(pred_ids)) FILTER (len(true_ids) > 0), 0), 6) AS "precision",
round(coalesce(sum(tp) FILTER (len(true_ids) > 0) / sum(len(true_ids)), 0), 6) AS recall, round(coalesce(count(*) FILTER (len(true_ids) = 0 AND len(pred_ids) = 0) / count(*) FILTER (len(true_ids) = 0), 1), 6) AS singleton_accuracy,
count(*) FILTER (len(true_ids) = 0) AS singleton_count, count(*) FILTER (len(true_ids) > 0) AS non_singleton_count, count(*) AS total_queries FROM ef""")
def macro_f05(spark, sf_dir):
    ratios = ["macro_f05", "precision", "recall", "singleton_accuracy"]
    return metrics.macro_f05(_predicted(Views(spark, sf_dir))).select(*map(R, ratios), "singleton_count", "non_singleton_count", "total_queries")


@query(BASE + GRAMS + """, th AS (SELECT unnest([""" + ", ".join(map(str, metrics.SWEEP)) + """])::DOUBLE AS threshold),
sw AS (SELECT threshold, t.source1_entity_id, any_value(true_ids) AS true_ids, coalesce(list(gp.entity_id) FILTER (probability >= threshold), []) AS pred_ids FROM th CROSS JOIN truth t LEFT JOIN gp ON gp.source1_entity_id = t.source1_entity_id GROUP BY ALL),
s2 AS (SELECT *, len(list_intersect(true_ids, pred_ids)) AS tp FROM sw)
SELECT threshold, round(avg(CASE WHEN len(true_ids) = 0 THEN (len(pred_ids) = 0)::INT::DOUBLE WHEN tp = 0 THEN 0 ELSE 1.25 * (tp / len(pred_ids)) * (tp / len(true_ids)) / (0.25 * (tp / len(pred_ids)) + tp / len(true_ids)) END), 6) AS macro_f05 FROM s2 GROUP BY threshold""")
def threshold_sweep(spark, sf_dir):
    v = Views(spark, sf_dir)
    scored = matching.gated(v.compared()).withColumn("probability", mean_score()).select("source1_entity_id", "entity_id", "probability")
    return metrics.threshold_sweep(v.truth, scored).select("threshold", R("macro_f05"))


@query(BASE + """, hit AS (SELECT source1_entity_id, count(*) AS hits, min(rank) AS first FROM truth JOIN ranked USING (source1_entity_id) WHERE list_contains(true_ids, entity_id) GROUP BY 1),
cand AS (SELECT source1_entity_id, count(*) AS c FROM ranked GROUP BY 1),
b AS (SELECT truth.*, hits, first, coalesce(c, 0) AS c, len(true_ids) > 0 AS pos FROM truth LEFT JOIN hit USING (source1_entity_id) LEFT JOIN cand USING (source1_entity_id))
SELECT round(coalesce(count(hits) / nullif(count(*) FILTER (pos), 0), 0), 6) AS query_recall, round(coalesce(sum(hits) / nullif(sum(len(true_ids)), 0), 0), 6) AS edge_recall,
round(coalesce(sum(1 / first) / nullif(count(*) FILTER (pos), 0), 0), 6) AS mrr, round(sum(c) / count(*), 6) AS average_candidates,
round(1 - sum(c) / (count(*) * (SELECT n FROM n)), 6) AS reduction_ratio, round(coalesce(count(*) FILTER (NOT pos AND c > 0) / nullif(count(*) FILTER (NOT pos), 0), 0), 6) AS singleton_candidate_rate FROM b""")
def blocking_quality(spark, sf_dir):
    v = Views(spark, sf_dir)
    out = metrics.blocking_quality(v.truth, v.ranked, v.targets.count())
    return out.select(*map(R, out.columns))


@query("SELECT doc_id, CASE WHEN lower(trim(text, E' \\t\\n\\r\\x0b\\x0c')) IN ('null', '<null>', '(null)', 'none', 'n/a', 'nan', '') OR text IS NULL THEN '' ELSE trim(text, E' \\t\\n\\r\\x0b\\x0c') END AS text FROM documents")
def null_scrub(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", N.clean_base(F.col("text")).alias("text"))


@query(r"SELECT page_id, regexp_replace(regexp_replace(url, 'https?://\S+|www\.\S+', '', 'g'), '(?i)\b([a-z0-9_-]+)\.(?:com|in|org|net|co|io|gov|edu|fr)\b', '\1', 'g') AS text, regexp_replace(html, 'https?://\S+|www\.\S+', '', 'g') AS html FROM pages")
def strip_urls(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", N.without_urls(F.col("url")).alias("text"), F.regexp_replace("html", r"https?://\S+|www\.\S+", "").alias("html"))


@query(r"SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(lower(text), '\b(\d+)(?:st|nd|rd|th)\b', '\1', 'g'), '[^a-z0-9\s]', ' ', 'g'), '\b0+(\d+)\b', '\1', 'g') AS text FROM documents")
def ordinals_zeros(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", N.ordinals_and_zeros(F.lower("text")).alias("text"))


def _case(maps: list[dict[str, str]]) -> str:
    first: dict[str, str] = {}
    for m in reversed(maps):
        first |= m
    return "CASE w " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in first.items()) + " ELSE w END"


WORDS_SQL = "list_filter(string_split_regex(regexp_replace(lower(text), '[^a-z0-9]', ' ', 'g'), ' +'), lambda x: x <> '')"


@query(f"WITH t AS (SELECT doc_id, {WORDS_SQL} AS l FROM documents), w AS (SELECT doc_id, unnest(l) AS w, generate_subscripts(l, 1) AS i FROM t) "
       f"SELECT t.doc_id, coalesce((SELECT string_agg({_case([dicts.ADDRESS_WORDS, dicts.ALL_STATES])}, ' ' ORDER BY i) FROM w WHERE w.doc_id = t.doc_id), '') AS text FROM t")  # fmt: skip
def token_expand_address(spark, sf_dir):
    words = N.tokens(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "[^a-z0-9]", " "))
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.array_join(N.expanded(words, N.literal_map(dicts.ADDRESS_WORDS), N.literal_map(dicts.ALL_STATES)), " ").alias("text"))


_FORMS = "|".join(dicts.LEGAL_FORMS)


@query(rf"""WITH t AS (SELECT doc_id, array_to_string({WORDS_SQL}, ' ') AS text FROM documents)
SELECT doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '(\S)(?: (?:{_FORMS}))+$', '\1'), '^(?:(?:{_FORMS}) )+(\S)', '\1') AS text FROM t""")
def legal_suffix_strip(spark, sf_dir):
    words = N.tokens(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "[^a-z0-9]", " "))
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", N.without_legal_forms(F.array_join(words, " ")).alias("text"))


@query()
def normalize_name_full(spark, sf_dir):
    return Views(spark, sf_dir).entities.select("entity_id", N.normalized_name(F.col("business_name")).alias("norm_name"))


@query()
def normalize_address_full(spark, sf_dir):
    return Views(spark, sf_dir).entities.select("entity_id", N.normalized_address(F.col("business_address"), F.col("country")).alias("norm_address"))


@query()
def hard_negatives(spark, sf_dir):
    v = Views(spark, sf_dir)
    pool = learn.negative_pool(learn.with_tokens(v.targets).select("entity_id", "country", "name_tokens", "addr_tokens"), 1)
    asked = learn.with_tokens(v.s1.withColumnRenamed("entity_id", "source1_entity_id")).join(v.truth, "source1_entity_id").select("source1_entity_id", "country", "true_ids", "name_tokens", "addr_tokens")
    return learn.hard_negatives(asked, pool, "addr", 6).withColumn("field", F.lit("address")).unionByName(learn.hard_negatives(asked, pool, "name", 4).withColumn("field", F.lit("name")))


@query()
def train_score(spark, sf_dir):
    v = Views(spark, sf_dir)
    queries = v.s1.withColumnRenamed("entity_id", "source1_entity_id").join(v.truth, "source1_entity_id")
    return learn.train_and_evaluate(queries, v.targets, pool_step=1, pool_cap=None).sweep.select("threshold", R("macro_f05"))
