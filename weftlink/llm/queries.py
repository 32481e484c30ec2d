"""The queries of this subpackage: thin digests of what its operators return."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, lines, pii, quality, secrets, sharding, simhash, suffixes
from .shared import read

RANKS = "byte_bpe_multi_50k.tiktoken"
KEY = "weftlink example key"


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.hits(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hit_spans") > 0).alias("contaminated"))


def op3_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(read(spark, sf_dir, "documents").select("doc_id", "text"), KEY)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secrets(read(spark, sf_dir, "documents"))
    of = lambda k: F.filter("base", lambda s: s["kind"] == k)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in secrets.ORDER]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(secrets.spans_text(F.col("base")), 256).alias("base_sha256"), secrets.spans_text(F.col("found")).alias("spans"))


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of all documents that are labelled good and not toxic."""
    return read(spark, sf_dir, "labels").filter("quality = 1 AND toxic = 0").select("doc_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"), trusted=trusted(spark, sf_dir)).select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.size("removed_lines").cast("long").alias("n_removed"), "removed_lines", "text")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "conversations").select(*(F.col(c).cast(t).alias(c) for c, t in (("conv_id", "long"), ("turn", "long"), ("role", "string"), ("text", "string"))))
    probe = f"{chat.END.strip()}{chat.START}assistant ok"
    more = spark.sql("SELECT * FROM VALUES (-1L, 0L, 'user', :probe), (-1L, 1L, 'assistant', :probe) AS t(conv_id, turn, role, text)", {"probe": probe})
    made = chat.format_trees(chat.linear(own.unionByName(more)))
    formatted = F.col("formatted")
    turns = made.withColumns({"turns": chat.read_back(formatted), "loss": chat.masked_text(formatted, F.col("loss_spans"))})
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(read(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(F.col("id").alias("doc_id"), (F.octet_length("kept") + removed).alias("n_bytes"), removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard(read(spark, sf_dir, "documents"), 40)
    return found.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {f.__name__: f for f in (op1_simhash, op2_decontaminate, op3_pseudonyms, op4_bpe, op5_secrets, op6_quality, op7_lines, op8_chat, op9_suffixes, op10_shards)}
ORACLES: dict[str, str] = {
    "op8_chat": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (SELECT *, replace(replace(replace(role, '\', '\0'), '<|', '<\1'), chr(10), '\2') AS r, replace(replace(text, '\', '\0'), '<|', '<\1') AS t FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>') + length(r) + 1 + length(t) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",
    "op2_decontaminate": r"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
i AS (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 8, 2))) AS p FROM b WHERE len(w) > 0),
win AS MATERIALIZED (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS s FROM i),
pos AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k),
hit AS MATERIALIZED (SELECT doc_id, p, k, item_id FROM (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS s FROM pos) JOIN win USING (k, s)),
spot AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hit) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(spot.n, 0) AS n_hit, coalesce(found.n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, spot.n IS NOT NULL AS contaminated
FROM d LEFT JOIN spot USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op7_lines": r"""
WITH d AS MATERIALIZED (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
x AS MATERIALIZED (SELECT doc_id, pos, line, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i, len(regexp_extract_all(line, '[^ \t\n\x0B\f\r]+')) AS w
  FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS pos FROM d) WHERE regexp_matches(line, '[^ \t\n\x0B\f\r]')),
c AS MATERIALIZED (SELECT doc_id, i, sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS upto, w FROM x),
forward AS (SELECT a.doc_id, a.i, min(b.i) AS j FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.i < a.i + 10 AND b.upto - a.upto + a.w >= 10 GROUP BY a.doc_id, a.i),
backward AS (SELECT b.doc_id, max(a.i) AS i, b.i AS j FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.i < a.i + 10 AND b.upto - a.upto + a.w >= 10 GROUP BY b.doc_id, b.i),
runs AS MATERIALIZED (SELECT * FROM forward UNION SELECT * FROM backward),
said AS (SELECT runs.doc_id, runs.i, runs.j, string_agg(line, chr(10) ORDER BY x.i) AS s FROM runs JOIN x ON x.doc_id = runs.doc_id AND x.i BETWEEN runs.i AND runs.j GROUP BY ALL),
late AS (SELECT doc_id, i, j FROM said QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
gone AS MATERIALIZED (SELECT DISTINCT late.doc_id, unnest(range(f.pos, t.pos + 1)) AS pos FROM late JOIN x f ON f.doc_id = late.doc_id AND f.i = late.i JOIN x t ON t.doc_id = late.doc_id AND t.i = late.j),
lists AS (SELECT doc_id, list(pos ORDER BY pos) AS removed_lines FROM gone GROUP BY doc_id)
SELECT doc_id, coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(len(removed_lines), 0)::BIGINT AS n_removed, coalesce(removed_lines, []) AS removed_lines,
  CASE WHEN removed_lines IS NULL THEN text ELSE coalesce(array_to_string(list_filter(l, lambda v, n: NOT list_contains(removed_lines, n - 1)), chr(10)), '') END AS text FROM d LEFT JOIN lists USING (doc_id)""",
    "op9_suffixes": r"""
WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
p AS MATERIALIZED (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(n - 49)) AS i FROM d)),
first AS (SELECT s, min(doc_id) AS m FROM p GROUP BY s),
late AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 50, true) AS opens FROM p JOIN first USING (s) WHERE m < doc_id),
spans AS MATERIALIZED (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM (SELECT doc_id, i, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM late) GROUP BY doc_id, k),
kept AS (SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM (SELECT doc_id, a, b FROM spans UNION ALL SELECT doc_id, n, n FROM d)),
text AS (SELECT doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a, before) AS x FROM kept JOIN d USING (doc_id) GROUP BY doc_id),
gone AS (SELECT doc_id, sum(b - a) AS r, count(*) AS k FROM spans GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(r, 0)::BIGINT AS n_removed, coalesce(k, 0) AS n_spans, sha256(unhex(x)) AS kept_sha256 FROM d JOIN text USING (doc_id) LEFT JOIN gone USING (doc_id)""",
    "op10_shards": r"""
WITH RECURSIVE crc(i, c, k) AS (SELECT i, i, 0 FROM range(256) t(i) UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc WHERE k < 8),
tab AS MATERIALIZED (SELECT list(c ORDER BY i) AS tab FROM crc WHERE k = 8),
bytes AS (SELECT coalesce(text, '') AS t, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ((instr('0123456789ABCDEF', x[1]) - 1) * 16 + instr('0123456789ABCDEF', x[2]) - 1)::BIGINT) AS b FROM (SELECT DISTINCT coalesce(text, '') AS text FROM documents)),
sums AS MATERIALIZED (SELECT t, xor(list_reduce(b, lambda a, x: xor(a >> 8, tab[(xor(a, x) & 255) + 1]), 4294967295), 4294967295) AS crc FROM bytes, tab),
z AS MATERIALIZED (SELECT doc_id, sha256(coalesce(text, '')) AS h, (strlen(coalesce(text, '')) + 16)::BIGINT AS size, crc FROM documents JOIN sums ON t = coalesce(text, '')),
g AS MATERIALIZED (SELECT h, sum(size)::BIGINT AS s, sum(sum(size)) OVER (ORDER BY h)::BIGINT AS cum FROM z GROUP BY h),
l AS MATERIALIZED (SELECT list({'n': 1, 'at': s} ORDER BY h) AS a FROM g),
search(lo, hi) AS (SELECT greatest(max(s), (sum(s) + 39) // 40)::BIGINT, sum(s)::BIGINT FROM g UNION ALL
  SELECT CASE WHEN n <= 40 THEN lo ELSE m + 1 END, CASE WHEN n <= 40 THEN m ELSE hi END FROM
  (SELECT lo, hi, m, list_reduce(a, lambda x, y: CASE WHEN x.at + y.at > m THEN {'n': x.n + 1, 'at': y.at} ELSE {'n': x.n, 'at': x.at + y.at} END).n AS n FROM (SELECT lo, hi, (lo + hi) // 2 AS m FROM search WHERE lo < hi), l)),
cap AS MATERIALIZED (SELECT lo AS c FROM search WHERE lo = hi),
cut(k, base) AS (SELECT 0, 0::BIGINT UNION ALL SELECT k + 1, max(cum) FROM cut, cap, g WHERE base < (SELECT max(cum) FROM g) AND cum <= base + c GROUP BY k),
shard AS (SELECT h, count(*)::INT - 1 AS shard FROM g JOIN cut ON base < cum GROUP BY h)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY md5(h || ':' || coalesce(doc_id::VARCHAR, '')), doc_id, h) - 1 AS slot, NULL::INT AS grown_shard FROM z JOIN shard USING (h)""",
}
