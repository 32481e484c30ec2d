"""The registered queries themselves on small tables: against plain versions, and against their SQL where there is some."""

import hashlib
import random
import re
import struct

import duckdb
import pytest
import tiktoken
import xxhash

import public_tokenizers
from weftlink.llm import bpe, quality
from weftlink.llm.queries import ORACLES, QUERIES, RANKS

from test_operators import LONG, corpus, docs

WORDS = r"[^\x20\x09-\x0D]+"


def rows():
    shared = "the same passage of many words stands in more than one of these documents and is long enough"
    out = corpus(21, 50) + [(200, None), (201, ""), (202, " \n\t "), (203, LONG[:9000]), (204, f"a {shared} b"), (205, f"c\n{shared}\nd"), (206, f"c\n{shared}\nd")]
    return out + [(207, "token = abcdefghijkl9 AKIA12345678901234 0123456789abcdef0"), (208, "PASSWORD: 'ÄÖ' secret=shortone api_key: aaaa.bbbb.cccc")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path, rng = tmp_path_factory.mktemp("digests"), random.Random(2)
    docs(spark, rows()).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame([(1, "passage of many words stands in more than one of these documents and so on"), (2, "of these documents"), (3, None), (4, ""), (10, "of these documents")], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    talk = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "<|im_end|>\n", "\\0 <\\1", None, "é" * 50])) for c in range(8) for t in range(rng.randint(1, 6))]
    spark.createDataFrame([*talk, talk[0], (None, 1, "assistant", "x")], "conv_id long, turn long, role string, text string").write.parquet(str(path / "conversations.parquet"))
    return path


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_is_its_sql(spark, folder, name):
    base = duckdb.connect()
    for table in folder.iterdir():
        base.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}/*.parquet'")
    frame = QUERIES[name](spark, str(folder))
    columns = sorted(frame.columns)
    want = base.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(repr(tuple(r[c] for c in columns)) for r in frame.collect()) == sorted(map(repr, want))


def told(spark, folder, name):
    return {r.doc_id: r for r in QUERIES[name](spark, str(folder)).collect()}


def test_simhash_digest(spark, folder):
    got, prints = told(spark, folder, "op1_simhash"), {}
    for d, t in rows():
        w = re.findall(WORDS, (t or "").translate({c: c + 32 for c in range(65, 91)}))
        h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
        prints[d] = sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))
    label = {d: d for d in prints}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    while any(label[a] != label[b] for a, b in links):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert {d: (r.fingerprint, r.component_id) for d, r in got.items()} == {d: (f"{p:016x}", label[d]) for d, p in prints.items()}


def test_bpe_digest(spark, folder):
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path(RANKS)), special_tokens={})
    got = told(spark, folder, "op4_bpe")
    for d, t in rows():
        ids = theirs.encode_ordinary(t or "")
        assert (got[d].n_tokens, got[d].ids_sha256, got[d].decoded_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())


def test_secret_digest(spark, folder):
    patterns = [("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16)]
    got = told(spark, folder, "op5_secrets")
    for d, t in rows():
        base = sorted((m.start(), k, m.end(), kind) for k, (kind, p, g, n) in enumerate(patterns) for m in re.finditer(p, t or "", re.ASCII) if len(m.group(g)) >= n)
        assert [got[d][f"n_{kind}"] for kind, *_ in patterns] == [sum(b[3] == kind for b in base) for kind, *_ in patterns]
        text = ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in base)
        assert got[d].base_sha256 == hashlib.sha256(text.encode()).hexdigest() and set(filter(None, text.split(","))) <= set(got[d].spans.split(","))


def test_quality_digest(spark, folder):
    got = told(spark, folder, "op6_quality")
    for d, t in rows():
        base = quality.base_counts(t or "")
        assert {k: got[d][k] for k in base} == base
        assert got[d].base_failed == (base["n_words"] < 10 or 100 * base["n_repeat_words"] > 20 * base["n_words"]) and not (got[d].base_failed and got[d].kept)
