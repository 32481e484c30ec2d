"""Extra columns whose names the operators use themselves, over the edge cases and over no rows."""

import pytest
from pyspark.sql import functions as F

import public_tokenizers
from weftlink.llm import bpe, chat, decontaminate, lines, pii, quality, secrets, sharding, simhash, suffixes
from weftlink.llm.queries import RANKS

from test_operators import EDGE, docs

CLASHING = "id fp component rep node a b c e g h i j k l m n o r u v f own other pieces piece size crc shard slot kind bytes doc head spans kept base found runs stop tail front word_distance hit_spans items n_words n_lines removed_lines n_card n_date formatted turns conv branch up to start end".split()


def crowded(frame):
    return frame.withColumns({c: F.lit("x") for c in CLASHING if c not in frame.columns})


def told(frame):
    return sorted(map(str, (r.asDict(recursive=True) for r in frame.collect())))


PATH = public_tokenizers.path(RANKS)
OPERATORS = {
    "simhash": lambda d, x: simhash.near_duplicates(d),
    "keep_one": lambda d, x: simhash.keep_one(d.filter("doc_id is not null")).select("doc_id", "text"),
    "decontaminate": lambda d, x: decontaminate.hits(d, x).select("doc_id", "text", "n_words", "hit_spans", "items"),
    "pii": lambda d, x: pii.pseudonymize(d, "k").select("doc_id", "text", *(f"n_{k}" for k in pii.KINDS)),
    "bpe": lambda d, x: bpe.round_trip(d, PATH, public_tokenizers.PATTERN),
    "decode": lambda d, x: bpe.decode(bpe.encode(d, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN),
    "secrets": lambda d, x: secrets.secrets(d),
    "quality": lambda d, x: quality.quality(d),
    "filter_quality": lambda d, x: quality.filter_quality(d).select("doc_id", "text"),
    "lines": lambda d, x: lines.dedup_lines(d).select("doc_id", "text", "n_lines", "removed_lines"),
    "suffixes": lambda d, x: suffixes.remove_repeats(d),
    "sharding": lambda d, x: sharding.shard(d, 7),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns(spark, name):
    run, plain = OPERATORS[name], docs(spark, EDGE)
    items = spark.createDataFrame([(1, "the cat sat on the mat and saw the dog run by it"), (None, "one"), (2, None)], "item_id long, text string")
    got = told(run(crowded(plain), crowded(items)))
    assert got == told(run(plain, items))
    assert got or name == "keep_one"
    assert told(run(crowded(plain.limit(0)), crowded(items))) == []


def test_decontamination_edges(spark):
    items = spark.createDataFrame([(1, "the cat sat on the mat and saw the dog run by it"), (None, "one"), (2, None)], "item_id long, text string")
    got = sorted(((r.doc_id or 0, r.n_words, r.hit_spans, r.items) for r in decontaminate.hits(docs(spark, EDGE), items).collect()), key=str)
    whole = (13, [[0, 13]], ["1"])
    assert got == sorted([(1, 0, [], []), (2, 0, [], []), (3, 0, [], []), (4, 1, [[0, 1]], []), (5, 40_000, [], []), (6, *whole), (6, *whole), (0, *whole), (7, 0, [], [])], key=str)


def test_chat_clashing_columns(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", None), (1, 1, "assistant", None), (None, None, None, "z")], "conv_id long, turn long, role string, text string")
    assert told(chat.format_trees(chat.linear(crowded(turns)))) == told(chat.format_trees(chat.linear(turns)))
    assert told(chat.format_trees(crowded(chat.linear(turns)))) == told(chat.format_trees(chat.linear(turns)))
