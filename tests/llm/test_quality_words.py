"""The common-word half of the quality rules, on documents with ordinary letters."""

import random

from weftlink.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_wrong_language_and_no_common_words_go(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(4, 9)))

    def prose(lang, n, share=0.3):
        return " ".join(rng.choice(quality.COMMON[lang][:25]) if rng.random() < share else word() for _ in range(n))

    langs = ["en", "fr", "de", "es"]
    clean = [(len(langs) * i + j, prose(lang, rng.choice([60, 90, 300])), lang, "s", None) for i in range(40) for j, lang in enumerate(langs)]
    bad = [(1000 + i, prose(langs[i % 4], 300, 0), langs[i % 4], "s", None) for i in range(4)] + [(2000 + i, prose(langs[i], 300), langs[i - 1], "s", None) for i in range(4)]
    rows = spark.createDataFrame(clean + bad, SCHEMA)
    kept = {r.id for r in quality.quality(rows).collect() if r.kept}
    assert kept == {r[0] for r in clean} == {r.doc_id for r in quality.filter_quality(rows).collect()}
