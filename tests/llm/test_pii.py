"""Pseudonyms: validity, format, links between formats, and that the permutations are one to one."""

import datetime
import random
import re

from pyspark.sql import functions as F

from weftlink.llm import pii

from test_operators import EDGE, LONG, docs


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10


def mod97(text):
    d = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in d[4:] + d[:4])) % 97


def shape(text):
    return re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", text)))


def changed(spark, texts, key="k"):
    return [r.text for r in sorted(pii.pseudonymize(docs(spark, list(enumerate(texts))), key).collect(), key=lambda r: r.doc_id)]


def test_values_of_each_kind(spark):
    text = "a@b.example|4111111111111111|4111-1111-1111-1111|4111111111111112|2020-02-29|29/02/2020|2021-02-30|123-45-6789|000-12-3456|+1 (017) 555-7713|10.0.0.1|300.1.1.1|DE89 3704 0044 0532 0130 00|DE89370400440532013000|DE88370400440532013000"
    rows = pii.pseudonymize(docs(spark, [(1, text), (2, "x 4111111111111111 y"), (3, None), (4, ""), (5, "nothing here"), (6, LONG)]), "k").orderBy("doc_id").collect()
    old, new = text.split("|"), rows[0].text.split("|")
    assert [x for x, y in zip(new, old) if x == y] == ["4111111111111112", "2021-02-30", "000-12-3456", "300.1.1.1", "DE88370400440532013000"]
    assert all(shape(x.removesuffix(".example") if "@" in x else x) == shape(y) for x, y in zip(new, old) if y != "10.0.0.1")
    assert luhn(new[1]) == 0 and new[2].replace("-", "") == new[1] and rows[1].text == f"x {new[1]} y"
    assert new[5] == "/".join(reversed(new[4].split("-"))) and datetime.date.fromisoformat(new[4]).day >= 29
    assert new[9].startswith("+1 (") and mod97(new[12]) == 1 and new[12].replace(" ", "") == new[13]
    assert [r.text for r in rows[2:5]] == [None, "", "nothing here"] and rows[5].text == LONG
    assert [rows[0][f"n_{k}"] for k in pii.KINDS] == [1, 2, 1, 2, 1, 1, 2]


def test_what_is_not_valid_stays(spark):
    texts = ["order 123 456 7890", "version 1.2.3.4", "v1.2.3.4", "4111 1111 1111 1112", "31/04/2020", "1/2/1799", "GB00 1234", "12345678901234567890", "3.14159265358979"]
    assert changed(spark, texts) == texts


def test_shorter_ends_and_neighbours(spark):
    texts = ["4111111111111111 123", "4111 1111 1111 1111 12/26", "4111 1111 1111 1111 123", "555 123 4567 555 123 9999", "4111 11111111 1111", "378282246310005", "3782 822463 10005", "12 555 123 4567"]
    got = changed(spark, texts)
    assert got[0].endswith(" 123") and got[1].endswith(" 12/26") and got[2].endswith(" 123") and got[7].startswith("12 ")
    assert len({re.sub(" ", "", x)[:16] for x in (got[0], got[1], got[2], got[4])}) == 1 and luhn(got[0][:16]) == 0
    assert got[6].replace(" ", "") == got[5] != texts[5] and luhn(got[5]) == 0
    assert got[3][:12] != texts[3][:12] and got[3][13:] != texts[3][13:] and got[7][3:] == got[3][:12]
    assert [shape(x) for x in got] == [shape(x) for x in texts]


def test_styles_of_dates(spark):
    days = [datetime.date(2020, 1, 2), datetime.date(1999, 12, 31), datetime.date(2004, 2, 29), datetime.date(2021, 7, 4), datetime.date(2010, 10, 20)]
    texts = [f"{d:%Y-%m-%d}|{d:%d.%m.%Y}|{d:%d/%m/%Y}|{d.day}/{d.month}/{d.year}" + (f"|{d:%m/%d/%Y}" if d.day > 12 else "") for d in days]
    for d, text in zip(days, changed(spark, texts)):
        iso, dots, slashes, short, *us = text.split("|")
        new = datetime.date.fromisoformat(iso)
        assert new != d and dots == f"{new:%d.%m.%Y}" and slashes == f"{new:%d/%m/%Y}" and us in ([], [f"{new:%m/%d/%Y}"])
        assert short == (slashes if d.day > 9 and d.month > 9 else f"{new.day}/{new.month}/{new.year}")


def test_permutations_are_one_to_one(spark):
    s = pii.feistel(F.floor(F.col("id") / 7), F.col("id") % 7, 9, 7, F.lit("k"), "t")
    assert sorted(r[0] for r in spark.range(63).select(s["l"] * 7 + s["r"]).collect()) == list(range(63))
    first = datetime.date(1800, 1, 1)
    days = [f"{first + datetime.timedelta(n):%Y-%m-%d}" for n in range(146_097)]
    some = [x for x in days if x[8:] > "28"] + [x for x in days[:40_000] if x[8:] <= "28"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in some], "m string").repartition(8).select(pii._date(F.col("m"), F.lit("k"))).collect()]
    assert len(set(got)) == len(some) and {x for x in got if x[8:] > "28"} == {x for x in days if x[8:] > "28"}
    rng = random.Random(2)
    mails = [f"{a}{b}.{c}@m{b}.org" for a in "abcde" for b in range(10) for c in "xyz"]
    phones = [f"+1 ({rng.randrange(1000):03}) 555-{n:04}" for n in range(300)]
    for values in (mails, phones):
        new = changed(spark, values)
        assert len(set(new)) == len(values) and not set(new) & set(values)


def test_key_as_a_column(spark):
    keys = spark.createDataFrame([("a secret key",)], "key string")
    frame = docs(spark, [(1, "call +1 (017) 555-7713, please")])
    one, same, other = pii.pseudonymize(frame, keys.select("key").scalar()), pii.pseudonymize(frame, "a secret key"), pii.pseudonymize(frame, "another key")
    assert one.first().text == same.first().text != other.first().text


def test_no_python_in_the_plan(spark):
    plan = pii.pseudonymize(docs(spark, EDGE), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapPartitions" not in plan
    assert len(pii.pseudonymize(docs(spark, EDGE), "k").collect()) == len(EDGE) and pii.pseudonymize(docs(spark, []), "k").collect() == []
