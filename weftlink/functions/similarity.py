"""The fourteen similarity features of a pair of records, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .normalize import tokens

FEATURES = [
    "name_levenshtein", "name_jaccard", "name_tfidf_cosine", "addr_levenshtein", "addr_jaccard", "addr_tfidf_cosine", "common_name_tokens",
    "common_addr_tokens", "name_len_diff", "addr_len_diff", "exact_name_match", "exact_addr_match", "name_token_ratio", "addr_token_ratio",
]


def _bound(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.transform(F.array(value), use)[0]


def grams(text: Column, n: int = 3) -> Column:
    """All substrings of n characters; the text itself if it is shorter, none if it is empty."""
    many = lambda c: F.transform(F.sequence(F.lit(0), F.size(c) - n), lambda i: F.concat(*(c[i + k] for k in range(n))))
    short = F.when(text == "", F.expr("cast(array() as array<string>)")).otherwise(F.array(text))
    return F.when(F.length(text) < n, short).otherwise(_bound(F.split(text, ""), many))


def bag(text: Column) -> Column:
    """The grams and their counts as a map: one sort, then the lengths of the runs of equal grams."""

    def runs(g):
        first = F.filter(F.sequence(F.lit(0), F.size(g) - 1), lambda i: (i == 0) | (g[i] != g[F.greatest(i - 1, F.lit(0))]))
        ends = lambda f: F.concat(F.slice(f, 2, F.size(f)), F.array(F.size(g)))
        return _bound(first, lambda f: F.map_from_arrays(F.transform(f, lambda i: g[i]), F.zip_with(f, ends(f), lambda a, b: (b - a).cast("double"))))

    return F.when(text == "", F.expr("cast(map() as map<string,double>)")).otherwise(_bound(F.array_sort(grams(text)), runs))


def profile(df: DataFrame, prefix: str, name: str = "norm_name", address: str = "norm_address") -> DataFrame:
    """``df`` with what the features need of a record, computed once for all its pairs."""
    new, norms = {}, {}
    for field, column in (("name", name), ("addr", address)):
        text = F.coalesce(F.col(column), F.lit(""))
        new |= {f"{prefix}_{field}": text, f"{prefix}_{field}_tokens": F.array_distinct(tokens(text)), f"{prefix}_{field}_grams": bag(text)}
        norms[f"{prefix}_{field}_norm"] = F.sqrt(F.aggregate(F.map_values(f"{prefix}_{field}_grams"), F.lit(0.0), lambda a, x: a + x * x))
    new[f"{prefix}_numbers"] = F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(address), F.lit("")), F.lit(r"\b\d+\b"), F.lit(0)))
    return df.withColumns(new).withColumns(norms)


def _both(field: str, a: str, b: str) -> dict[str, Column]:
    x, y = F.col(f"{a}_{field}"), F.col(f"{b}_{field}")
    tx, ty = F.col(f"{a}_{field}_tokens"), F.col(f"{b}_{field}_tokens")
    gx, gy = F.col(f"{a}_{field}_grams"), F.col(f"{b}_{field}_grams")
    common = F.size(F.array_intersect(tx, ty)).cast("double")
    total = (F.size(tx) + F.size(ty)).cast("double")
    norm = F.col(f"{a}_{field}_norm") * F.col(f"{b}_{field}_norm")
    dot = F.aggregate(F.map_entries(gx), F.lit(0.0), lambda s, e: s + e["value"] * F.coalesce(F.try_element_at(gy, e["key"]), F.lit(0.0)))
    return {
        f"{field}_levenshtein": 1 - F.when(x == y, 0).otherwise(F.levenshtein(x, y)) / F.greatest(F.length(x), F.length(y), F.lit(1)),
        f"{field}_jaccard": F.when(total > 0, common / (total - common)).otherwise(0.0),
        f"{field}_tfidf_cosine": F.when(norm > 0, dot / norm).otherwise(0.0),
        f"common_{field}_tokens": common,
        f"{field}_len_diff": F.abs(F.length(x) - F.length(y)).cast("double"),
        f"exact_{field}_match": ((x != "") & (x == y)).cast("double"),
        f"{field}_token_ratio": F.when(total > 0, 2 * common / total).otherwise(0.0),
    }


def pair_features(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``pairs`` of profiled records with the fourteen features."""
    both = _both("name", a, b) | _both("addr", a, b)
    return pairs.withColumns({name: both[name] for name in FEATURES})
