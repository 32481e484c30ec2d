"""Canonical forms of names and addresses, as column expressions; no Python runs on the rows."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import dicts

SPACE = r"[\s\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


@cache
def transliteration() -> dict[str, str]:
    """ASCII spellings by rule: Latin letters by decomposition, Indic ones by their Unicode names.

    A consonant is written without its vowel, long vowels and retroflex consonants are doubled.
    """
    out = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "°": "deg", "№": "No", "’": "'", "‘": "'", "–": "-", "—": "--", " ": " "}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        plain = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if plain:
            out.setdefault(chr(code), plain)
    for code in range(0x900, 0xD80):
        script, _, name = unicodedata.name(chr(code), "").partition(" ")
        kind, _, what = name.rpartition(" ")
        if kind == "LETTER":
            out[chr(code)] = what.lower() if what in ("A", "AA", "I", "II", "U", "UU", "E", "EE", "AI", "O", "OO", "AU") else what.lower().removesuffix("a")
        elif kind == "VOWEL SIGN":
            out[chr(code)] = what.lower()
        elif name in ("SIGN ANUSVARA", "SIGN CANDRABINDU"):
            out[chr(code)] = "n"
        elif name == "SIGN VISARGA":
            out[chr(code)] = "h"
        elif kind == "DIGIT":
            out[chr(code)] = str(unicodedata.digit(chr(code)))
    return out


def literal_map(entries: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in entries.items() for x in pair))


def ascii_text(text: Column) -> Column:
    """The text in ASCII; characters without a spelling go. One-to-one spellings are a single translate()."""
    table = transliteration()
    single = {k: v for k, v in table.items() if len(v) == 1}
    first = F.translate(text, "".join(single), "".join(single.values()))
    several = literal_map({k: v for k, v in table.items() if len(v) > 1})
    spelt = F.array_join(F.transform(F.split(first, ""), lambda c: F.when(c.rlike(r"[\x00-\x7F]"), c).otherwise(F.coalesce(F.try_element_at(several, c), F.lit("")))), "")
    return F.when(first.rlike(r"[^\x00-\x7F]"), spelt).otherwise(first)


def clean_base(value: Column) -> Column:
    """The text without white space around it; empty where it only says that there is none."""
    text = F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), rf"^{SPACE}+|{SPACE}+$", "")
    return F.when(F.lower(text).isin(dicts.NULL_LIKE), "").otherwise(text)


def squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, rf"{SPACE}+", " "))


def collapsed_acronyms(text: Column) -> Column:
    return F.regexp_replace(text, r"(?<=\b[a-zA-Z])\.(?=\s|[a-zA-Z]|$|[,;:])", "")


def tokens(text: Column) -> Column:
    """The words between spaces, repeats included."""
    return F.filter(F.split(text, rf"{SPACE}+"), lambda w: w != "")


def expanded(words: Column, *maps: Column) -> Column:
    """Words replaced by the first map that knows them."""
    return F.transform(words, lambda w: F.coalesce(*(F.try_element_at(m, w) for m in maps), w))


def without_urls(text: Column) -> Column:
    text = F.regexp_replace(text, r"https?://\S+|www\.\S+", "")
    return F.regexp_replace(text, r"(?i)\b([a-z0-9_-]+)\.(?:com|in|org|net|co|io|gov|edu|fr)\b", "$1")


def without_legal_forms(text: Column) -> Column:
    """Legal forms dropped from the end and then from the start, never the last words."""
    forms = "|".join(dicts.LEGAL_FORMS)
    text = F.regexp_replace(text, rf"(?<=\S)(?: (?:{forms}))+$", "")
    return F.regexp_replace(text, rf"^(?:(?:{forms}) )+(?=\S)", "")


def trade_name(text: Column, strict: bool = False) -> Column:
    """What follows "d.b.a." and the like. Words that only begin so count too unless ``strict``."""
    bound = r"(?![A-Za-z])" if strict else ""
    pattern = r"(?i)\b(?:d[./]?b[./]?a\.?|t[./]?a\.?|f[./]?k[./]?a\.?|a[./]?k[./]?a\.?|trading as|doing business as)" + bound + r"\s*(.+)"
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1)).otherwise(text)


def ordinals_and_zeros(text: Column) -> Column:
    text = F.regexp_replace(text, r"(?i)\b(\d+)(?:st|nd|rd|th)\b", "$1")
    return F.regexp_replace(F.regexp_replace(text, r"[^a-z0-9\s]", " "), r"\b0+(\d+)\b", "$1")


def normalized_name(value: Column, strict_dba: bool = False) -> Column:
    text = trade_name(without_urls(clean_base(value)), strict_dba)
    for pattern in dicts.INDIC_LEGAL:
        text = F.regexp_replace(text, pattern, " ")
    text = F.lower(collapsed_acronyms(ascii_text(text)))
    for mark, word in (("&", " and "), ("+", " and "), ("@", " at ")):
        text = F.replace(text, F.lit(mark), F.lit(word))
    text = F.regexp_replace(text, r"[^a-z0-9\s]", " ")
    text = F.regexp_replace(text, r"([a-z])\1{2,}", "$1")
    for pattern, word in dicts.PHONETIC:
        text = F.regexp_replace(text, pattern, word)
    text = squeezed(F.regexp_replace(text, r"\b\d{7,12}\b", ""))
    return F.array_join(expanded(tokens(without_legal_forms(text)), literal_map(dicts.NAME_WORDS)), " ")


def normalized_address(value: Column, country: Column | None = None) -> Column:
    text = clean_base(value)
    for name, english in dicts.INDIC_STATES.items():
        text = F.replace(text, F.lit(name), F.lit(f" {english} "))
    text = F.lower(collapsed_acronyms(ascii_text(text)))
    for old, new in dicts.ADDRESS_LITERALS:
        text = F.replace(text, F.lit(old), F.lit(new))
    words = tokens(ordinals_and_zeros(F.regexp_replace(text, r"\b(?:null|none|nan)\b", " ")))
    first = literal_map(dicts.ADDRESS_WORDS)
    of = lambda states: F.array_join(expanded(words, first, literal_map(states)), " ")
    if country is None:
        return of(dicts.ALL_STATES)
    return F.when(country == "US", of(dicts.US_STATES)).when(country == "India", of(dicts.INDIA_STATES)).otherwise(of(dicts.ALL_STATES))


def normalize(df: DataFrame, name_col: str = "business_name", address_col: str = "business_address", country_col: str | None = "country", norm_name_col: str = "norm_name", norm_address_col: str = "norm_address", strict_dba: bool = False) -> DataFrame:
    """``df`` with both canonical columns; a frame that has them already is returned as it is."""
    if {norm_name_col, norm_address_col} <= set(df.columns):
        return df
    if missing := {name_col, address_col} - set(df.columns):
        raise ValueError(f"columns are missing: {sorted(missing)}")
    country = F.col(country_col) if country_col and country_col in df.columns else None
    return df.withColumns({norm_name_col: normalized_name(F.col(name_col), strict_dba), norm_address_col: normalized_address(F.col(address_col), country)})
