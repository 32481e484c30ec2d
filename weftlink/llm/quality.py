"""Quality rules: base counts, and divergence from language references.

A document's histogram of character classes and of common words is compared with the
references of its language by Jensen-Shannon distance (base 2, so 0 to 1). References are given, or
made as sums over all trusted documents of a language (such as those labelled good), in one pass whose
partial sums are added up before the shuffle; a language without a trusted document takes all its
documents, languages outside COMMON share one reference. A document is rejected if the nearest
reference is further than ``max_classes`` or ``max_words``; each test holds only from a minimum
length on, since histograms of short texts say little.

Defined results: a null text has no words and fails the base rules, as an empty one does; a null or
unknown language belongs to the shared reference and is compared with every one; without any reference
nothing is far. Repeated rows have repeated results, texts of any length are taken whole, an empty table
has no rows. Rows are independent once the references are made; other columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Frequent function words of four languages.
COMMON = {
    "en": "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which you were her all she there would their we him been has when who will no more if out so what".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont la mais comme ou si leur y dont elle deux ces avec son cette aux on ont ses".split(),
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem einen so zum war haben nur oder aber vor zur bis mehr durch man".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos fue era muy hasta desde mi porque".split(),
}
WORDS = {w.encode(): i for i, w in enumerate(sorted({w for own in COMMON.values() for w in own}))}
CLASSES = ["lower", "upper", "other letters", "digits", "space", "sentence marks", "symbols", "controls"]
SYMBOLS = "#*$%&|<>"


SENTENCE = ".,;:!?'\"()-…’‘“”«»¿¡–—、。"


def _class(c: str) -> int:
    kind = unicodedata.category(c)
    if c in SENTENCE:
        return 5
    if c.isspace():
        return 4
    return {"Ll": 0, "Lu": 1, "Lt": 1}.get(kind, {"L": 2, "M": 2, "N": 3, "Z": 4, "P": 6, "S": 6}.get(kind[0], 7))


@cache
def _table(size: int) -> np.ndarray:
    """The class of each character by its number."""
    return np.array([_class(chr(c)) for c in range(size)], dtype=np.uint8)


def class_counts(text: str) -> np.ndarray:
    if text.isascii():
        return np.bincount(_table(128)[np.frombuffer(text.encode(), dtype=np.uint8)], minlength=N_CLASSES)
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return np.bincount(_table(1 << 16 if codes.max() < 1 << 16 else 0x110000)[codes], minlength=N_CLASSES)


#: A-Z in lower case; ASCII marks and symbols as spaces, so that "the," counts as "the".
PLAIN = bytes(b + 32 if 65 <= b <= 90 else 32 if b < 128 and not chr(b).isalnum() else b for b in range(256))
N_CLASSES, N_WORDS = len(CLASSES), len(WORDS)
#: The limit on common words for the shared reference.
SHARED = 0.6


def histograms(text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """(characters by class, common words, words) of a text."""
    classes = class_counts(text)
    words = text.encode().translate(PLAIN).split()
    common = np.zeros(N_WORDS, dtype=np.int64)
    if words:
        count = Counter(words)
        for w in count.keys() & WORDS.keys():
            common[WORDS[w]] = count[w]
    return classes, common, len(words)


def base_counts(text: str) -> dict[str, int]:
    raw = text.encode()
    words = raw.split()  # bytes: the six ASCII white-space characters
    n = len(words)
    out = {"n_words": n, "word_chars": len(text) - sum(map(text.count, " \t\n\v\f\r")), "n_symbols": sum(map(text.count, SYMBOLS)), "n_dup_lines": 0, "n_repeat_words": 0}
    lines = text.split("\n")
    if len(set(lines)) < len(lines):
        full = [x for x in lines if x.strip(" \t\v\f\r")]
        out["n_dup_lines"] = len(full) - len(set(full))
    if n > 5:
        windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
        if len(set(windows)) < len(windows):
            count, to = Counter(windows), 0
            for i, w in enumerate(windows):
                if count[w] > 1:
                    out["n_repeat_words"] += i + 5 - max(i, to)
                    to = i + 5
    return out


def failed(n_words: int, n_repeat_words: int, min_words: int = 10, max_repeat: int = 20) -> bool:
    return n_words < min_words or 100 * n_repeat_words > max_repeat * n_words


def distances(histogram: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of a histogram from each row of references; 1 from an empty one."""
    total = references.sum(axis=1, keepdims=True)
    p, q = histogram / max(1, histogram.sum()), references / np.maximum(1, total)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1) + np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1)
    return np.where(total[:, 0] > 0, np.sqrt(np.clip(kl / 2, 0, 1)), 1.0)


def language_references(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang", id_col: str = "doc_id", trusted: DataFrame | None = None, most_trusted: int = 20_000) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """The summed histograms of the documents whose ids ``trusted`` (id) holds, for each language of COMMON and "" for the others.

    Of more than ``most_trusted`` ids those with the smallest hashes are taken: a reference is fitted on so many
    labelled documents at most. A language without a trusted document takes all its documents, as each does
    without ``trusted``. At most ten sums and ``most_trusted`` ids reach the driver.
    """
    lang = F.when(F.col(lang_col).isin(*COMMON), F.col(lang_col)).otherwise("") if lang_col else F.lit("")
    own = docs.select(lang.alias("lang"), F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("id"))
    chosen_ids = None
    if trusted is not None:
        ids = trusted.select(F.col(trusted.columns[0]).cast("long").alias("id")).filter("id is not null").distinct()
        chosen_ids = frozenset(r[0] for r in ids.orderBy(F.xxhash64("id"), "id").limit(most_trusted).collect())

    def run(batches):
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for lang, text, id_ in zip(*(c.to_pylist() for c in batch.columns)):
                if text:
                    good = chosen_ids is None or id_ in chosen_ids
                    c, w, n = histograms(text)
                    total = sums.setdefault((lang, good), np.zeros(N_CLASSES + N_WORDS + 1, dtype=np.int64))
                    total[:N_CLASSES] += c
                    total[N_CLASSES:-1] += w
                    total[-1] += n
        for (lang, good), total in sums.items():
            n = len(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * n), pa.array([good] * n), pa.array(range(n), pa.int32()), pa.array(total)], names=["lang", "good", "i", "n"])

    rows = own.mapInArrow(run, "lang string, good boolean, i int, n long").groupBy("lang", "good", "i").agg(F.sum("n").alias("n")).collect()
    out: dict[str, dict[bool, np.ndarray]] = {}
    for lang, good, i, n in rows:
        out.setdefault(lang, {}).setdefault(good, np.zeros(N_CLASSES + N_WORDS + 1, dtype=np.int64))[i] = n
    chosen = {k: v.get(True, v.get(False)) for k, v in sorted(out.items())}
    return {k: (v[:N_CLASSES], _with_rest(v[N_CLASSES:-1], v[-1])) for k, v in chosen.items()}


def _with_rest(common: np.ndarray, words: int) -> np.ndarray:
    return np.append(common, words - common.sum())


class Judge:
    """Verdicts against references."""

    def __init__(self, references: dict, max_classes: float, max_words: float | None, min_chars: int, min_words: int):
        self.langs = list(references)
        self.classes = np.array([references[k][0] for k in self.langs], dtype=float).reshape(-1, N_CLASSES)
        self.words = np.array([references[k][1] for k in self.langs], dtype=float).reshape(-1, N_WORDS + 1)
        self.max_classes, self.min_chars, self.min_words = max_classes, min_chars, min_words
        self.limits = np.array([self._limit(i) if max_words is None else max_words for i in range(len(self.langs))])
        self.least = np.array([self._least(i) if max_words is None and lang else min_words for i, lang in enumerate(self.langs)])

    def _limit(self, i: int) -> float:
        """Below the distance of a text without common words and of every other language."""
        if not self.langs[i]:
            return SHARED
        none = _with_rest(np.zeros(N_WORDS), 1)
        others = [x for j, x in enumerate(self.words) if j != i and self.langs[j] and x.sum()]
        return 0.95 * float(distances(self.words[i], np.array([none, *others])).min())

    def _least(self, i: int, most: int = 2000) -> float:
        """The length from which texts drawn from the reference are within its limit; infinite if there is none."""
        p, rng = self.words[i] / max(1, self.words[i].sum()), np.random.default_rng(i)
        for n in range(self.min_words, most, 5) if p.sum() else ():
            if np.quantile(distances(self.words[i], rng.multinomial(n, p, size=1000).astype(float)), 0.999) < self.limits[i]:
                return n
        return np.inf

    def judged(self, text: str, lang: str | None) -> tuple[float, float, bool]:
        """Distances from the language's own reference, or the nearest if it has none, and whether the text is kept; a text under the minimum length is 0 away."""
        classes, common, n = histograms(text)
        own = [self.langs.index(lang)] if lang in self.langs and lang else list(range(len(self.langs)))
        c = float(distances(classes.astype(float), self.classes[own]).min()) if own and classes.sum() >= self.min_chars else 0.0
        far = np.where(n >= self.least[own], distances(_with_rest(common, n).astype(float), self.words[own]), 0.0) if own else np.zeros(1)
        near = not own or bool((far <= self.limits[own]).any())
        return c, float(far.min()), c <= self.max_classes and near


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang", max_classes: float = 0.3, max_words: float | None = None, min_chars: int = 200, min_words: int = 50, references: dict | None = None, trusted: DataFrame | None = None) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance, word_distance, kept)."""
    references = language_references(docs, text_col, lang_col, id_col, trusted) if references is None else references
    judge = Judge(references, max_classes, max_words, min_chars, min_words)
    lang = F.col(lang_col) if lang_col else F.lit(None).cast("string")
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, lang in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                base = base_counts(text or "")
                bad = failed(base["n_words"], base["n_repeat_words"])
                c, w, kept = judge.judged(text or "", lang)
                rows.append((*base.values(), bad, c, w, not bad and kept))
            columns = list(zip(*rows)) or [()] * 9
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, k) for x, k in zip(columns, kinds))], names=["id", *longs, "base_failed", "class_distance", "word_distance", "kept"])

    schema = "id long, " + ", ".join(f"{x} long" for x in longs) + ", base_failed boolean, class_distance double, word_distance double, kept boolean"
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), lang.alias("lang")).mapInArrow(run, schema)


def filter_quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_classes: float = 0.3, max_words: float | None = None, min_chars: int = 200, min_words: int = 50, id_col: str = "doc_id", references: dict | None = None, trusted: DataFrame | None = None) -> DataFrame:
    """The rows that are kept, with all their columns, in one more pass and without a shuffle."""
    references = language_references(docs, text_col, lang_col, id_col, trusted) if references is None else references
    judge = Judge(references, max_classes, max_words, min_chars, min_words)
    at, lang_at = docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches):
        for batch in batches:
            keep = []
            for text, lang in zip(batch.column(at).to_pylist(), batch.column(lang_at).to_pylist()):
                base = base_counts(text or "")
                keep.append(not failed(base["n_words"], base["n_repeat_words"]) and judge.judged(text or "", lang)[2])
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
