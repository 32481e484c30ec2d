"""The features of pairs of texts, each distinct pair once: edit distances by bit vectors of all texts that meet one text, grams and words by counts.

The same values as the column expressions of ``similarity`` have, which serve frames of profiled records.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from math import sqrt

import numpy as np
import pyarrow as pa

NUMBER = re.compile(r"\b\d+\b", re.ASCII)
#: What is told of a pair of texts: seven features of one field, whether numbers are shared, or both have some and share none, and whether the second text is empty.
COLUMNS = "levenshtein double, jaccard double, cosine double, common double, len_diff double, exact double, ratio double, numbers_match boolean, numbers_conflict boolean, b_empty boolean"
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]
#: Words of 64 characters of the texts that are compared with one text together, about.
WORDS = 512


def _distances(texts: list[str], other: str) -> list[int]:
    """From ``other`` to each of ``texts``, none empty: Myers' bit vectors (1999), side by side in one long integer, each with a bit above it that takes its carry."""
    joined = "\0".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    sizes = [len(t) for t in texts]
    starts = [0, *accumulate(n + 1 for n in sizes)][:-1]
    own = np.ones(len(codes), dtype=bool)
    own[[s - 1 for s in starts[1:]]] = False
    number = lambda bits: int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    field = plus = number(own)
    masks = {c: number((codes == ord(c)) & own) for c in set(other)}
    first, every, minus = sum(1 << s for s in starts), (1 << len(codes) + 1) - 1, 0
    for c in other:
        eq = masks[c]
        same = ((((eq & plus) + plus) ^ plus) | eq | minus) & field
        up, down = minus | (field ^ (same | plus)), (same & plus) << 1
        up = up << 1 | first
        plus, minus = (down | (every ^ (same | up))) & field, up & same
    # the last column: its first row is the length of ``other``, and each bit a step up or down from there
    out = []
    for s, n in zip(starts, sizes):
        low = (1 << n) - 1
        out.append(len(other) + (plus >> s & low).bit_count() - (minus >> s & low).bit_count())
    return out


def distances(a: list[str], b: list[str]) -> np.ndarray:
    """The edit distance of each pair. Pairs that share their second text are compared together."""
    out, shared = np.zeros(len(a), dtype=np.int64), {}
    for i, (x, y) in enumerate(zip(a, b)):
        if not x or not y:
            out[i] = len(x) + len(y)
        elif x != y:
            shared.setdefault(y, {}).setdefault(x, []).append(i)
    for y, own in shared.items():
        texts, sizes = list(own), list(accumulate(len(x) for x in own))
        at = 0
        while at < len(texts):
            to = max(at + 1, bisect_right(sizes, 64 * WORDS + (sizes[at - 1] if at else 0)))
            part = texts[at:to]
            # one text alone: the longer one as bits, the shorter one as steps
            found = _distances([y], part[0]) if len(part) == 1 and len(part[0]) < len(y) else _distances(part, y)
            for x, d in zip(part, found):
                out[own[x]] = d
            at = to
    return out


class _Profile:
    def __init__(self, text: str):
        self.words = set(text.split())
        self.grams = Counter(map("".join, zip(text, text[1:], text[2:]))) if len(text) > 2 else Counter([text] if text else [])
        self.kinds, self.repeated = frozenset(self.grams), frozenset(g for g, n in self.grams.items() if n > 1)
        self.norm = sqrt(len(self.kinds) + sum(self.grams[g] ** 2 - 1 for g in self.repeated))
        self.numbers = set(NUMBER.findall(text))


def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (field, x, y, a, b) -> (field, x, y, COLUMNS) of the texts a and b."""
    profiles: dict[str, _Profile] = {}

    def profile(text: str) -> _Profile:
        if (got := profiles.get(text)) is None:
            if len(profiles) >= 1 << 12:
                profiles.clear()
            got = profiles[text] = _Profile(text)
        return got

    for batch in batches:
        a, b = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        d, rows = distances(a, b), []
        for s, t, n in zip(a, b, d.tolist()):
            p, q = profile(s), profile(t)
            common, total = float(len(p.words & q.words)), float(len(p.words) + len(q.words))
            norm = p.norm * q.norm
            both = p.kinds & q.kinds
            dot = len(both) + sum(p.grams[g] * q.grams[g] - 1 for g in both & (p.repeated | q.repeated))
            hit = not p.numbers.isdisjoint(q.numbers)
            rows.append((1 - n / max(len(s), len(t), 1), common / (total - common) if total else 0.0, dot / norm if norm else 0.0, common, float(abs(len(s) - len(t))), float(s != "" and s == t), 2 * common / total if total else 0.0, hit, bool(p.numbers and q.numbers) and not hit, t == ""))
        columns = list(zip(*rows)) or [()] * len(NAMES)
        kinds = [pa.float64()] * 7 + [pa.bool_()] * 3
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["field", "x", "y", *NAMES])
