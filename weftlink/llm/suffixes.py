"""Suffix-array dedup: bytes in a long string that also starts in a document with a smaller id are removed.

A full suffix array of the corpus would be many times its size, so a sparse one is used: of the
``length - head + 1`` suffix heads (``head`` bytes each) that start in a string of ``length``
bytes, the one with the smallest hash is its anchor. Equal strings have equal anchors at equal
offsets, so only suffixes at anchors need be sorted, about one in fourteen.

1. Documents are dealt over packs (a hash of the row decides). A pack is written down, compressed, and
   sends four bytes of the hash of each of its anchors' heads, each once; what comes back is a bit for
   each, set if the head may stand in several documents.
2. For those, the pack sends the suffix and what stands before it, as far as the strings of the
   anchor reach; equal ones once, with their smallest id. Sampled splitters, some for each bucket,
   range-partition them by their leading ``head`` bytes. Each bucket is sorted by a multikey quicksort
   on words of eight bytes; neighbours' common prefixes, and those of what stands before read
   backwards, give the groups of equal strings and the smallest id in each.
3. A splitter never parts suffixes with equal heads, and strings with one anchor share its head, so
   no string crosses a boundary between buckets. A head that holds several of the sampled splitters
   would make a bucket too large: its strings are compared across all buckets instead, dealt by a
   hash of the whole string; a pack sends each one once.
4. The answers go back to the packs, which mark and cut the bytes.

Texts travel to their pack once; what is written down there is read again by the later steps, which
find the same anchors and entries again rather than keep them. Hashes only choose anchors, candidates
and places; strings are held equal by their bytes alone.

Defined results: a null text is no bytes; a row whose id is null loses nothing and takes
nothing from others; rows that share an id don't take from each other; texts shorter than
``length`` stay whole; matches never cross documents; repeated rows have repeated results; an empty
table has no rows; other columns are not read.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import checkpointed, partitions

SLICE = 1 << 19
POSITION = np.uint64((1 << 22) - 1)
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
#: Below so many rows a segment is sorted at once.
SMALL = 1 << 13
#: Sampled heads for each bucket.
SAMPLES = 8
NONE = np.iinfo(np.int64).max


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX[0]
    return h ^ (h >> np.uint64(29))


def _head_hashes(data: np.ndarray, head: int) -> np.ndarray:
    """A hash of the ``head`` bytes from each position: polynomials of 1, 2, 4 ... bytes, put together by the bits of ``head``."""
    size, base, h = 1, MIX[1], data.astype(np.uint64)
    out, width = None, 0
    with np.errstate(over="ignore"):
        while True:
            if head & size:
                if out is None:
                    out, width = h, size
                else:  # the bytes of ``h`` stand before those of ``out``
                    n = len(out) - size
                    out = h[:n] * np.uint64(pow(int(MIX[1]), width, 1 << 64)) + out[size:]
                    width += size
            if 2 * size > head:
                return _mixed(out)
            h = h[: len(h) - size] * base + h[size:]
            base = base * base
            size *= 2


def _sliding(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def anchored(data: np.ndarray, ends: np.ndarray, length: int, head: int) -> tuple[np.ndarray, ...]:
    """Runs of strings that share an anchor: (row, anchor, first start, last start, hash of the head).

    ``data``: the rows' bytes, one after the other; ``ends``: where each row ends.
    """
    found = []
    for x in range(0, max(0, len(data) - length + 1), SLICE):
        part = data[x : x + SLICE + length - 1]
        h = _head_hashes(part, head)
        low = (h & ~POSITION) | np.arange(len(h), dtype=np.uint64)
        best = (_sliding(low, length - head + 1) & POSITION).astype(np.int64)
        start = np.arange(len(best), dtype=np.int64)
        from_, to = np.searchsorted(ends, [x, x + len(best) - 1], side="right")
        edges = np.concatenate([[x], np.minimum(ends[from_ : to + 1], x + len(best))])
        row = np.repeat(np.arange(from_, to + 1), np.diff(edges))
        ok = start + (x + length) <= ends[row]
        start, best, row = start[ok], best[ok], row[ok]
        if not len(start):
            continue
        cut = np.flatnonzero(np.concatenate([[True], (best[1:] != best[:-1]) | (row[1:] != row[:-1])]))
        last = np.concatenate([cut[1:] - 1, [len(start) - 1]])
        found.append((row[cut], best[cut] + x, start[cut] + x, start[last] + x, h[best[cut]]))
    if not found:
        return tuple(np.zeros(0, dtype=t) for t in (np.int64,) * 4 + (np.uint64,))
    return tuple(np.concatenate(c) for c in zip(*found))


def multikey_quicksort(words: np.ndarray) -> np.ndarray:
    """The order of the rows of ``words`` (n, k).

    A segment is parted by a pivot of its current word into the rows below, equal and above; the
    equal ones go on to the next word. Small segments are sorted by their current word at once,
    and only ties go on to the next.
    """
    n, k = words.shape
    order, todo = np.arange(n), [(0, n, 0)]
    while todo:
        start, stop, at = todo.pop()
        if at == k or stop - start < 2:
            continue
        own = order[start:stop]
        word = words[own, at]
        if len(own) > SMALL:
            pivot = np.sort(word[:: len(own) // 64])[32]
            below, above = word < pivot, word > pivot
            equal = ~(below | above)
            i, j = np.count_nonzero(below), np.count_nonzero(equal)
            order[start:stop] = np.concatenate([own[below], own[equal], own[above]])
            todo += [(start, start + i, at), (start + i, start + i + j, at + 1), (start + i + j, stop, at)]
        else:
            order[start:stop] = _ties_on(words, own, at)
    return order


def _ties_on(words: np.ndarray, rows: np.ndarray, at: int) -> np.ndarray:
    """``rows`` sorted by their words from number ``at`` on."""
    group = np.zeros(len(rows), dtype=np.int64)
    tied = np.arange(len(rows))
    for word in range(at, words.shape[1]):
        own = rows[tied]
        by = np.lexsort((words[own, word], group[tied]))
        rows[tied] = own = own[by]
        g, w = group[tied], words[own, word]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (w[1:] != w[:-1])])
        group[tied] = tied[np.flatnonzero(new)][np.cumsum(new) - 1]
        many = ~new | np.concatenate([~new[1:], [False]])
        tied = tied[many]
        if not len(tied):
            break
    return rows


def _words(rows: np.ndarray) -> np.ndarray:
    """Eight bytes each as a number that sorts alike."""
    pad = np.zeros((len(rows), -rows.shape[1] % 8), dtype=np.uint8)
    return np.ascontiguousarray(np.concatenate([rows, pad], axis=1)).view(">u8").astype(np.uint64)


def _sorted(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): the rows' order, and how many leading bytes each has in common with the one before it there."""
    order = multikey_quicksort(_words(rows))
    now = rows[order]
    differ = now[1:] != now[:-1]
    common = np.full(len(rows), rows.shape[1], dtype=np.int64)
    common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    common[:1] = 0
    return order, common


def smallest(context: np.ndarray, low: np.ndarray, high: np.ndarray, doc: np.ndarray, length: int, head: int) -> np.ndarray:
    """(rows, offsets): the smallest id among equal strings, for rows whose strings reach back by the offset (low <= offset <= high)."""
    back = length - head
    order, common = _sorted(context[:, back:])
    left_order, left_common = _sorted(np.ascontiguousarray(context[:, :back][:, ::-1]))
    n = len(order)
    out = np.full((n, back + 1), NONE)
    group, left = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for offset in range(back + 1):
        at = np.flatnonzero((low <= offset) & (offset <= high))
        if not len(at):
            continue
        group[order] = np.cumsum(common < length - offset)
        left[left_order] = np.cumsum(left_common < offset)
        key = group[at] * (n + 1) + left[at]
        by = np.argsort(key)
        key = key[by]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        least = np.minimum.reduceat(doc[at][by], first)
        out[at[by], offset] = np.repeat(least, np.diff(np.append(first, len(by))))
    return out


def _stored(*arrays) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, protocol=5))


def _loaded(blob: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def _heads(hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, sorted and each once; whether several rows have it; for each run the number of its hash)."""
    by = np.argsort(hashes)
    h, r = hashes[by], row[by]
    new = np.concatenate([np.ones(min(1, len(h)), dtype=bool), h[1:] != h[:-1]])
    first = np.flatnonzero(new)
    number = np.empty(len(h), dtype=np.int32)
    number[by] = np.cumsum(new) - 1
    several = np.minimum.reduceat(r, first) != np.maximum.reduceat(r, first) if len(first) else np.zeros(0, bool)
    return h[first], several, number


def _entries(data: np.ndarray, anchor: np.ndarray, first: np.ndarray, last: np.ndarray, length: int, head: int) -> tuple[np.ndarray, np.ndarray]:
    """(entries, each once; the entry of each run): the bytes that the strings of a run reach, the others being 0, and how far its starts lie before the anchor."""
    back = length - head
    n, width = len(anchor), back + length
    padded = np.concatenate([np.zeros(back, np.uint8), data, np.zeros(length, np.uint8)])
    both = np.zeros((n, width + 2 + -(width + 2) % 8), dtype=np.uint8)
    both[:, :width] = np.lib.stride_tricks.sliding_window_view(padded, width)[anchor]
    column = np.arange(width, dtype=np.uint8)
    both[:, :width] *= column >= (first - anchor + back).astype(np.uint8)[:, None]
    both[:, :width] *= column < (last - anchor + width).astype(np.uint8)[:, None]
    both[:, width], both[:, width + 1] = anchor - last, anchor - first
    words, h = both.view(np.uint64), np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(words.shape[1]):
            h = _mixed(h * MIX[1] + words[:, k])
    _, one, entry = np.unique(h, return_index=True, return_inverse=True)
    if not np.array_equal(words[one][entry], words):  # two with one hash
        _, one, entry = np.unique(words, axis=0, return_index=True, return_inverse=True)
    return both[one, : width + 2], entry.reshape(-1)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _by_kind(batches) -> dict[int, list[dict]]:
    """Rows (j, kind, b, x) of one task by kind."""
    out: dict[int, list[dict]] = {}
    for batch in batches:
        for r in batch.to_pylist():
            out.setdefault(r["kind"], []).append(r)
    return out


ROW = "j long, kind int, b long, x binary"
#: Kinds of rows: a pack's texts and ids; its heads for a bucket and their flags; its suffixes for a bucket and the answers; its strings of hot heads for a bucket and their flags.
TEXTS, HEADS, FLAGS, SUFFIXES, ANSWERS, STRINGS, LATE = range(7)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    """Rows (j, kind, b, x)."""
    columns = list(zip(*rows)) or [()] * 4
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], names=["j", "kind", "b", "x"])


def _taken(batches) -> dict[int, list[dict]]:
    """The rows of a task by kind."""
    out: dict[int, list[dict]] = {}
    for batch in batches:
        for r in batch.to_pylist():
            out.setdefault(r["kind"], []).append(r)
    return out


def _dealt(frame: DataFrame, parts: int, by: str) -> DataFrame:
    """Each value of ``by``, from 0 to parts - 1, is a task of its own."""
    return frame.repartitionById(parts, F.col(by).cast("int"))


def _parts(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, edges): the values of a sorted array, each once, and where each one's part begins, with the array's end."""
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(of)), dtype=bool), of[1:] != of[:-1]]))
    return of[first], np.append(first, len(of))


def _runs(data: np.ndarray, ends: np.ndarray, null: np.ndarray, length: int, head: int, buckets: int) -> tuple[np.ndarray, ...]:
    """The runs of a pack (row, anchor, first, last), then its heads: hashes, whether several rows have each, each run's number, the buckets and where their parts begin."""
    runs = anchored(data, ends, length, head)
    keep = ~null[runs[0]]
    row, anchor, first, last, hashes = (x[keep] for x in runs)
    heads, several, number = _heads(hashes, row)
    return row, anchor, first, last, heads, several, number, *_parts(_bucket(heads, buckets))


def _pack_rows(j: int, ids: pa.Array, text: pa.Array, length: int, head: int, buckets: int) -> list[tuple]:
    """A pack written down: its texts and ids, and its heads for each bucket."""
    edges = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", dtype=np.uint8)[edges[0] : edges[-1]]
    ends = edges[1:] - edges[0]
    null = ids.is_null().to_numpy(zero_copy_only=False).astype(bool)
    *_, heads, several, _, full, cuts = _runs(data, ends, null, length, head, buckets)
    short = heads.astype("<u4")
    out = [(j, TEXTS, None, _stored(data, ends, ids.fill_null(0).to_numpy(), null))]
    return out + [(j, HEADS, b, short[x:y].tobytes() + np.packbits(several[x:y]).tobytes()) for b, x, y in zip(full.tolist(), cuts.tolist(), cuts[1:].tolist())]


def _shared_heads(rows: list[dict]) -> list[tuple]:
    """Of a bucket's heads the flags: whether several packs have them, or several rows of one."""
    sizes = [len(r["x"]) * 8 // 33 for r in rows]  # 33 bits for each head
    heads = np.concatenate([np.frombuffer(r["x"], dtype="<u4", count=n) for r, n in zip(rows, sizes)])
    several = np.concatenate([np.unpackbits(np.frombuffer(r["x"], dtype=np.uint8, offset=4 * n), count=n) for r, n in zip(rows, sizes)]).astype(bool)
    by = np.argsort(heads)
    _, edges = _parts(heads[by])
    count = np.diff(edges)
    shared = np.empty(len(heads), dtype=bool)
    shared[by] = np.repeat((count > 1) | np.logical_or.reduceat(several[by], edges[:-1]), count)
    return [(r["j"], FLAGS, r["b"], np.packbits(x).tobytes()) for r, x in zip(rows, np.split(shared, np.cumsum(sizes)[:-1]))]


class Chosen:
    """The runs of a pack whose heads are shared, their entries, and the smallest id of each entry; a function of the pack and its flags alone."""

    def __init__(self, kinds: dict[int, list[dict]], length: int, head: int, buckets: int):
        data, ends, doc, null = self.texts = _loaded(kinds[TEXTS][0]["x"])
        *runs, _, _, number, full, cuts = _runs(data, ends, null, length, head, buckets)
        shared = np.zeros(cuts[-1], dtype=bool)
        place = {b: (x, y) for b, x, y in zip(full.tolist(), cuts.tolist(), cuts[1:].tolist())}
        for r in kinds.get(FLAGS, []):
            x, y = place[r["b"]]
            shared[x:y] = np.unpackbits(np.frombuffer(r["x"], dtype=np.uint8), count=y - x)
        keep = shared[number] if len(number) else np.zeros(0, bool)
        self.row, self.anchor, self.first, self.last = (x[keep] for x in runs)
        self.entries, self.entry = _entries(data, self.anchor, self.first, self.last, length, head)
        self.smallest = np.full(len(self.entries), NONE)
        self.doc = doc[self.row]
        np.minimum.at(self.smallest, self.entry, self.doc)
        self.heads = np.ascontiguousarray(self.entries[:, length - head : length]).view(f"S{head}").ravel()


class Strings:
    """The strings of a pack's entries ``hot``: each once, in order of their buckets, with its smallest id; and for each place its entry, offset and string's number."""

    def __init__(self, pack: Chosen, hot: np.ndarray, length: int, head: int, buckets: int):
        entries, back = pack.entries[hot], length - head
        low, high = entries[:, -2].astype(np.int64), entries[:, -1].astype(np.int64)
        n = high - low + 1
        self.entry = np.repeat(hot, n)
        self.offset = np.arange(len(self.entry)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        text = np.lib.stride_tricks.sliding_window_view(entries, length, axis=1)[np.repeat(np.arange(len(hot)), n), back - self.offset]
        order, common = _sorted(text)
        first = common < length
        one, h = text[order[first]], np.zeros(np.count_nonzero(first), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for word in _words(one).T:
                h = _mixed(h * MIX[1] + word)
        bucket = _bucket(h, buckets)
        by = np.argsort(bucket, kind="stable")
        self.text, (self.full, self.edges) = one[by], _parts(bucket[by])
        place = np.empty(len(by), dtype=np.int64)
        place[by] = np.arange(len(by))
        self.number = np.empty(len(self.entry), dtype=np.int64)
        self.number[order] = place[np.cumsum(first) - 1]
        self.least = np.full(len(by), NONE)
        np.minimum.at(self.least, self.number, pack.smallest[self.entry])


def _late_strings(rows: list[dict], length: int) -> list[tuple]:
    """Of a bucket's strings of hot heads the flags: whether another pack has them with a smaller id."""
    sizes = [len(x) // (length + 8) for x in (r["x"] for r in rows)]
    text = np.concatenate([np.frombuffer(r["x"], dtype=np.uint8, count=n * length).reshape(n, length) for r, n in zip(rows, sizes)])
    doc = np.concatenate([np.frombuffer(r["x"], dtype="<i8", offset=n * length) for r, n in zip(rows, sizes)])
    order, common = _sorted(text)
    first = np.flatnonzero(common < length)
    late = np.empty(len(doc), dtype=bool)
    late[order] = np.repeat(np.minimum.reduceat(doc[order], first), np.diff(np.append(first, len(doc)))) < doc[order]
    return [(r["j"], LATE, r["b"], np.packbits(x).tobytes()) for r, x in zip(rows, np.split(late, np.cumsum(sizes)[:-1]))]


def _answers(rows: list[dict], length: int, head: int) -> list[tuple]:
    """Sorts a bucket's suffixes; for each pack the entries and offsets (from, to) at which a smaller id has the string."""
    width, parts = 2 * length - head + 2, []
    for r in rows:
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(r["x"]), dtype=np.uint8)
        n = len(raw) // (width + 16)
        own, doc = raw[n * width :].view(np.int64).reshape(2, n)
        parts.append((raw[: n * width].reshape(n, width), np.full(n, r["j"]), own, doc))
    entries, j, own, doc = (np.concatenate(c) for c in zip(*parts))
    use = smallest(entries[:, :-2], entries[:, -2], entries[:, -1], doc, length, head) < doc[:, None]
    begin, end = use.copy(), use.copy()
    begin[:, 1:] &= ~use[:, :-1]
    end[:, :-1] &= ~use[:, 1:]
    (r, x), (_, y) = np.nonzero(begin), np.nonzero(end)
    by = np.argsort(j[r], kind="stable")
    of, edges = _parts(j[r[by]])
    at, x, y = own[r[by]], x[by].astype(np.uint8), y[by].astype(np.uint8)
    return [(p, ANSWERS, None, _stored(at[s:e], x[s:e], y[s:e])) for p, s, e in zip(of.tolist(), edges.tolist(), edges[1:].tolist())]


def remove_repeats(docs: DataFrame, length: int = 50, head: int = 24, id_col: str = "doc_id", text_col: str = "text", pack_bytes: int = 6 << 20) -> DataFrame:
    """(id, spans, kept): removed byte spans [start, end), maximal and in order, and the bytes that are left.

    ``pack_bytes``: the mean size of a pack, of which a task holds a few times as much; there are as many
    buckets as packs. Splitters come from the suffixes of a sample of packs, in proportion to the buckets;
    the sample bears on the buckets' sizes alone.
    """
    total = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    packs = max(partitions(docs), -(-total // pack_bytes))
    buckets = packs
    c = F.col
    own = docs.select(F.pmod(F.xxhash64(id_col, text_col), F.lit(packs)).alias("j"), c(id_col).cast("long").alias("id"), c(text_col).alias("text"))

    def write_down(batches):
        batches = [b for b in batches if b.num_rows]
        if batches:
            table = pa.Table.from_batches(batches)
            texts = table["text"].cast(pa.large_string()).combine_chunks()
            texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
            texts = texts.fill_null("") if texts.null_count else texts
            ids = pa.array(table["id"].to_pylist(), pa.int64())
            yield _rows(_pack_rows(table["j"][0].as_py(), ids, texts, length, head, buckets))

    def share(batches):
        if rows := _taken(batches).get(HEADS):
            yield _rows(_shared_heads(rows))

    written = checkpointed(_dealt(own, packs, "j").mapInArrow(write_down, ROW))
    flags = checkpointed(_dealt(written.filter(c("kind") == HEADS), buckets, "b").mapInArrow(share, ROW))
    both = written.filter(c("kind") == TEXTS).unionByName(flags)

    some = min(packs, max(8, -(-SAMPLES * buckets // 1000)))
    every = packs // some
    each = -(-SAMPLES * buckets // some)

    def sample(batches):
        kinds = _taken(batches)
        if TEXTS in kinds:
            heads = Chosen(kinds, length, head, buckets).heads
            yield pa.RecordBatch.from_arrays([pa.array(heads[:: max(1, len(heads) // each)][:each].tolist(), pa.binary())], names=["head"])

    sampled = both.filter((c("j") % every == 0) & (c("j") < every * some)).withColumn("s", F.floor(c("j") / every))
    heads = sorted(r[0].ljust(head, b"\0") for r in _dealt(sampled, some, "s").drop("s").mapInArrow(sample, "head binary").collect())
    candidates = np.array(heads[SAMPLES // 2 :: SAMPLES], dtype=f"S{head}")  # as many as buckets, at most
    splitters = np.unique(candidates)[: buckets - 1]
    hot_heads = np.unique(candidates[1:][candidates[1:] == candidates[:-1]])

    def parted(pack: Chosen) -> tuple[np.ndarray, Strings]:
        """The entries with ordinary heads, and the strings of the hot ones."""
        is_hot = np.isin(pack.heads, hot_heads)
        return np.flatnonzero(~is_hot), Strings(pack, np.flatnonzero(is_hot), length, head, buckets)

    def send(batches):
        kinds = _taken(batches)
        if TEXTS not in kinds:
            return
        j, pack = kinds[TEXTS][0]["j"], Chosen(kinds, length, head, buckets)
        cold, hot = parted(pack)
        bounds = list(zip(hot.full.tolist(), hot.edges.tolist(), hot.edges[1:].tolist()))
        yield _rows([(j, STRINGS, b, hot.text[x:y].tobytes() + hot.least[x:y].astype("<i8").tobytes()) for b, x, y in bounds])
        bucket = np.searchsorted(splitters, pack.heads[cold], side="right")
        by = np.argsort(bucket, kind="stable")
        of, edges = _parts(bucket[by])
        squeeze = zstandard.ZstdCompressor(level=1).compress
        parts = [cold[by[x:y]] for x, y in zip(edges.tolist(), edges[1:].tolist())]
        yield _rows([(j, SUFFIXES, b, squeeze(pack.entries[p].tobytes() + p.astype("<i8").tobytes() + pack.smallest[p].tobytes())) for b, p in zip(of.tolist(), parts)])

    def sort_bucket(batches):
        kinds = _taken(batches)
        if SUFFIXES in kinds:
            yield _rows(_answers(kinds[SUFFIXES], length, head))
        if STRINGS in kinds:
            yield _rows(_late_strings(kinds[STRINGS], length))

    found = checkpointed(_dealt(_dealt(both, packs, "j").mapInArrow(send, ROW), buckets, "b").mapInArrow(sort_bucket, ROW))

    def cut(batches):
        kinds = _taken(batches)
        if TEXTS not in kinds:
            return
        pack = Chosen(kinds, length, head, buckets)
        data, ends, doc, null = pack.texts
        answers = [_loaded(r["x"]) for r in kinds.get(ANSWERS, [])]
        _, hot = parted(pack)
        late = np.zeros(len(hot.text), dtype=bool)
        place = dict(zip(hot.full.tolist(), zip(hot.edges.tolist(), hot.edges[1:].tolist())))
        for r in kinds.get(LATE, []):
            x, y = place[r["b"]]
            late[x:y] = np.unpackbits(np.frombuffer(r["x"], dtype=np.uint8), count=y - x)
        taken = late[hot.number] | (hot.least[hot.number] < pack.smallest[hot.entry])  # in another pack, or by another entry of this one
        answers.append((hot.entry[taken], hot.offset[taken], hot.offset[taken]))
        change = np.zeros(len(data) + 1, dtype=np.int32)
        # runs of rows that are not the pack's first to have the entry
        late = pack.smallest[pack.entry] < pack.doc
        np.add.at(change, pack.first[late], 1)
        np.add.at(change, pack.last[late] + length, -1)
        # for the others, what was found elsewhere
        run = np.flatnonzero(~late)
        run = run[np.argsort(pack.entry[run], kind="stable")]
        entry = pack.entry[run]
        for a, b, e in answers:
            lo, hi = np.searchsorted(entry, a), np.searchsorted(entry, a, side="right")
            n = hi - lo
            which = run[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            np.add.at(change, pack.anchor[which] - np.repeat(e, n).astype(np.int64), 1)
            np.add.at(change, pack.anchor[which] - np.repeat(b, n).astype(np.int64) + length, -1)
        yield from _kept(data, ends, doc, null, np.cumsum(change[:-1]) > 0)

    back = both.unionByName(found)
    return _dealt(back, packs, "j").mapInArrow(cut, "id long, spans array<struct<start:bigint,`end`:bigint>>, kept binary")


def _kept(data: np.ndarray, ends: np.ndarray, doc: np.ndarray, null: np.ndarray, gone: np.ndarray):
    """The result rows of a pack whose bytes ``gone`` are removed, some at a time."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for at in range(0, len(ends), 2000):
        spans, kept = [], []
        start = int(ends[at - 1]) if at else 0
        for stop in ends[at : at + 2000].tolist():
            g = gone[start:stop]
            if g.any():
                edge = np.flatnonzero(np.diff(np.concatenate([[0], g.view(np.int8), [0]])))
                spans.append([{"start": x, "end": y} for x, y in edge.reshape(-1, 2).tolist()])
                kept.append(data[start:stop][~g].tobytes())
            else:
                spans.append([])
                kept.append(data[start:stop].tobytes())
            start = stop
        own = slice(at, at + 2000)
        yield pa.RecordBatch.from_arrays([pa.array(doc[own], pa.int64(), mask=null[own]), pa.array(spans, kind), pa.array(kept, pa.binary())], names=["id", "spans", "kept"])
