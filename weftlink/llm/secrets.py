"""Secret scans: rules over a text and over every layer that can be unwrapped from it.

A worklist holds layers. Each is searched by the rules, then unwrapped by every decoder that
changes it: percent escapes and Unicode escapes over the whole layer, base64 runs one by one
(over line breaks too), and compressed bytes (gzip, zlib, bzip2, xz, zstd; all members or frames)
found under base64 or escapes. New layers join the list until there is none; a layer whose text is
that of a layer it comes from is not taken, which ends cycles, and of equal layers of one place the
first is taken. Every layer knows how its characters map to those of the layer above, so each find
becomes a span of the document; a compressed layer maps to its whole run.

Layers of any bytes are entered: a byte that is no text stays as it is (under escapes, in its escaped
form), and the rest around it is decoded. All that stands under a compressed run has the run's span, so only
kinds are sought there, by one way whatever its size: layers are whole bytes, which lie in memory up to
``WINDOW`` and are mapped from a file of the task beyond that, and are decoded piece by piece.

Defined results: a null text is the empty text, which has no spans; rows are independent of each
other, so repeated rows have repeated results; an empty table has no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import lzma
import mmap
import re
import tempfile
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate, islice

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in their order; each with its pattern and the least length of the group that counts.
RULES = [
    ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]{16,}"), 0, 16),  # maximal runs, as with +, but short ones are passed over at once
]
ORDER = {kind: i for i, (kind, *_) in enumerate(RULES)}
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u\{[0-9A-Fa-f]{1,6}\}|(?:\\u[0-9A-Fa-f]{4})+|(?:\\U[0-9A-Fa-f]{8})+|(?:\\x[0-9A-Fa-f]{2})+|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});")
_RUN = "[A-Za-z0-9+/_-]"
BASE64 = re.compile(rf"(?<!{_RUN}){_RUN}{{16,}}={{0,2}}")
WRAPPED = re.compile(rf"(?<!{_RUN}){_RUN}{{16,}}(?:\r?\n[\x20\t]*{_RUN}+)+={{0,2}}")
LINE = re.compile(rf"{_RUN}+")
#: Bytes of a layer that are held in memory, and those that are decoded at once.
WINDOW, PIECE = 8 << 20, 1 << 20
#: The same over bytes; runs are taken without a way back, which would be held for each of their parts.
B_RULES = [(re.compile(rule.pattern.encode(), rule.flags & re.IGNORECASE), group, least) for _, rule, group, least in RULES]
B_PERCENT, B_ESCAPE = (re.compile(x.pattern.replace(")+", ")++").encode()) for x in (PERCENT, ESCAPE))
B_BASE64, B_LINE = re.compile(BASE64.pattern.encode()), re.compile(LINE.pattern.encode())
B_FIRST = re.compile(rf"(?<!{_RUN}){_RUN}{{16,}}(?=\r?\n[\x20\t]*{_RUN})".encode())
B_NEXT = re.compile(rf"\r?\n[\x20\t]*({_RUN}+)".encode())
SURROGATE = re.compile("[\ud800-\udfff]")
ALPHABET = bytes.maketrans(b"-_", b"+/")


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every match, leftmost and non-overlapping for each kind."""
    return [(m.start(), k, m.end()) for k, (_, rule, group, least) in enumerate(RULES) for m in rule.finditer(text) if m.end(group) - m.start(group) >= least]


class Layer:
    """A text, and where its characters come from: ``spot`` gives the span of a character in the layer above."""

    def __init__(self, text: str, above: Layer | None = None, spot: Callable[[int], tuple[int, int]] | None = None):
        self.text, self.above, self.spot = text, above, spot

    def repeats(self) -> bool:
        """Whether a layer that this one comes from has the same text."""
        layer = self.above
        while layer is not None and layer.text != self.text:
            layer = layer.above
        return layer is not None

    def origin(self, start: int, end: int) -> tuple[int, int]:
        """The document's span of [start, end)."""
        layer = self
        while layer.above is not None:
            start, end = layer.spot(start)[0], layer.spot(end - 1)[1]
            layer = layer.above
        return start, end


def _replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every match that can be decoded replaced. decode: match -> [(text, encoded length)] or None."""
    out, edges, starts, widths, at, size = [], array("q"), array("q"), array("q"), 0, 0  # a width of 0: characters that stay

    def add(text: str, start: int, width: int) -> None:
        nonlocal size
        if text:
            edges.append(size)
            starts.append(start)
            widths.append(width)
            out.append(text)
            size += len(text)

    changed = False
    for m in pattern.finditer(layer.text):
        if (got := decode(m.group())) is None:
            continue
        changed = True
        add(layer.text[at : m.start()], at, 0)
        at = m.start()
        for text, length in got:
            add(text, at, length)
            at += length
    if not changed:
        return None
    add(layer.text[at:], at, 0)

    def spot(i: int) -> tuple[int, int]:
        k = bisect_right(edges, i) - 1
        start = starts[k] if widths[k] else starts[k] + i - edges[k]
        return start, start + (widths[k] or 1)

    return Layer("".join(out), layer, spot)


def _kept_bytes(data: bytes, raw: str, width: int) -> list[tuple[str, int]]:
    """The characters of bytes that ``raw`` writes with ``width`` characters each, with the length of what they replace; bytes that are no UTF-8 stay as written."""
    out, at = [], 0
    for c in data.decode(errors="surrogateescape"):
        if "\udc80" <= c <= "\udcff":
            out += [(x, 1) for x in raw[at : at + width]]
            at += width
        else:
            out.append((c, n := width * len(c.encode())))
            at += n
    return out


def _percent(run: str) -> list | None:
    return _kept_bytes(bytes.fromhex(run.replace("%", "")), run, 3)


def _escape(run: str) -> list | None:
    if run[1] == "x":
        return _kept_bytes(bytes.fromhex(run.replace("\\x", "")), run, 4)
    if run[1] == "u" and run[2] != "{":
        out, at = [], 0
        for c in bytes.fromhex(run.replace("\\u", "")).decode("utf-16-be", errors="surrogatepass"):
            n = 12 if c > "\uffff" else 6
            out += [(x, 1) for x in run[at : at + n]] if "\ud800" <= c <= "\udfff" else [(c, n)]
            at += n
        return out
    if run[1] == "U":
        codes, width = [int(x, 16) for x in run.split("\\U")[1:]], 10
    elif run[0] == "&":
        codes, width = [int(run[3:-1], 16) if run[2] in "xX" else int(run[2:-1])], len(run)
    else:
        codes, width = [int(run[3:-1], 16)], len(run)
    if any(x > 0x10FFFF or 0xD800 <= x <= 0xDFFF for x in codes):
        return None
    return [(chr(x), width) for x in codes]


def _magic(data: bytes) -> str | None:
    if data[:2] == b"\x1f\x8b" or data[:1] == b"\x78" and len(data) > 1 and int.from_bytes(data[:2], "big") % 31 == 0:
        return "zlib"
    return next((kind for start, kind in ((b"BZh", "bz2"), (b"\xfd7zXZ\0", "xz"), (b"\x28\xb5\x2f\xfd", "zstd")) if data.startswith(start)), None)


class _Inflater:
    """Inflates bytes that come in pieces: all members or frames one after the other, and then what is not compressed as it is."""

    def __init__(self):
        self.held, self.now, self.kind, self.ended = b"", None, None, False

    def feed(self, data: bytes, last: bool) -> Iterator[bytes]:
        self.held += data
        while self.held and not self.ended:
            if self.now is None:
                if len(self.held) < 6 and not last:
                    return
                self.kind = _magic(self.held)
                if self.kind is None:
                    yield self.held
                    self.held = b""
                    return
                self.now = {"zlib": lambda: zlib.decompressobj(47), "bz2": bz2.BZ2Decompressor, "xz": lzma.LZMADecompressor, "zstd": lambda: zstandard.ZstdDecompressor(max_window_size=1 << 31).decompressobj(write_size=PIECE)}[self.kind]()
            try:
                yield from self._step()
            except (zlib.error, OSError, ValueError, EOFError, lzma.LZMAError, zstandard.ZstdError, MemoryError):
                self.ended = True  # damaged: what came before has been given

    def _step(self) -> Iterator[bytes]:
        d, data, self.held = self.now, self.held, b""
        if self.kind == "zlib":
            while True:
                yield (got := d.decompress(data, PIECE))
                data = d.unconsumed_tail
                if d.eof or not data and len(got) < PIECE:
                    break
        elif self.kind == "zstd":
            for at in range(0, len(data), 1 << 9):  # a few bytes may be very many when inflated
                if d.eof:
                    self.held, self.now = d.unused_data + data[at:], None
                    return
                yield d.decompress(data[at : at + (1 << 9)])
        else:
            yield d.decompress(data, PIECE)
            while not d.eof and not d.needs_input:
                yield d.decompress(b"", PIECE)
        if d.eof:
            self.now, self.held = None, d.unused_data


def _inflated(pieces: Iterator[bytes], damage: list[bool]) -> Iterator[bytes]:
    """What the pieces inflate to; ``damage`` gets an entry if they break off."""
    inflater = _Inflater()
    for data in pieces:
        yield from inflater.feed(data, False)
    yield from inflater.feed(b"", True)
    damage += [True] * inflater.ended


def _decoded(run: str) -> bytes:
    """The bytes of a base64 run of either alphabet, without its padding."""
    body = run.replace("-", "+").replace("_", "/")
    body = body[: len(body) - (len(body) % 4 == 1)]
    return base64.b64decode(body + "=" * (-len(body) % 4))


class _Bytes:
    """The bytes of a layer, in memory or mapped from a file that goes with them, and their digest."""

    def __init__(self, pieces: Iterator[bytes]):
        held, size, digest, file = [], 0, hashlib.sha256(), None
        for piece in pieces:
            digest.update(piece)
            size += len(piece)
            if file is None and size > WINDOW:
                file = tempfile.TemporaryFile()
                file.writelines(held)
                held = []
            (file.write if file else held.append)(piece)
        self.digest = digest.digest()
        if file:
            with file:
                file.flush()
                self.data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        else:
            self.data = b"".join(held)


def _cut(data, start: int, end: int) -> Iterator[bytes]:
    for at in range(start, end, PIECE):
        yield data[at : min(end, at + PIECE)]


def _unescaped_run(data, start: int, end: int) -> Iterator[bytes]:
    """What ``_percent`` or ``_escape`` make of the run, in pieces."""
    mark = data[start : start + 3]
    if mark[:2] == b"\\U":
        ok = all((x := int(data[i + 2 : i + 10], 16)) <= 0x10FFFF and not 0xD800 <= x <= 0xDFFF for i in range(start, end, 10))
        yield from (chr(int(data[i + 2 : i + 10], 16)).encode() for i in range(start, end, 10)) if ok else _cut(data, start, end)
        return
    if mark[:1] == b"&" or mark == b"\\u{":
        got = _escape(data[start:end].decode())
        yield data[start:end] if got is None else "".join(x for x, _ in got).encode()
        return
    sign = mark[:1] if mark[:1] == b"%" else mark[:2]
    width, codec, errors = {b"%": (3, "utf-8", "surrogateescape"), b"\\x": (4, "utf-8", "surrogateescape"), b"\\u": (6, "utf-16-be", "surrogatepass")}[sign]
    decoder, at, step = codecs.getincrementaldecoder(codec)(errors), start, width << 14
    for i in range(start, end, step):
        raw = bytes.fromhex(data[i : min(end, i + step)].replace(sign, b"").decode())
        text = decoder.decode(raw, i + step >= end)
        if not SURROGATE.search(text):
            yield (out := text.encode())
            at += width * (len(out) if codec == "utf-8" else len(text.encode(codec)) // 2)
            continue
        out = []
        for c in text:
            if "\ud800" <= c <= "\udfff":
                out.append(data[at : at + width])
                at += width
            else:
                out.append(x := c.encode())
                at += width * (len(x) if codec == "utf-8" else 1 + (c > "\uffff"))
        yield b"".join(out)


def _unescaped(data, pattern: re.Pattern) -> Iterator[bytes]:
    """``data`` with every match that can be decoded replaced."""
    at = 0
    for m in pattern.finditer(data):
        yield from _cut(data, at, m.start())
        yield from _unescaped_run(data, *m.span())
        at = m.end()
    yield from _cut(data, at, len(data))


def _lines(data, at: int) -> Iterator[tuple[int, int]]:
    """The lines of the wrapped block that begins at ``at``, from there on."""
    m = B_LINE.match(data, at)
    span = m.span()
    while True:
        yield span
        if (m := B_NEXT.match(data, span[1])) is None:
            return
        span = m.span(1)


def _byte_runs(data) -> Iterator[Iterator[tuple[int, int]]]:
    """The lines of each base64 run, as ``_runs``."""
    for m in B_BASE64.finditer(data):
        end = m.end()
        while data[end - 1] == 61:  # =
            end -= 1
        yield iter([(m.start(), end)])
    at = 0
    while data.find(b"\n", at) >= 0 and (m := B_FIRST.search(data, at)):
        yield _lines(data, m.start())
        place = width = n = first = 0
        for i, (a, at) in enumerate(_lines(data, m.start())):
            if n and at - a == width:
                n += 1
                continue
            if n > 1 and first and width >= 16:
                yield islice(_lines(data, place), n + 1)
            place, width, n, first = a, at - a, 1, i
        if n > 1 and first and width >= 16:
            yield islice(_lines(data, place), n + 1)


def _unbased(data, lines: Iterator[tuple[int, int]]) -> Iterator[bytes]:
    """``_decoded`` of the lines, in pieces."""
    held, size = [], 0
    for start, end in lines:
        for piece in _cut(data, start, end):
            held.append(piece)
            size += len(piece)
            if size >= 1 << 16:
                run = b"".join(held)
                yield base64.b64decode(run[: (cut := size // 4 * 4)].translate(ALPHABET))
                held, size = [run[cut:]], size - cut
    yield _decoded(b"".join(held).decode())


def _inflations(raw: _Bytes) -> tuple[bool, list[_Bytes]]:
    """(whether bytes are compressed and undamaged, the layers that they inflate to): the last one of what is compressed several times, and those that only begin like it."""
    damage: list[bool] = []
    now, known, out = raw, {raw.digest}, []
    while _magic(now.data[:6]):
        before = len(damage)
        inner = _Bytes(_inflated(_cut(now.data, 0, len(now.data)), damage))
        if inner.digest in known:
            break
        if len(damage) > before and now is not raw:
            out.append(now)
        known.add(inner.digest)
        now = inner
    return now is not raw and not damage, out + [now] * (now is not raw)


def _below(layer: _Bytes) -> Iterator[_Bytes]:
    """The layers that can be unwrapped from bytes; those with escapes replaced at last, when the layer itself has gone."""
    data = layer.data
    for sign, pattern in ((b"%", B_PERCENT), (b"\\x", B_ESCAPE)):
        for m in pattern.finditer(data):
            a, b = m.span()
            width = len(sign) + 2
            if data[a : a + len(sign)] == sign and _magic(bytes.fromhex(data[a : min(b, a + 6 * width)].replace(sign, b"").decode())):
                yield from _inflations(_Bytes(bytes.fromhex(data[i : min(b, i + (width << 14))].replace(sign, b"").decode()) for i in range(a, b, width << 14)))[1]
    for lines in _byte_runs(data):
        raw = _Bytes(_unbased(data, lines))
        whole, inner = _inflations(raw)
        yield from inner
        if not whole:
            yield raw
    replaced = [_Bytes(_unescaped(data, pattern)) for pattern in (B_PERCENT, B_ESCAPE) if pattern.search(data)]
    m = lines = data = layer = None
    yield from replaced


def _kinds(layers: list[_Bytes], above: set[bytes]) -> set[int]:
    """The kinds that match in the layers or in any layer under them; ``above``: digests of what they come from."""
    kinds, seen, stack = set(), set(above), [iter(layers)]
    while stack and len(kinds) < len(RULES):
        if (layer := next(stack[-1], None)) is None:
            stack.pop()
        elif len(layer.data) and layer.digest not in seen:
            seen.add(layer.digest)
            for k, (rule, group, least) in enumerate(B_RULES):
                if k not in kinds and any(m.end(group) - m.start(group) >= least for m in rule.finditer(layer.data)):
                    kinds.add(k)
            stack.append(_below(layer))
    return kinds


def _compressed(layer: Layer, data: bytes) -> tuple[bool, set[int]]:
    """(whether bytes of ``layer`` are compressed and undamaged, the kinds found in what they inflate to)."""
    whole, layers = _inflations(_Bytes(_cut(data, 0, len(data))))
    above = set()
    while layers and layer is not None:
        above.add(hashlib.sha256(layer.text.encode(errors="surrogateescape")).digest())
        layer = layer.above
    return whole, _kinds(layers, above)


def _runs(text: str) -> Iterator[tuple[list[tuple[int, int]], int]]:
    """Base64 runs as (the (start, end) of each line, end with padding): single lines, wrapped blocks as a whole, and in these the lines of one width with the line that follows them."""
    for m in BASE64.finditer(text):
        yield [(m.start(), len(m.group().rstrip("=")) + m.start())], m.end()
    if "\n" not in text:
        return
    for m in WRAPPED.finditer(text):
        lines = [x.span() for x in LINE.finditer(text, m.start(), m.end())]
        yield lines, m.end()
        start = 0
        for i in range(1, len(lines) + 1):
            width = lines[start][1] - lines[start][0]
            if i == len(lines) or lines[i][1] - lines[i][0] != width:
                if i - start > 1 and start and width >= 16:
                    yield lines[start : i + 1], m.end() if i + 1 >= len(lines) else lines[i][1]
                start = i


def _base64_layer(layer: Layer, lines: list[tuple[int, int]], data: bytes) -> Layer:
    """The layer of a base64 run that isn't compressed, each character mapped to those that encode it."""
    firsts = [0, *accumulate(b - a for a, b in lines)]

    def place(k: int) -> int:
        line = min(bisect_right(firsts, k) - 1, len(lines) - 1)
        return lines[line][0] + k - firsts[line]

    def piece(a: int, b: int) -> tuple[int, int]:
        """Where the bytes from a to b stand."""
        return place(a * 4 // 3), place((b * 8 - 1) // 6) + 1

    inner = data.decode(errors="surrogateescape")
    if inner.isascii():
        return Layer(inner, layer, lambda i: piece(i, i + 1))
    ends = array("q", accumulate((len(c.encode(errors="surrogateescape")) for c in inner), initial=0))
    return Layer(inner, layer, lambda i: piece(ends[i], ends[i + 1]))


def find(text: str) -> tuple[list, list]:
    """(base matches, all matches): as sorted (start, kind, end), each once."""
    base = sorted(scan(text))
    if "%" not in text and "\\" not in text and "&#" not in text and not BASE64.search(text):
        return base, base
    found, seen, scans, inflated, todo = set(base), set(), {}, {}, [Layer(text)]
    while todo:
        layer = todo.pop()
        if layer.above is not None:
            if layer.text not in scans:
                scans[layer.text] = scan(layer.text)
            for start, kind, end in scans[layer.text]:
                a, b = layer.origin(start, end)
                found.add((a, kind, b))

        def whole(data: bytes, start: int, end: int, layer=layer) -> bool:
            """Whether the bytes are compressed and undamaged; what they inflate to is searched once for each place."""
            a, b = layer.origin(start, end)
            if (data, a, b) not in inflated:
                inflated[data, a, b], kinds = _compressed(layer, data)
                found.update((a, kind, b) for kind in kinds)
            return inflated[data, a, b]

        new: list[Layer | None] = []
        for mark, pattern, decode in (("%", PERCENT, _percent), ("\\&", ESCAPE, _escape)):
            if any(x in layer.text for x in mark):
                new.append(_replaced(layer, pattern, decode))
        for mark, pattern in (("%", PERCENT), ("\\x", ESCAPE)):
            if mark in layer.text:
                for m in pattern.finditer(layer.text):
                    if m.group().startswith(mark) and _magic(data := bytes.fromhex(m.group().replace(mark, ""))):
                        whole(data, *m.span())
        for lines, end in _runs(layer.text):
            data = _decoded("".join(layer.text[a:b] for a, b in lines))
            if not _magic(data) or not whole(data, lines[0][0], end):
                new.append(_base64_layer(layer, lines, data))
        for x in new:
            if x is None or not x.text or x.repeats():
                continue
            place = x.text, x.origin(0, len(x.text))
            if place not in seen:
                seen.add(place)
                todo.append(x)
    return base, sorted(found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{RULES[k][0]}:{s}:{e}" for s, k, e in spans)


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, found): spans (kind, start, end) in code points, end exclusive; base ones are those of the text as it stands."""
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [find(t or "") for t in batch.column(1).to_pylist()]
            rows = [[[{"kind": RULES[k][0], "start": s, "end": e} for s, k, e in g[i]] for g in got] for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(r, span) for r in rows)], names=["id", "base", "found"])

    kind = "array<struct<kind:string,start:bigint,`end`:bigint>>"
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id long, base {kind}, found {kind}")


def spans_text(column):
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digest(spans: list[tuple[int, int, int]]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
