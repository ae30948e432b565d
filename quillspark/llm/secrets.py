"""Secret scanning with a recursive decoding worklist.

A text is a first layer. Each layer is scanned with the patterns below, then
unwrapped: percent escapes, Unicode escapes and HTML character references over
the whole layer, base64 runs (and the gzip, zlib, bzip2 or raw deflate streams in
them, all members of them and however nested) one by one, also joined over single line ends, and from after a
slash, hyphen, underscore or line end where the start of a run holds nothing.
Bytes that are no UTF-8, or have control characters, are read as Latin-1, of
runs that hold neither text nor a stream at all four alignments of base64; NULs
are dropped, so that UTF-16 is read too. New
layers join the worklist unless a layer with the same content was seen in this
document, so that decoding ends at a fixpoint and cycles close. Every layer
carries, for each of its characters, the range of the original text that it
came from; spans found in a layer are mapped back through it.

All of a compressed stream comes from the same range. So it is unfolded and
scanned in pieces, however long it is, and only the kinds found are kept. Pieces
end where no pattern, escape or run can go on; only where LONGEST characters
have no such place, a piece ends anywhere and the next one repeats its end. Of a
stream that is cut off, what comes before its end counts. Bytes are a raw deflate
stream, which no mark tells, if they are one from the first to the last.

Nulls count as empty texts. Repeated rows give repeated results. A document
needs no other, so the work is one narrow pass without a shuffle. Texts of any
length are scanned whole; a layer decoded from one takes 8 bytes a character
beside its text, and layers of a document are in memory one after another.
"""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import re
import zlib
from array import array
from itertools import accumulate, chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})")
_REFERENCE = re.compile(r"&(?:#(?:[xX]([0-9A-Fa-f]{1,6})|([0-9]{1,7}))|(amp|lt|gt|quot|apos));")
# The references that every markup language names.
_NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_WRAPPED = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[A-Za-z0-9+/_-]+)+={0,2}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
_GLUE = re.compile(r"[/_-]")
_CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")
#: What bytes that aren't text must have to be read as Latin-1: characters in a row, or with NULs between them.
_LEGIBLE = re.compile(rb"[\x09\x0a\x0d\x20-\x7e]{12,}|(?:[\x09\x0a\x0d\x20-\x7e]\x00){12,}")
_URLSAFE = str.maketrans("-_", "+/")
#: Where a compressed text may be cut: after a character that is in no pattern, between plain words, after a line end that joins no run.
_CUT = re.compile(r"""[^A-Za-z0-9+/_=.\-%\\{}&#;:"'\x20\r\n]|(?<=[.,;:!?"'\x20])\r?\n|\s[A-Za-z]+\x20(?=[A-Za-z])""")
#: Bytes unfolded at once; characters of a piece; of one that has no place to cut; and what is then repeated.
CHUNK, PIECE, LONGEST, OVERLAP = 1 << 18, 1 << 20, 32 << 20, 1 << 20


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), kind an index into KINDS, in the order of the contract: by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    found.sort()
    return found


def _zipped(head: bytes) -> bool:
    """Whether bytes begin as a gzip, zlib or bzip2 stream does."""
    return head[:3] == b"BZh" or head[:2] == b"\x1f\x8b" or (head[:1] == b"\x78" and len(head) > 2 and (head[0] << 8 | head[1]) % 31 == 0)


class _Raw(bytes):
    """Bytes that begin with a deflate stream without a header."""


class _Bzip2:
    """A bzip2 stream as zlib's objects unfold theirs."""

    def __init__(self):
        self.stream, self.unconsumed_tail = bz2.BZ2Decompressor(), b""

    eof = property(lambda self: self.stream.eof)
    unused_data = property(lambda self: self.stream.unused_data)

    def decompress(self, data: bytes, most: int) -> bytes:
        try:
            return self.stream.decompress(data, most)
        except OSError as e:
            raise zlib.error(str(e)) from None


def _opener(head: bytes, wbits: int):
    return _Bzip2() if wbits > 0 and head[:3] == b"BZh" else zlib.decompressobj(wbits)


def _unzipped(source, wbits: int = 47):
    """What a stream and the members after it hold, in chunks; zlib.error if it is none, or a raw one that isn't whole to its last byte."""
    d, whole, some, head = None, False, False, b""
    for data in source:
        if d is None:
            head += data
            if len(head) < 3:
                continue
            d, data = _opener(head, wbits), head
        while data or not d.eof:
            if d.eof:  # a further member, or else what isn't the stream's
                if wbits < 0:
                    raise zlib.error("more than a stream")
                if not _zipped(data):
                    return
                d = _opener(data, wbits)
            out = d.decompress(data, CHUNK)
            data = d.unused_data if d.eof else d.unconsumed_tail
            whole, some = whole or d.eof, some or bool(out)
            if out:
                yield out
            if not d.eof and not data and len(out) < CHUNK:
                break
    if not whole and (wbits < 0 or not some):
        raise zlib.error("no end")


def _chunks(data: bytes, depth: int):
    """What is in `depth` streams around each other."""
    source, raw = iter((data,)), isinstance(data, _Raw)
    for i in range(depth):
        source = _unzipped(source, -15 if raw and not i else 47)
    return source


def _streams(data: bytes) -> tuple[int, bytes]:
    """How many streams are around each other, until one holds none or repeats; and the digest of what the last one holds."""
    depth, seen, last, head = 0, set(), b"", data[:3]
    while _zipped(head) or (not depth and isinstance(data, _Raw)):
        digest, head = hashlib.sha256(), b""
        try:
            for part in _chunks(data, depth + 1):
                digest.update(part)
                head = head if len(head) > 2 else (head + part)[:3]
        except zlib.error:
            break
        if digest.digest() in seen:
            break
        last = digest.digest()
        seen.add(last)
        depth += 1
    return depth, last


def _deflated(run: str) -> bool:
    """Whether a base64 run may be a raw deflate stream, by its first bytes: those of most others are none."""
    d = zlib.decompressobj(-15)
    try:
        d.decompress(_bytes(run[:512]), CHUNK)
    except zlib.error:
        return False
    return not (d.eof and len(run) > 512)


def _texts(chunks):
    """Chunks as text without NULs, what is no UTF-8 replaced."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for part in chunks:
        yield decoder.decode(part).replace("\0", "")
    yield decoder.decode(b"", True)


def _pieces(data: bytes, depth: int):
    """The text in streams, in pieces."""
    rest = ""
    for part in _texts(_chunks(data, depth)):
        rest += part
        if len(rest) < PIECE:
            continue
        near = max(0, len(rest) - len(part) - 256) if len(rest) < LONGEST else 0
        cut = max((m.end() for m in _CUT.finditer(rest, near)), default=0)
        if cut:
            yield rest[:cut]
            rest = rest[cut:]
        elif len(rest) >= LONGEST:
            yield rest
            rest = rest[-OVERLAP:]
    yield rest


class _Layer:
    """A text with the original range of each of its characters; no ranges: the original itself."""

    __slots__ = ("ends", "starts", "text")

    def __init__(self, text, starts=None, ends=None):
        self.text, self.starts, self.ends = text, starts, ends

    def span(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.starts is None else (self.starts[a], max(self.ends[a:b]))

    def replaced(self, pieces) -> _Layer:
        """With each range (a, b) of pieces (a, b, list of (character, start, end)) replaced by characters, which come from ranges of this layer."""
        out, starts, ends, at = [], array("i"), array("i"), 0
        for a, b, chars in chain(pieces, [(len(self.text), len(self.text), [])]):
            out.append(self.text[at:a])
            starts.extend(range(at, a) if self.starts is None else self.starts[at:a])
            ends.extend(range(at + 1, a + 1) if self.ends is None else self.ends[at:a])
            for c, x, y in chars:
                out.append(c)
                s, e = self.span(x, y)
                starts.append(s)
                ends.append(e)
            at = b
        return _Layer("".join(out), starts, ends)


def _percent(layer: _Layer) -> _Layer | None:
    def pieces():
        for m in _PERCENT.finditer(layer.text):
            data, at = bytes.fromhex(m[0].replace("%", "")), m.start()
            chars = []
            for c in data.decode("utf-8", "surrogateescape"):
                n = 1 if "\udc80" <= c <= "\udcff" else len(c.encode("utf-8"))
                if "\udc80" <= c <= "\udcff":  # no UTF-8: the escape stays as it is
                    chars += [(x, at + i, at + i + 1) for i, x in enumerate(layer.text[at : at + 3])]
                else:
                    chars.append((c, at, at + 3 * n))
                at += 3 * n
            yield m.start(), m.end(), chars

    return layer.replaced(pieces()) if _PERCENT.search(layer.text) else None


def _escapes(layer: _Layer) -> _Layer | None:
    def pieces():
        high = None
        for m in _ESCAPE.finditer(layer.text):
            code = int(next(x for x in m.groups() if x), 16)
            if high and high[1] == m.start() and 0xDC00 <= code < 0xE000:
                yield high[0], m.end(), [(chr(0x10000 + ((high[2] - 0xD800) << 10) + code - 0xDC00), high[0], m.end())]
                high = None
            elif 0xD800 <= code < 0xDC00:
                high = (m.start(), m.end(), code)
            elif code < 0x110000 and not 0xDC00 <= code < 0xE000:
                high = None
                yield m.start(), m.end(), [(chr(code), m.start(), m.end())]

    return layer.replaced(pieces()) if _ESCAPE.search(layer.text) else None


def _references(layer: _Layer) -> _Layer | None:
    def pieces():
        for m in _REFERENCE.finditer(layer.text):
            code = int(m[1], 16) if m[1] else int(m[2]) if m[2] else ord(_NAMED[m[3]])
            if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000:
                yield m.start(), m.end(), [(chr(code), m.start(), m.end())]

    return layer.replaced(pieces()) if _REFERENCE.search(layer.text) else None


def _runs(text: str):
    """(characters, their places in the text, where lines begin) of base64 runs, in groups: each alone, and joined over single line ends, without the last line and with it."""
    for m in _BASE64.finditer(text):
        yield [(m[0].rstrip("="), range(m.start(), m.end()), [])]
    for m in _WRAPPED.finditer(text) if "\n" in text else ():
        lines = [x.span() for x in _LINE.finditer(text, m.start(), m.end())]
        group = []
        for some in (lines[:-1], lines) if len(lines) > 2 else (lines,):
            at = [i for x in some for i in range(*x)]
            if some is lines:
                at += range(at[-1] + 1, m.end())
            group.append(("".join(text[x:y] for x, y in some), at, list(accumulate(y - x for x, y in some))[:-1]))
        yield group


def _bytes(run: str) -> bytes:
    run = run[:-1] if len(run) % 4 == 1 else run
    return base64.b64decode(run.translate(_URLSAFE) + "=" * (-len(run) % 4))


def _bad(data: bytes, final: bool = True) -> int | None:
    """Where bytes, or bytes that go on, stop being text; None if nowhere."""
    try:
        text = codecs.getincrementaldecoder("utf-8")().decode(data, final)
    except UnicodeDecodeError as e:
        text, end = data[: e.start].decode("utf-8"), e.start
    else:
        end = None
    m = _CONTROL.search(text)
    return len(text[: m.start()].encode("utf-8")) if m else end


def _opened(run: str, lines: list[int]):
    """(first character, bytes, depth, digest) of what a run holds, from its start or else from after a mark or line end in it, or as a raw stream; None if nothing."""
    dead = [-1] * 4
    for k in chain((0,), sorted({*lines, *(m.end() for m in _GLUE.finditer(run))})):
        if k and len(run) - k < 16:
            break
        if k and not _zipped(_bytes(run[k : k + 4])) and (k <= dead[k % 4] or any(_bad(_bytes(run[k : k + n]), len(run) - k <= n) is not None for n in (64, 4096))):
            continue
        data = _bytes(run[k:])
        depth, digest = _streams(data)
        if depth or (bad := _bad(data)) is None and data:
            return k, data, depth, digest
        # From what begins in step before the bad byte, the same bytes come again.
        dead[k % 4] = max(dead[k % 4], k + 4 * ((bad or 0) // 3))
    refused = set()  # heads that are no stream's; runs of one pattern repeat them
    for k in sorted({0, 1, 2, 3, *lines, *(m.end() for m in _GLUE.finditer(run))}):
        head = run[k : k + 512]
        if len(head) < 16 or head in refused:
            continue
        if not (_zipped(_bytes(head[:4])) or _deflated(head)):
            refused.add(head)
        else:
            data = _bytes(run[k:])
            data = data if _zipped(data) else _Raw(data)
            depth, digest = _streams(data)
            if depth:
                return k, data, depth, digest
    return None


def _decoded(layer: _Layer, at, k: int, data: bytes, text: str | None) -> _Layer:
    """The layer of bytes that characters from at[k] on decode to: their text, or without one Latin-1; NULs dropped."""
    chars, starts, ends, i = [], array("i"), array("i"), 0
    for c in data.decode("latin-1") if text is None else text:
        n = 1 if text is None else len(c.encode("utf-8"))
        if c != "\0":
            s, e = layer.span(at[k + 8 * i // 6], at[k + (8 * (i + n) - 1) // 6] + 1)
            chars.append(c)
            starts.append(s)
            ends.append(e)
        i += n
    return _Layer("".join(chars), starts, ends)


def _base64_layers(layer: _Layer):
    """Layers; of streams (start, end, bytes, depth, digest) instead."""
    ended = False
    for i, (run, at, lines) in ((i, x) for group in _runs(layer.text) for i, x in enumerate(group)):
        if i and ended:  # a stream that ends before the last line
            continue
        ended = False
        if (found := _opened(run, lines)) is None:
            for k in range(4):
                data = _bytes(run[k:])
                if _LEGIBLE.search(data):
                    yield _decoded(layer, at, k, data, None)
            continue
        k, data, depth, digest = found
        if depth:
            ended = True
            yield (*layer.span(at[k], at[-1] + 1), data, depth, digest)
        else:
            yield _decoded(layer, at, k, data, data.decode("utf-8"))


def _unwrapped(first: _Layer, found: set, seen: set) -> list[tuple]:
    """The streams in a layer and those inside it; adds the spans of these to found, and all that is met to seen."""
    work, streams = [first], []
    while work:
        layer = work.pop()
        if layer.starts is not None:
            for a, kind, b in base_spans(layer.text):
                s, e = layer.span(a, b)
                found.add((s, kind, e))
        new = []
        if "%" in layer.text and (x := _percent(layer)):
            new.append(x)
        if "\\" in layer.text and (x := _escapes(layer)):
            new.append(x)
        if "&" in layer.text and (x := _references(layer)):
            new.append(x)
        new += _base64_layers(layer)
        for x in new:
            # A region that two places share is decoded for each place, hence the first range in the key.
            stream = isinstance(x, tuple)
            key = (x[4], x[0]) if stream else (hashlib.sha256(x.text.encode("utf-8", "surrogatepass")).digest(), x.starts[0] if x.starts else 0)
            if (stream or x.text != layer.text) and key not in seen:
                seen.add(key)
                (streams if stream else work).append(x)
    return streams


def _kinds(data: bytes, depth: int, digest: bytes) -> set[int]:
    """The kinds of secrets in a stream and all that is inside it."""
    found, seen, work = set(), {(digest, 0)}, [_pieces(data, depth)]
    while work and len(found) < len(KINDS):
        piece = next(work[-1], None)
        if piece is None:
            work.pop()
        else:
            inner = _unwrapped(_Layer(piece, [0] * len(piece), [1] * len(piece)), found, seen)
            work += [_pieces(data, depth) for _, _, data, depth, _ in inner]
    return {k for _, k, _ in found}


def all_spans(text: str, base: list[tuple[int, int, int]] | None = None) -> list[tuple[int, int, int]]:
    """base_spans of the text and, mapped to it, those of every layer in it; without repeats, in the same order."""
    found = set(base_spans(text) if base is None else base)
    for s, e, data, depth, digest in _unwrapped(_Layer(text), found, set()):
        found |= {(s, k, e) for k in _kinds(data, depth, digest)}
    return sorted(found)


def shown(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan(batches):
    import pyarrow as pa

    for batch in batches:
        rows = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
        for text in batch.column("text").to_pylist():
            base = base_spans(text or "")
            kinds = [k for _, k, _ in base]
            for k, name in enumerate(("n_assign", "n_access", "n_hex")):
                rows[name].append(kinds.count(k))
            rows["base_sha256"].append(hashlib.sha256(shown(base).encode()).hexdigest())
            rows["spans"].append(shown(all_spans(text, base)) if text else "")
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), *(pa.array(rows[n], pa.int64()) for n in ("n_assign", "n_access", "n_hex")), *(pa.array(rows[n], pa.string()) for n in ("base_sha256", "spans"))],
            names=["id", *rows],
        )


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: its id, base counts (n_assign, n_access, n_hex), base_sha256 and all spans."""
    kind = docs.schema[id_col].dataType.simpleString()
    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(_scan, f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
        .withColumnRenamed("id", id_col)
    )


def redacted(text: str | None, mark: str = "[REDACTED]") -> str | None:
    """The text with every span, those of inner layers too, replaced by mark, until none is left."""
    while text and (spans := all_spans(text)):
        out, at = [], 0
        for a, _, b in spans:
            if a >= at:
                out += [text[at:a], mark]
            at = max(at, b)
        text = "".join(out) + text[at:]
    return text


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """docs with secrets replaced in their texts, the same columns and rows; length_col follows the text where it is not null."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            old = batch.column(text_col).to_pylist()
            new = [redacted(x) for x in old]
            columns = {n: batch.column(n) for n in batch.schema.names}
            changed = [a != b for a, b in zip(old, new, strict=True)]
            if any(changed):
                columns[text_col] = pa.array(new, batch.schema.field(text_col).type)
                if length_col in columns:
                    n = columns[length_col].to_pylist()
                    columns[length_col] = pa.array([len(t) if c and k is not None else k for t, c, k in zip(new, changed, n, strict=True)], batch.schema.field(length_col).type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
