"""Removal of repeated byte strings by longest-previous-factor arrays.

A byte goes if a string of `length` bytes around it also starts elsewhere, in
the same text or another (`keep_first`: if it starts earlier). That needs no
suffix array of the whole corpus: strings that are equal have the same
smallest hash of their runs of 48 bytes (a quarter of `length` if that is less), at the same place. So

1. each text is cut into segments of the windows (strings of `length` bytes)
   that share that smallest run, its anchor. Only anchors are shuffled, about
   one in 75 bytes, as hashes;
2. an anchor that occurs once holds no repeat. One whose segments are all the
   same, however many there are, repeats as a whole;
3. of the other anchors' segments, one of each content goes into blocks of
   bounded size. A block gets a suffix array (prefix doubling, of suffixes that
   start a window), the previous and next smaller positions in suffix order,
   and from the common prefixes with these the longest previous factors. Where
   that is `length` or more, the window and its source are repeats;
4. ranges go back to the texts they are of, which are rewritten once.

An anchor with more than MOST different segments is split into parts of fewer
windows, grouped by the bytes that all windows of a part have in common. Parts
are split again while their groups are too large; in the last step, where equal
windows are one row, none is. Texts are
shuffled compressed, and those of any length are worked on in pieces.

Null texts are empty. Texts shorter than `length` stay. Repeated rows are texts
of their own, and so repeat each other.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import mix64, written

#: Bytes that are hashed at once, and positions of a piece of a long text.
BUFFER = 1 << 19
#: Different segments of an anchor in one block; bytes of text in a block, but for one group.
MOST, BLOCK = 1024, 1 << 18
#: Windows in the parts that the segments of an anchor with more kinds are split into, step by step.
PARTS = (64, 16, 4, 1)
#: Windows that share an anchor fit in so many bits beside their place.
BITS = 9
_ROOT = 0x5851F42D4C957F2D
_INVERSE = pow(_ROOT, -1, 1 << 64)


def gram_of(length: int) -> int:
    """Bytes of the runs whose hashes choose anchors."""
    if not 32 <= length <= 500:
        raise ValueError("length must be from 32 to 500")
    return min(48, length // 4)


class Hasher:
    """Rolling hashes of a buffer."""

    def __init__(self, most: int):
        import numpy as np

        rng = np.random.default_rng(11)
        self.table = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.power = np.ones(most + 1, dtype=np.uint64)
        self.back = np.ones(most + 1, dtype=np.uint64)
        self.power[1:] = np.uint64(_ROOT)
        self.back[1:] = np.uint64(_INVERSE)
        np.multiply.accumulate(self.power, out=self.power)
        np.multiply.accumulate(self.back, out=self.back)

    def sums(self, data):
        import numpy as np

        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.table[data] * self.power[: len(data)], out=out[1:])
        return out


def segments(texts: list[bytes], length: int, hasher: Hasher):
    """(text number, first window, windows, anchor hash, segment hash), an array each, for texts of at most BUFFER bytes in all."""
    import numpy as np
    import xxhash

    sizes = np.array([len(t) for t in texts])
    whole = b"".join(texts)
    data = np.frombuffer(whole, dtype=np.uint8)
    offsets = np.cumsum(sizes) - sizes
    have = np.flatnonzero(sizes >= length)
    if not len(have):
        return [np.zeros(0, dtype=np.int64)] * 3 + [np.zeros(0, dtype=np.uint64)] * 2
    sums, gram = hasher.sums(data), gram_of(length)
    n = len(data) - gram + 1
    grams = mix64((sums[gram:] - sums[:-gram]) * hasher.back[:n])
    width = length - gram + 1
    # The smallest hash in each window, with its first place in the low bits.
    padded = np.full(-(-n // width) * width + width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = grams & np.uint64(~0xFFFFF & (1 << 64) - 1) | np.arange(n, dtype=np.uint64)
    by_block = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(by_block, axis=1).ravel()
    behind = np.minimum.accumulate(by_block[:, ::-1], axis=1)[:, ::-1].ravel()
    count = sizes[have] - length + 1
    ends = np.cumsum(count)
    starts = np.arange(ends[-1]) + np.repeat(offsets[have] - (ends - count), count)
    anchor = (np.minimum(behind[starts], ahead[starts + width - 1]) & np.uint64(0xFFFFF)).astype(np.int64)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    new[(ends - count)] = True
    at = np.flatnonzero(new)
    windows = np.diff(np.append(at, len(starts)))
    first, anchor = starts[at], anchor[at]
    # Copies are told by this hash and the anchor's, so it is one of all bytes that can't be played with as sums of powers can.
    ends_at = (first + windows + length - 1).tolist()
    body = np.fromiter((xxhash.xxh3_64_intdigest(whole[a:b]) for a, b in zip(first.tolist(), ends_at, strict=True)), dtype=np.uint64, count=len(first))
    body = mix64(body ^ (windows.astype(np.uint64) << np.uint64(32)) ^ (anchor - first).astype(np.uint64))
    text = have[np.searchsorted(ends, at, side="right")]
    return text, first - offsets[text], windows, grams[anchor], body


def pieces(text: bytes, length: int):
    """(offset, bytes): parts of a text that have each window in one of them."""
    step = BUFFER - length
    if len(text) <= BUFFER:
        yield 0, text
        return
    for a in range(0, len(text) - length + 1, step):
        yield a, text[a : a + step + length - 1]


def _anchors(length: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        hasher = Hasher(BUFFER)

        def out(rows):
            text, first, windows, anchor, body = segments([r[2] for r in rows], length, hasher)
            dk = np.array([r[0] for r in rows], dtype=np.int64)[text] if len(rows) else text
            first = first + np.array([r[1] for r in rows], dtype=np.int64)[text]
            return pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(body.view(np.int64)), pa.array(dk), pa.array(first << BITS | windows)], names=["h", "s", "dk", "at"]
            )

        rows, size = [], 0
        for batch in batches:
            for dk, text in zip(batch.column("dk").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if text is None or len(text) * 4 < length:
                    continue
                data = text.encode("utf-8")
                if len(data) < length:
                    continue
                for a, part in pieces(data, length):
                    if rows and size + len(part) > BUFFER:
                        yield out(rows)
                        rows, size = [], 0
                    rows.append((dk, a, part))
                    size += len(part)
        if rows:
            yield out(rows)

    return run


def suffix_ranks(text, length: int):
    """Ranks of the prefixes of 8, 16, ... bytes of all suffixes, the greatest not over length: {bytes: ranks}."""
    import numpy as np

    n = len(text)
    padded = np.zeros(n + 8, dtype=np.uint8)
    padded[:n] = text
    word = np.zeros(n, dtype=np.uint64)
    for i in range(8):
        word = word << np.uint64(8) | padded[i : n + i].astype(np.uint64)

    def ranked(key):
        order = np.argsort(key)
        new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        out = np.empty(n, dtype=np.int64)
        out[order] = new
        return out

    ranks = {8: ranked(word)}
    k = 8
    while 2 * k <= length:
        second = np.zeros(n, dtype=np.int64)
        second[: n - k] = ranks[k][k:] + 1
        ranks[2 * k] = ranked(ranks[k] * (n + 1) + second)
        k *= 2
    return ranks, k


def nearest_smaller(values):
    """(previous, next): for each place the nearest one before, and after, with a smaller value; -1 and n where there is none."""
    import numpy as np

    def before(v):
        n = len(v)
        tables = [v]
        while 2 << (len(tables) - 1) <= n:
            t, w = tables[-1], 1 << (len(tables) - 1)
            tables.append(np.minimum(t[:-w], t[w:]))
        at = np.arange(n)
        for level in range(len(tables) - 1, -1, -1):
            to = at - (1 << level)
            ok = to >= 0
            ok[ok] = tables[level][to[ok]] >= v[ok]
            at = np.where(ok, to, at)
        return at - 1

    return before(values), len(values) - 1 - before(values[::-1])[::-1]


def longest_previous_factors(text, starts, length: int):
    """(lpf, source) of the suffixes of a uint8 array that start at `starts`, ascending: the length, up to `length`, of the longest prefix that also starts at an earlier one of them, and where.

    Each of the suffixes must have `length` bytes; source is -1 where lpf is 0.
    """
    import numpy as np

    if len(starts) == 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    ranks, top = suffix_ranks(text, length)
    # A prefix of `length` bytes is the first `top` and the last `top` of it.
    order = np.argsort(ranks[top][starts] * (len(text) + 1) + ranks[top][starts + length - top])
    previous, following = nearest_smaller(order)
    place = starts[order]

    def common(i, j):
        k, left = np.zeros(len(i), dtype=np.int64), np.arange(len(i))
        for size in sorted(ranks, reverse=True):
            ok = k[left] + size <= length
            x, y = i[left] + k[left], j[left] + k[left]
            same = ok & (ranks[size][np.minimum(x, len(text) - 1)] == ranks[size][np.minimum(y, len(text) - 1)])
            k[left[same]] += size
            if size == top:  # it may fit more than once
                while True:
                    again = same & (k[left] + size <= length)
                    x, y = i[left] + k[left], j[left] + k[left]
                    again &= ranks[size][np.minimum(x, len(text) - 1)] == ranks[size][np.minimum(y, len(text) - 1)]
                    if not again.any():
                        break
                    k[left[again]] += size
        for _ in range(7):
            live = np.flatnonzero(k < length)
            live = live[text[i[live] + k[live]] == text[j[live] + k[live]]]
            if not len(live):
                break
            k[live] += 1
        return k

    lpf, source = np.zeros(len(order), dtype=np.int64), np.full(len(order), -1)
    for other, have in ((previous, previous >= 0), (following, following < len(order))):
        at = np.flatnonzero(have)
        k = common(place[at], place[other[at]])
        better = k > lpf[at]
        lpf[at[better]] = k[better]
        source[at[better]] = place[other[at[better]]]
    out, src = np.empty_like(lpf), np.empty_like(source)
    out[order], src[order] = lpf, source
    return out, src


def _repeats(length: int, keep_first: bool):
    """Of rows (g, x, first, seg) sorted by (g, first), groups whole, the windows of each that repeat in the block: (g, x, a, b), runs of windows from a to before b."""

    def block(rows):
        import numpy as np
        import pyarrow as pa

        text = np.frombuffer(b"".join(r[2] for r in rows), dtype=np.uint8)
        sizes = np.array([len(r[2]) for r in rows])
        offsets = np.cumsum(sizes) - sizes
        count = sizes - length + 1
        ends = np.cumsum(count)
        row = np.repeat(np.arange(len(rows)), count)
        starts = np.arange(ends[-1]) + np.repeat(offsets - (ends - count), count)
        lpf, source = longest_previous_factors(text, starts, length)
        again = np.zeros(len(text), dtype=bool)
        whole = lpf >= length
        again[starts[whole]] = True
        if not keep_first:
            again[source[whole]] = True
        hit = np.flatnonzero(again[starts])
        new = np.ones(len(hit), dtype=bool)
        new[1:] = (hit[1:] != hit[:-1] + 1) | (row[hit[1:]] != row[hit[:-1]])
        at = np.flatnonzero(new)
        run_row = row[hit[at]]
        low = starts[hit[at]] - offsets[run_row]
        high = low + np.diff(np.append(at, len(hit)))
        g, x = (np.array([r[i] for r in rows], dtype=np.int64)[run_row] for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(g), pa.array(x), pa.array(low.astype(np.int64)), pa.array(high.astype(np.int64))], names=["g", "x", "a", "b"])

    def run(batches):
        rows, size, at = [], 0, None
        for batch in batches:
            for g, x, seg in zip(*(batch.column(n).to_pylist() for n in ("g", "x", "seg")), strict=True):
                if g != at and size >= BLOCK:
                    yield block(rows)
                    rows, size = [], 0
                at = g
                rows.append((g, x, seg))
                size += len(seg)
        if rows:
            yield block(rows)

    return run


def _split(length: int, part: int):
    """(h, s, g, off, lead, seg) of rows (h, s, off, lead, seg), off the place of seg in the segment h, s: runs of `part` windows, cut at places counted from the anchor; g hashes what all windows of a run have in common."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        for batch in batches:
            out = [[] for _ in range(6)]
            for h, s, off, lead, seg in zip(*(batch.column(n).to_pylist() for n in ("h", "s", "off", "lead", "seg")), strict=True):
                n, a = len(seg) - length + 1, 0
                while a < n:
                    low = a - (a - lead) % part  # at a multiple of part from the anchor
                    b = min(n, low + part)
                    # What windows low to low + part - 1 share; all of it is in the segment, as each of its windows holds it.
                    core = seg[low + part - 1 : low + length]
                    g = xxhash.xxh3_64_intdigest(core, seed=(h ^ (low - lead) * 0x9E3779B97F4A7C15) & (1 << 64) - 1)
                    for column, value in zip(out, (h, s, g - (1 << 64) if g >> 63 else g, off + a, lead - a, seg[a : b + length - 1]), strict=True):
                        column.append(value)
                    a = b
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:5]), pa.array(out[5], pa.binary())], names=["h", "s", "g", "off", "lead", "seg"])

    return run


def _cut_out(length: int):
    """(h, s, seg) of rows (z, list of (h, s, at))."""

    def run(batches):
        import pyarrow as pa
        import zstandard

        opened = zstandard.ZstdDecompressor()
        for batch in batches:
            out = [[], [], []]
            for z, wanted in zip(batch.column("z").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                data = opened.decompress(z)
                for w in wanted:
                    first, windows = w["at"] >> BITS, w["at"] & (1 << BITS) - 1
                    out[0].append(w["h"])
                    out[1].append(w["s"])
                    out[2].append(data[first : first + windows + length - 1])
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], names=["h", "s", "seg"])

    return run


def _leads(length: int):
    """Adds where in a segment its anchor is: the first place of the smallest hash in its first window."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        hasher, gram = Hasher(length + 512), gram_of(length)
        for batch in batches:
            lead = []
            for seg in batch.column("seg").to_pylist():
                sums = hasher.sums(np.frombuffer(seg, dtype=np.uint8)[:length])
                n = length - gram + 1
                lead.append(int(np.argmin(mix64((sums[gram:] - sums[:-gram]) * hasher.back[:n]) >> np.uint64(20))))
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("s"), pa.array(lead, pa.int64()), batch.column("seg")], names=["h", "s", "lead", "seg"])

    return run


def _packed(batches):
    import pyarrow as pa
    import zstandard

    small = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        z = [small.compress((t or "").encode("utf-8")) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("dk"), batch.column("id"), pa.array(z, pa.binary())], names=["dk", "id", "z"])


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _rewritten(with_text: bool):
    def run(batches):
        import pyarrow as pa
        import zstandard

        opened = zstandard.ZstdDecompressor()
        for batch in batches:
            cols = [[] for _ in range(5)]
            for z, ranges in zip(batch.column("z").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
                data = opened.decompress(z)
                gone = merged([(r["a"], r["b"]) for r in ranges or ()])
                kept, at = [], 0
                for a, b in gone:
                    kept.append(data[at:a])
                    at = b
                rest = b"".join([*kept, data[at:]])
                for c, v in zip(cols, (len(data), len(data) - len(rest), len(gone), hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "ignore") if with_text else None), strict=True):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def repeated(found: DataFrame, docs_z: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """(dk, a, b): byte ranges of repeats, from the anchors (h, s, dk, at) whose h occurs more than once; `same` where all segments of an h are."""
    place, windows = F.shiftright("at", BITS), F.col("at").bitwiseAND((1 << BITS) - 1)

    mixed = found.filter("not same")
    rank = F.struct("order", "dk", "at") if keep_first else F.struct("dk", "at")
    one = written(mixed.groupBy("h", "s").agg(F.count(F.lit(1)).alias("n"), F.min(rank).alias("rank")), "suffix-kinds")
    wanted = one.select(F.col("rank.dk").alias("dk"), F.struct("h", "s", F.col("rank.at").alias("at")).alias("w")).groupBy("dk").agg(F.collect_list("w").alias("wanted"))
    segs = docs_z.select("dk", "z").join(wanted, "dk").select("z", "wanted").mapInArrow(_cut_out(length), "h long, s long, seg binary").dropDuplicates(["h", "s"])
    segs = written(segs.join(one.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")), "h"), "suffix-segments")

    def ranked(rows):
        """With the earliest place of each segment, which only keep_first needs."""
        return rows.join(one.select("h", "s", "rank"), ["h", "s"]) if keep_first else rows.withColumn("rank", F.lit(0))

    def solved(rows):
        """(g, x, a, b) of rows (g, x, seg, rank), each g in one block, the earliest rows first."""
        return rows.repartition("g").sortWithinPartitions("g", "rank", "x").select("g", "x", "seg").mapInArrow(_repeats(length, keep_first), "g long, x long, a long, b long")

    few = ranked(segs.filter(F.col("kinds") <= MOST)).select(F.col("h").alias("g"), F.col("s").alias("x"), "seg", "rank")
    hits = solved(few).select(F.col("g").alias("h"), F.col("x").alias("s"), "a", "b")
    large = segs.filter(F.col("kinds") > MOST).select("h", "s", "seg")
    if not large.isEmpty():
        large = large.mapInArrow(_leads(length), "h long, s long, lead long, seg binary").withColumn("off", F.lit(0).cast("long"))
        for part in PARTS:
            cut = large.mapInArrow(_split(length, part), "h long, s long, g long, off long, lead long, seg binary").withColumn("x", F.xxhash64("seg"))
            cut = written(ranked(cut), "suffix-parts")
            kinds = cut.groupBy("g", "x").agg(F.count(F.lit(1)).alias("n"), F.first("seg").alias("seg"), F.min("rank").alias("rank"))
            groups = kinds.groupBy("g").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("rows")).filter("rows > 1")
            kinds = written(kinds.join(groups, "g"), "suffix-parts")
            ready = kinds.filter(F.col("kinds") <= MOST)
            # Copies of a part repeat it whole (for keep_first all but the first); else its windows may.
            copies = cut.join(ready.filter("n > 1").select("g", "x", F.col("rank").alias("least")), ["g", "x"])
            copies = copies.filter(F.col("rank") > F.col("least")) if keep_first else copies
            hits = hits.unionByName(copies.select("h", "s", F.col("off").alias("a"), (F.col("off") + F.length("seg") - length + 1).alias("b")))
            inside = cut.join(solved(ready.filter("kinds > 1" if not keep_first else "true")), ["g", "x"])
            hits = hits.unionByName(inside.select("h", "s", (F.col("off") + F.col("a")).alias("a"), (F.col("off") + F.col("b")).alias("b")))
            rest = kinds.filter(F.col("kinds") > MOST).select("g").distinct()
            if part == 1 or rest.isEmpty():
                break
            large = cut.join(rest, "g").select("h", "s", "off", "lead", "seg")
    within = hits.groupBy("h", "s").agg(F.collect_list(F.struct("a", "b")).alias("runs"))
    known = one.join(within, ["h", "s"], "left").withColumnRenamed("rank", "least")
    tagged = found.join(known, ["h", "s"], "left")
    if keep_first:
        entire = F.when(F.col("same"), ~F.col("first")).otherwise(rank > F.col("least"))
    else:
        entire = F.col("same") | (F.col("n") > 1)
    every = F.array(F.struct(F.lit(0).cast("long").alias("a"), windows.alias("b")))
    runs = tagged.select("dk", place.alias("base"), F.inline(F.when(entire, every).otherwise(F.col("runs"))))
    return runs.select("dk", (F.col("base") + F.col("a")).alias("a"), (F.col("base") + F.col("b") + length - 1).alias("b"))


def deduplicate(docs: DataFrame, length: int = 200, keep_first: bool = True, with_text: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept), one row per row of docs; kept is the rest as text, without broken characters.

    keep_first leaves the earliest occurrence, in the order of ids, of each repeated string.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    key: Column = F.xxhash64(F.col(id_col), F.col(text_col))
    rows = docs.select(key.alias("dk"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    anchors = rows.select("dk", "text").mapInArrow(_anchors(length), "h long, s long, dk long, at long")
    if keep_first:
        anchors = anchors.join(rows.select("dk", F.struct(F.col("id").isNull().alias("none"), F.col("id")).alias("order")).dropDuplicates(["dk"]), "dk")
    anchors = written(anchors, "suffix-anchors")
    counted = anchors.groupBy("h").agg(
        F.count(F.lit(1)).alias("n"), F.min("s").alias("low"), F.max("s").alias("high"), *([F.min(F.struct("order", "dk", "at")).alias("least")] if keep_first else [])
    )
    again = counted.filter("n > 1").withColumn("same", F.col("low") == F.col("high")).drop("n", "low", "high")
    found = anchors.join(again, "h")
    if keep_first:
        found = found.withColumn("first", F.struct("order", "dk", "at") == F.col("least")).drop("least")
    found = written(found, "suffix-found")
    docs_z = written(rows.mapInArrow(_packed, f"dk long, id {kind}, z binary"), "suffix-texts")
    ranges = repeated(found, docs_z, length, keep_first)
    by_text = ranges.groupBy("dk").agg(F.collect_set(F.struct("a", "b")).alias("ranges"))
    out = docs_z.join(by_text, "dk", "left").select("id", "z", "ranges")
    done = out.mapInArrow(_rewritten(with_text), f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string")
    return done.withColumnRenamed("id", id_col)
