"""Documents linked by n-gram Jaccard similarity, with signature trees; every link is found.

A document's set are its distinct shingles of three words (lower-cased A-Z, cut at
ASCII white space), fewer words being one shingle. Two documents link when
100 * intersection >= percent * union. Documents with the same set link anyway
and are one, a set, from here on; what remains are links between different sets.

Buckets. Sizes have classes. Two sets that link, the smaller one's class being given, differ in
no more than d shingles. The class cuts the range of shingles' hashes in d + c equal
parts, of which the two sets hold the same shingles in c at least. So each set is
in the bucket of what it holds in each part, by its own class and by those smaller ones
that sets which it could link with may have. A part holds several
shingles, about six to nine, and two texts that share a shingle, a line or a passage seldom hold
the same in it. Parts of fewer than OFTEN shingles are often met by chance: a set that has fewer than c of them leaves them out, for then
one of the parts held in common is another one.

Stars. Each set of a bucket is compared with the bucket's least one, which
connects groups of near copies, however large, by no more comparisons than rows.
A set is then known to belong with the least one that it is linked to.

Trees. Buckets that have their least set in common hold much the same sets, and are one from here on.
Those with sets that aren't known to belong together are searched
completely. A node holds the OR of its sets' token bitmaps, their range of sizes,
the largest number of shingles that their bits leave room for, and
their components. Two trees are traversed together from the roots: a pair of
nodes is left where the largest possible overlap is under the least that a link of their sizes
needs, or where both are of one and the same component. A bucket of up to LEAF
sets is one tree, traversed with itself. Larger buckets are
dealt out by size and component in blocks of about BLOCK sets, each the root of its tree; pairs of roots are pruned in the
same way by a join of the table of roots, and each pair left is one group of rows.

Proof. Pairs that the trees leave, each once, are held against each other's bitmaps,
then by all their shingles. What links is connected.

Null and blank texts have the empty set and link with nothing, each its own component.
Rows whose ids are null take part but name no component (null, where there is no
other). Rows that repeat are copies. Ids that repeat with different texts keep a row
each. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from itertools import chain

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import WordHashes, mix64, written
from quillspark.llm.components import components
from quillspark.llm.minhash import runs_of, words_of

RUN, PERCENT = 3, 90
GOLDEN = 0x9E3779B97F4A7C15
#: Parts that sets which link hold in common at least, and one more of each SPARE in which they may differ.
SHARED, SPARE = 2, 16
#: Shingles of a part that is not often met by chance, and how many times the least size of a class is its greatest.
OFTEN, WIDE = 2, 1.5
#: Bits of the bitmap of a set of up to a quarter as many shingles (doubled until that holds), children of a node, sets of a leaf, sets of a block.
BITS, FAN, LEAF, BLOCK = 2048, 16, 64, 4096
#: Bytes of text that are worked on together.
CHUNK = 2_000_000
#: Ids of texts that are sent to all tasks, counted first; beyond, texts are joined by id.
FEW_IDS = 500_000
#: Pairs of nodes whose children are compared at once.
TOGETHER = 256


def least_overlap(n, m, percent: int):
    """The least intersection with which sets of n and m shingles link."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    """How many shingles of a set of n, in any order, hold SHARED ones of each set that it links with; none where only an equal set could link."""
    if 100 * n // percent == n and -(-percent * n // 100) == n:
        return 0
    return min(n, n - -(-percent * n // 100) + SHARED)


def classes(percent: int, most: int):
    """(high, parts, common) of the classes of sizes up to `most`, ascending: the greatest size, in how many parts hashes are cut, and how many of them sets that link have in common at least."""
    import numpy as np

    out, high = [], 0
    while high < most or not out:
        high = max(high + 1, int(high * WIDE))
        differ = (high + 100 * high // percent) * (100 - percent) // (100 + percent)
        common = SHARED + differ // SPARE
        out.append((high, differ + common, common))
    return np.array(out, dtype=np.int64).T


def chunked(texts):
    """(first, texts) of runs of texts of about CHUNK bytes; texts are those of an Arrow column."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text.as_py())
        size += len(held[-1] or "")
        if size >= CHUNK:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def in_sequence(words: list[list[bytes]], hashes: WordHashes, run: int):
    """(sizes, runs): words of each text, and the hashes of all runs of words over the texts put one after another, of which those inside a text are the text's."""
    import numpy as np

    sizes = np.array([len(w) for w in words], dtype=np.int64)
    h = np.fromiter(map(hashes.__getitem__, chain.from_iterable(words)), dtype=np.uint64, count=int(sizes.sum()))
    n = max(0, len(h) - run + 1)
    out = np.full(n, run, dtype=np.uint64)
    for i in range(run):
        out = (out ^ h[i : i + n]) * np.uint64(GOLDEN)
        out ^= out >> np.uint64(29)
    return sizes, mix64(out)


def shingled(texts: list[str | None], hashes: WordHashes, run: int):
    """(shingles, n): the distinct shingles of each text, ascending, one text after another, and how many each has."""
    import numpy as np

    words = [words_of(t) for t in texts]
    sizes, runs = in_sequence(words, hashes, run)
    parts, at = [], 0
    for w, size in zip(words, sizes.tolist(), strict=True):
        if size >= run:
            part = runs[at : at + size - run + 1]
            part.sort()
        else:
            part = runs_of(w, hashes, run)[0]
        parts.append(part)
        at += size
    of = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    s = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
    keep = np.ones(len(s), dtype=bool)
    keep[1:] = (s[1:] != s[:-1]) | (of[1:] != of[:-1])
    return s[keep], np.bincount(of[keep], minlength=len(texts))


def width(n):
    """Bits of the bitmaps of sets of n shingles, which is an array."""
    import numpy as np

    return BITS << np.maximum(0, np.ceil(np.log2(np.maximum(n, 1) / (BITS // 4)))).astype(np.int64)


def bitmaps(shingles, n) -> list[bytes]:
    """The bitmaps of sets given one after another."""
    import numpy as np

    bits = width(n)
    starts = np.concatenate([[0], np.cumsum(bits)])
    place = (shingles >> np.uint64(20)) & (np.repeat(bits, n) - 1).astype(np.uint64)
    out = np.zeros(int(starts[-1]), dtype=np.uint8)
    out[np.repeat(starts[:-1], n) + place.astype(np.int64)] = 1
    packed = np.packbits(out, bitorder="little").tobytes()
    return [packed[a // 8 : b // 8] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]


def part_keys(shingles, n, percent: int):
    """(keys, of): the buckets of sets given one after another, and the set, by its place, of each. Shingles ascend within each set."""
    import numpy as np

    high, parts, common = classes(percent, int(n.max(initial=0)))
    own = np.searchsorted(high, n)
    links = np.array([prefix_length(x, percent) > 0 for x in n.tolist()], dtype=bool)
    mixed = mix64(shingles + np.uint64(GOLDEN))
    found_keys, found_of = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    for below in range(len(high)):
        c = np.maximum(own - below, 0)
        takes = links & (own >= below) & ((below == 0) | (100 * high[c] >= percent * n))
        if not takes.any():
            break
        k = np.where(takes, parts[c], 0)
        of, first = np.repeat(np.arange(len(n)), k), np.cumsum(k) - k
        these = np.repeat(takes, n)
        part = (((shingles[these] >> np.uint64(32)) * np.repeat(k, np.where(takes, n, 0)).astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        size = np.bincount(part + np.repeat(first, np.where(takes, n, 0)), minlength=len(of))
        # Sums within each part are differences of sums over all, which wrap as they do.
        sums, ends = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mixed[these], dtype=np.uint64)]), np.cumsum(size)
        place = (c[of] << 40) + np.arange(len(of)) - first[of] + 1
        keys = mix64(sums[ends] - sums[ends - size] + place.astype(np.uint64) * np.uint64(GOLDEN))
        few = size < OFTEN
        leaves = np.bincount(of[few], minlength=len(n)) < common[c]
        keep = ~(few & leaves[of])
        found_keys.append(keys[keep])
        found_of.append(of[keep])
    keys, of = np.concatenate(found_keys), np.concatenate(found_of)
    by = np.argsort(of, kind="stable")
    return keys[by], of[by]


def _signed(run: int, percent: int):
    """(uid, n, s1, s2, keys, bits): the size of a text's set, 128 bits that tell it, its buckets and its bitmap."""

    def mapped(batches):
        import numpy as np
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            for a, texts in chunked(batch.column("text")):
                s, n = shingled(texts, hashes, run)
                # Sums within each set are differences of sums over all, which wrap as they do.
                ends = np.concatenate([[0], np.cumsum(n)])
                none = np.zeros(1, dtype=np.uint64)
                one = np.concatenate([none, np.cumsum(mix64(s + np.uint64(GOLDEN)), dtype=np.uint64)])
                two = np.concatenate([none, np.bitwise_xor.accumulate(mix64(s ^ np.uint64(0xC2B2AE3D27D4EB4F)))])
                s1, s2 = one[ends[1:]] - one[ends[:-1]], two[ends[1:]] ^ two[ends[:-1]]
                keys, of = part_keys(s, n, percent)
                met = np.bincount(of, minlength=len(n))
                offsets = np.concatenate([[0], np.cumsum(met)]).astype(np.int32)
                bits = [b if k else None for b, k in zip(bitmaps(s, n), met.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("uid").slice(a, len(texts)),
                        pa.array(n.astype(np.int64)),
                        pa.array(s1.view(np.int64)),
                        pa.array(s2.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.view(np.int64))),
                        pa.array(bits, pa.binary()),
                    ],
                    names=["uid", "n", "s1", "s2", "keys", "bits"],
                )

    return mapped


def fold(bits: bytes, size: int):
    """A bitmap of fewer bytes: bits of the halves together, which are those that it would have had."""
    import numpy as np

    return np.bitwise_or.reduce(np.frombuffer(bits, dtype=np.uint64).reshape(-1, size // 8), axis=0)


def matrix(bits: list[bytes], size: int):
    """Bitmaps as rows of 64-bit words, all of size bytes."""
    import numpy as np

    if all(len(b) == size for b in bits):
        return np.frombuffer(b"".join(bits), dtype=np.uint64).reshape(-1, size // 8)
    return np.stack([fold(b, size) for b in bits])


class Tree:
    """A signature tree of sets, bottom level first: the sets themselves, then nodes of FAN each."""

    def __init__(self, bits, n, room, component):
        import numpy as np

        spare = n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)  # shingles that share a bit with another one
        level = {"bits": bits, "low": n, "high": n, "room": room, "spare": spare, "first": component, "last": component}
        self.levels = [level]
        how = {"bits": np.bitwise_or, "low": np.minimum, "high": np.maximum, "room": np.maximum, "spare": np.maximum, "first": np.minimum, "last": np.maximum}
        while len(self.levels[-1]["low"]) > 1:
            below = self.levels[-1]
            starts = np.arange(0, len(below["low"]), FAN)
            self.levels.append({k: f.reduceat(below[k], starts, axis=0) for k, f in how.items()})


def possible(one, i, two, j, percent: int):
    """Whether nodes i of a level and nodes j of another may hold sets that link and are not connected yet."""
    import numpy as np

    x, y = ({k: v[at] for k, v in level.items() if k != "bits"} for level, at in ((one, i), (two, j)))
    same = (x["first"] == x["last"]) & (y["first"] == y["last"]) & (x["first"] == y["first"])
    apart = (100 * x["high"] < percent * y["low"]) | (100 * y["high"] < percent * x["low"])
    need = least_overlap(x["low"], y["low"], percent)
    keep = ~same & ~apart & (np.minimum(x["room"], y["room"]) >= need)
    at = np.flatnonzero(keep)
    common = np.bitwise_count(one["bits"][i[at]] & two["bits"][j[at]]).sum(axis=1, dtype=np.int64)
    keep[at] = common + np.minimum(x["spare"][at], y["spare"][at]) >= need[at]
    return keep


def traverse(one: Tree, two: Tree, percent: int):
    """(i, j): sets of two trees that may link, i < j where both trees are one and the same."""
    import numpy as np

    top = max(len(one.levels), len(two.levels)) - 1
    level = lambda t, k: t.levels[min(k, len(t.levels) - 1)]
    i = j = np.zeros(1, dtype=np.int64)
    keep = possible(level(one, top), i, level(two, top), j, percent)
    i, j = i[keep], j[keep]
    for k in range(top, 0, -1):
        found_i, found_j = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        below = [(level(t, k - 1), FAN if k < len(t.levels) else 1) for t in (one, two)]
        for a in range(0, len(i), TOGETHER):
            kids = []
            for at, (nodes, fan) in zip((i, j), below, strict=True):
                kid = at[a : a + TOGETHER, None] * fan + np.arange(fan)
                kids.append((kid, kid < len(nodes["low"])))
            (x, has_x), (y, has_y) = kids
            ok = has_x[:, :, None] & has_y[:, None, :]
            if one is two:
                ok &= x[:, :, None] <= y[:, None, :] if k > 1 else x[:, :, None] < y[:, None, :]
            x, y = (np.broadcast_to(v, ok.shape)[ok] for v in (x[:, :, None], y[:, None, :]))
            keep = possible(below[0][0], x, below[1][0], y, percent)
            found_i.append(x[keep])
            found_j.append(y[keep])
        i, j = np.concatenate(found_i), np.concatenate(found_j)
    return (i, j) if top or one is not two else (i[:0], j[:0])


def _pairs_of(a, b):
    import numpy as np
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _tree(rows, size: int):
    """(tree, ids) of the sets of a table (rid, n, component, bits), which is sorted by component and size, as bitmaps of size bytes."""
    n, component, rid = (rows.column(c).to_numpy() for c in ("n", "component", "rid"))
    return Tree(matrix(rows.column("bits").to_pylist(), size), n, n, component), rid


def _leaves(percent: int):
    """Pairs (a, b) of rows (key, rid, n, component, bits) sorted by (key, component, n, rid), of one bucket, that may link."""

    def mapped(batches):
        import numpy as np
        import pyarrow as pa

        def pairs(rows, ends):
            a, b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
            for start, end in zip([0, *ends], ends, strict=False):
                bucket = rows.slice(start, end - start)
                tree, rid = _tree(bucket, min(len(x.as_buffer()) for x in bucket.column("bits")))
                i, j = traverse(tree, tree, percent)
                a.append(rid[i])
                b.append(rid[j])
            return _pairs_of(np.concatenate(a), np.concatenate(b))

        left = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.concat_batches([left, batch]) if left else batch
            key = rows.column("key").to_numpy()
            ends = (np.flatnonzero(key[1:] != key[:-1]) + 1).tolist()
            if ends:
                yield pairs(rows, ends)
            left = rows.slice(ends[-1]) if ends else rows  # the last bucket may go on
        if left:
            yield pairs(left, [left.num_rows])

    return mapped


def _blocks(percent: int):
    """Pairs (a, b) of a table of the rows of two blocks, side 0 and side 1, or of one block alone."""

    def grouped(table):
        import pyarrow as pa

        trees, size = [], min(len(b.as_buffer()) for b in pa.chunked_array(table.column("bits").chunks).combine_chunks())
        for side in (0, 1):
            rows = table.filter(pa.compute.equal(table.column("side"), side)).sort_by([("component", "ascending"), ("n", "ascending"), ("rid", "ascending")])
            if rows.num_rows:
                trees.append(_tree(rows, size))
        if len(trees) == 1 and table.column("i")[0] != table.column("j")[0]:  # no set of the other block is near enough in size
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        (one, a), (two, b) = trees[0], trees[-1]
        i, j = traverse(one, two, percent)
        return pa.Table.from_batches([_pairs_of(a[i], b[j])], schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return grouped


def _possible(percent: int):
    def mapped(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            n, m = (batch.column(f"n_{x}").to_numpy() for x in "ab")
            need, keep = least_overlap(n, m, percent).tolist(), []
            for i, (x, y) in enumerate(zip(batch.column("bits_a"), batch.column("bits_b"), strict=True)):
                x, y = x.as_buffer(), y.as_buffer()
                x, y = (fold(v, min(len(x), len(y))) for v in (x, y))
                spare = min(int(k) - int(np.bitwise_count(v).sum(dtype=np.int64)) for k, v in ((n[i], x), (m[i], y)))
                keep.append(min(int(n[i]), int(m[i]), int(np.bitwise_count(x & y).sum(dtype=np.int64)) + spare) >= need[i])
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return mapped


def _sets(run: int):
    def mapped(batches):
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            for s in range(0, batch.num_rows, 500):
                texts = batch.column("text").slice(s, 500).to_pylist()
                yield pa.RecordBatch.from_arrays([batch.column("rid").slice(s, 500), pa.array([runs_of(words_of(t), hashes, run)[0].tobytes() for t in texts], pa.binary())], names=["rid", "shingles"])

    return mapped


def _linked(percent: int):
    def mapped(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return mapped


def _of(table: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of a table (rid) with these ids; of few ids, which are then sent, without moving the others."""
    few = ids.limit(FEW_IDS + 1).count() <= FEW_IDS
    return table.join(F.broadcast(ids) if few else ids, "rid", "left_semi")


def _links(pairs: DataFrame, reps: DataFrame, texts: DataFrame, run: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that link, compared by bitmaps, then by all shingles; each pair once."""
    both = lambda df: df.select(F.col("a").alias("rid")).unionByName(df.select(F.col("b").alias("rid"))).distinct()
    pairs = written(pairs.distinct(), "pairs")
    sizes = _of(reps.select("rid", "n", "bits"), written(both(pairs), "ids"))
    for x in "ab":
        pairs = pairs.join(sizes.select(F.col("rid").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}")), x)
    left = written(pairs.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(_possible(percent), "a long, b long"), "possible")
    sets = _of(texts.select(F.col("uid").alias("rid"), "text"), written(both(left), "ids"))
    sets = written(sets.mapInArrow(_sets(run), "rid long, shingles binary"), "shingles")
    for x, name in (("a", "x"), ("b", "y")):
        left = left.join(sets.select(F.col("rid").alias(x), F.col("shingles").alias(name)), x)
    return written(left.select("a", "b", "x", "y").mapInArrow(_linked(percent), "a long, b long"), "linked")


def _by_trees(rows: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) across components of buckets of rows (key, rid, n, component), each bucket searched completely."""
    mixed = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("first"), F.max("component").alias("last")).filter("first < last")
    mixed = written(rows.join(mixed.select("key", "size"), "key"), "buckets")
    bits = _of(reps.select("rid", "bits"), written(mixed.select("rid").distinct(), "ids"))
    few = mixed.filter(F.col("size") <= LEAF).join(bits, "rid").select("key", "rid", "n", "component", "bits")
    pairs = few.repartition("key").sortWithinPartitions("key", "component", "n", "rid").mapInArrow(_leaves(percent), "a long, b long")
    many = mixed.filter(F.col("size") > LEAF).drop("size")
    if many.isEmpty():
        return pairs
    homes = many.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.sum("n").alias("size"), F.max(F.struct("n", "component")).alias("home"))
    many = many.join(homes.select("key", "size", F.col("home.component").alias("home")), "key")
    # Sets that link are of the same band or of neighbours; sets of the bucket's largest component have blocks of their own. Of what would fit a block, those whose bitmaps are equally long are one.
    band, away = F.floor(F.log("n") / math.log(100 / (percent * 0.95))).cast("int"), (F.col("component") != F.col("home")).cast("int")
    small, long = F.col("size") <= BLOCK, F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / (BITS // 4)))).cast("int")
    many = many.withColumn("band", F.when(small, long).otherwise(band)).withColumn("away", F.when(small, 0).otherwise(away))
    counts = many.groupBy("key", "band", "away").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    many = many.join(counts, ["key", "band", "away"]).withColumn("block", F.struct("band", "away", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int").alias("salt")))
    many = written(many.select("key", "block", "rid", "n", "component"), "blocks")
    roots = many.groupBy("key", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("component").alias("first"), F.max("component").alias("last"))
    x, y = roots.alias("x"), roots.alias("y")
    c = F.col
    fits = (c("x.key") == c("y.key")) & (c("x.block") <= c("y.block")) & (F.abs(c("x.block.band") - c("y.block.band")) <= 1)
    sizes = (100 * c("x.high") >= percent * c("y.low")) & (100 * c("y.high") >= percent * c("x.low"))
    same = (c("x.first") == c("x.last")) & (c("y.first") == c("y.last")) & (c("x.first") == c("y.first"))
    met = x.join(y, fits & sizes & ~same).select(c("x.key").alias("key"), c("x.block").alias("i"), c("y.block").alias("j"), *(c(f"{t}.{v}").alias(f"{v}_{t}") for t in "xy" for v in ("low", "high")))
    met = written(met, "roots")
    many = many.join(bits, "rid")
    sides = None
    for side, block, other, some in ((0, "i", "y", met), (1, "j", "x", met.filter("i <> j"))):
        part = many.join(some.withColumn("block", c(block)), ["key", "block"]).filter((100 * c("n") >= percent * c(f"low_{other}")) & (100 * c(f"high_{other}") >= percent * c("n")))
        part = part.select("key", "i", "j", F.lit(side).alias("side"), "rid", "n", "component", "bits")
        sides = part if sides is None else sides.unionByName(part)
    return pairs.unionByName(sides.groupBy("key", "i", "j").applyInArrow(_blocks(percent), "a long, b long"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN, percent: int = PERCENT) -> DataFrame:
    """id, n_shingles, component_id (the least id that links lead to, its own included), a row for each row of docs."""
    texts = written(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("uid", F.monotonically_increasing_id()), "texts")
    signed = written(texts.select("uid", "text").mapInArrow(_signed(run, percent), "uid long, n long, s1 long, s2 long, keys array<long>, bits binary"), "signed")
    of = ["s1", "s2", "n"]
    rows = written(texts.select("uid", "id").join(signed.select("uid", *of), "uid"), "rows")
    sets = written(rows.filter("n > 0").groupBy(*of).agg(F.min("uid").alias("rid"), F.min("id").alias("least")), "sets")
    reps = signed.select(F.col("uid").alias("rid"), "n", "keys", "bits")
    places = _of(reps.filter("size(keys) > 0").select("rid", "keys"), sets.select("rid")).select(F.explode("keys").alias("key"), "rid")
    bucket = Window.partitionBy("key")
    places = places.withColumns({"center": F.min("rid").over(bucket), "last": F.max("rid").over(bucket)})
    places = written(places.filter("center < last").select(F.col("center").alias("key"), "rid").distinct(), "places")
    stars = places.filter("rid <> key").select(F.col("key").alias("a"), F.col("rid").alias("b"))
    links = _links(stars, reps, texts, run, percent)
    # A set belongs with the least one that it is linked to, which is enough to leave most pairs of near copies out.
    near = links.groupBy(F.col("b").alias("rid")).agg(F.min("a").alias("component"))
    near = reps.select("rid", "n").join(near, "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    rows_near = places.join(near, "rid").select("key", "rid", "n", "component")
    links = links.unionByName(_links(_by_trees(rows_near, reps, percent), reps, texts, run, percent))
    found = written(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "components")
    of_node = found.select(F.col("node").alias("rid"), "component")
    joined = sets.join(of_node, "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    named = joined.join(least, "component").select(*of, "component_id")
    full = rows.filter("n > 0").join(named, of).select("id", "n", "component_id")
    empty = rows.filter("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return full.unionByName(empty).withColumnsRenamed({"id": id_col, "n": "n_shingles"})
