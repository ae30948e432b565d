"""Near-duplicates by BagMinHash signatures, bands and multiset overlap.

A document is the multiset of its runs of five words (lower-cased A-Z, cut at
ASCII white space; a text of fewer words is one run). Two documents are linked
where the weighted Jaccard similarity of these is at least `threshold`; classes
are what links connect, and texts with the same words are of one class anyway.

Signatures. Over the weights of an element, cut into [0, 1), [1, 2), [2, 4), ...,
runs one Poisson process for each dyadic interval, its rate the interval's
length times the number of slots. Of the topmost interval only points under the
weight count. A point has a time, a slot and a position, all hashed from the
element, the interval and the point's number; the first point of each slot over
all elements is the slot's value. Two documents agree in a slot with the
probability of their weighted Jaccard similarity. Processes are followed in
time only until the slots of the document are filled.

Bands. Texts with the same words are one from here on. Four slots are a band, and
the 32 bands find a pair of similarity 0.8 but for 1 in 2*10**7. In a bucket of
up to ALL texts each pair is a candidate; a larger one is dealt out by salt and
gives candidates with the least text and with the one before, which keeps their
number linear. Candidates whose signatures agree too little are left (5 standard
deviations under the threshold). What the others connect is a family. Should a
bucket hold texts of several families, all their pairs are estimated, and those
that agree enough join the candidates.

Overlap. For each text's best candidates the runs are counted, which links most
of a family. Families that links don't connect are dealt out in blocks: texts
outside the family's most frequent component are compared with all others, by
signature, then by counting runs, until no two components have a link. So each
class is what all pairs of all buckets would give, and only links are written.

Null and blank texts have no runs and are of one class. Rows with null ids take
part but never name a class. Repeated rows are copies.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm.common import WordHashes, mix64, written
from quillspark.llm.components import components

SLOTS, BAND = 128, 4
RUN = 5
#: Texts in a bucket up to which all pairs are candidates, to which a larger one is dealt out, and in a block of a family.
ALL, DEALT, BLOCK = 4, 4096, 1024
#: Documents whose signatures are made at once.
TOGETHER = 250
_GOLDEN = 0x9E3779B97F4A7C15


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8").lower().split() if text else []


def runs_of(words: list[bytes], hashes: WordHashes, run: int = RUN):
    """(hashes, counts) of the runs of a text, hashes ascending."""
    import numpy as np

    if not words:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    n = max(1, len(h) - run + 1)
    out = np.full(n, len(h) if len(h) < run else run, dtype=np.uint64)
    for i in range(min(run, len(h))):
        out = (out ^ h[i : i + n]) * np.uint64(_GOLDEN)
        out ^= out >> np.uint64(29)
    return np.unique(mix64(out), return_counts=True)


def signatures(owner, element, weight, n_docs: int, slots: int = SLOTS):
    """BagMinHash of n_docs bags given as entries (owner, element, weight): uint16 array (n_docs, slots). Bags must not be empty."""
    import numpy as np

    total = np.bincount(owner, weight, n_docs)
    blocks = []
    top = int(weight.max()).bit_length() if len(weight) else 0
    for j in range(top + 1):
        low = 0 if j == 0 else 1 << (j - 1)
        size = 1 if j == 0 else low
        at = np.flatnonzero(weight > low)
        if len(at):
            seed = mix64(element[at] + np.uint64((j + 1) * _GOLDEN & (2**64 - 1)))
            blocks.append((owner[at], seed, np.full(len(at), float(size)), np.minimum((weight[at] - low) / size, 1.0)))
    who, seed, size, covered = (np.concatenate(x) for x in zip(*blocks, strict=True))
    first = np.full(n_docs * slots, np.inf)
    value = np.zeros(n_docs * slots, dtype=np.uint16)
    limit = (math.log(slots) + 4) / total
    todo = np.ones(n_docs, dtype=bool)
    while todo.any():
        mine = todo[who]
        d, s, rate, part = who[mine], seed[mine], size[mine] * slots, covered[mine]
        t = np.zeros(len(d))
        found, k = [], 0
        while len(d):
            k += 1
            r = mix64(s + np.uint64(k * _GOLDEN & (2**64 - 1)))
            t = t - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
            live = t <= limit[d]
            d, s, rate, part, t, r = d[live], s[live], rate[live], part[live], t[live], r[live]
            if len(d):
                r = mix64(r ^ np.uint64(_GOLDEN))
                inside = (r >> np.uint64(40)).astype(np.float64) * 2.0**-24 < part
                key = d * slots + (r & np.uint64(0xFFFF)).astype(np.int64) % slots
                found.append((key[inside], t[inside], (r >> np.uint64(16)).astype(np.uint16)[inside]))
        if found:
            key, at, mark = (np.concatenate(x) for x in zip(*found, strict=True))
            np.minimum.at(first, key, at)
            least = at == first[key]
            value[key[least]] = mark[least]
        todo = np.isinf(first.reshape(n_docs, slots)).any(axis=1)
        limit[todo] *= 3
    return value.reshape(n_docs, slots)


def text_id(words: list[bytes]) -> int:
    """A signed 64-bit number of a text's words."""
    import xxhash

    return int.from_bytes(xxhash.xxh3_64_digest(b" ".join(words)), "big", signed=True)


def _signed(batches):
    import numpy as np
    import pyarrow as pa

    hashes = WordHashes()
    for batch in batches:
        ids, texts = batch.column("id"), batch.column("text").to_pylist()
        for a in range(0, len(texts), TOGETHER):
            names, owners, elements, weights, full = [], [], [], [], []
            for i, text in enumerate(texts[a : a + TOGETHER]):
                words = words_of(text)
                names.append(text_id(words))
                if words:
                    e, w = runs_of(words, hashes)
                    owners.append(np.full(len(e), len(full)))
                    elements.append(e)
                    weights.append(w)
                    full.append(i)
            out = [None] * len(names)
            if full:
                s = signatures(np.concatenate(owners), np.concatenate(elements), np.concatenate(weights), len(full))
                for i, row in zip(full, s, strict=True):
                    out[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays([ids.slice(a, TOGETHER), pa.array(names, pa.int64()), pa.array(out, pa.binary())], names=["id", "rid", "sig"])


def _banded(batches):
    """(bucket, rid) for each band of each signature."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        rid = batch.column("rid").to_numpy(zero_copy_only=False)
        for a in range(0, len(rid), 4000):
            sig = np.frombuffer(b"".join(batch.column("sig").slice(a, 4000).to_pylist()), dtype=np.uint64).reshape(-1, SLOTS // BAND)
            keys = mix64(sig + (np.arange(1, SLOTS // BAND + 1, dtype=np.uint64) * np.uint64(_GOLDEN))[None, :])
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(rid[a : a + 4000], SLOTS // BAND))], names=["bucket", "rid"])


def _paired(batches):
    """Candidates (a, b), a < b, of rows sorted by (bucket, salt, rid)."""
    import numpy as np
    import pyarrow as pa

    def batch_of(a, b):
        a, b = np.concatenate(a), np.concatenate(b)
        keep = a != b
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[keep]), pa.array(np.maximum(a, b)[keep])], names=["a", "b"])

    left = None  # of the bucket that the last batch ended in: its key, its first rows, its last row, its size
    for batch in batches:
        bucket, salt, rid = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("bucket", "salt", "rid"))
        if not len(bucket):
            continue
        starts = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (salt[1:] != salt[:-1])]))
        sizes = np.diff(np.append(starts, len(bucket)))
        out_a, out_b = [], []

        def add(head, last, size, new):
            """Pairs of the rows `new` of a bucket that has begun with `head`, whose last rows are `last`."""
            room = new[: max(0, ALL - size)]
            if len(room):
                old = np.concatenate([head, room])
                i, j = np.triu_indices(len(old), 1)
                fresh = j >= len(head)
                out_a.append(old[i[fresh]])
                out_b.append(old[j[fresh]])
                head = old
            rest = new[len(room) :]
            if len(rest):
                line = np.concatenate([last, room, rest])[-(len(rest) + 1) :]
                out_a.append(line[:-1])
                out_b.append(line[1:])
                out_a.append(np.full(len(rest), head[0]))
                out_b.append(rest)
            return head, np.concatenate([last, new])[-1:], size + len(new)

        first = 0
        empty = np.zeros(0, dtype=np.int64)
        if left is not None and left[0] == (bucket[0], salt[0]):
            state = add(*left[1:], rid[: sizes[0]])
            left = ((bucket[0], salt[0]), *state)
            first = 1
        inner = slice(first, len(starts) - (1 if len(starts) > first else 0))  # the last bucket may go on
        for size in np.unique(sizes[inner]):
            if size > 1:
                at = starts[inner][sizes[inner] == size]
                if size <= ALL:
                    rows = rid[at[:, None] + np.arange(size)]
                    i, j = np.triu_indices(size, 1)
                    out_a.append(rows[:, i].ravel())
                    out_b.append(rows[:, j].ravel())
                else:
                    for s in at:
                        add(empty, empty, 0, rid[s : s + size])
        if len(starts) > first:
            s = starts[-1]
            left = ((bucket[s], salt[s]), *add(empty, empty, 0, rid[s:]))
        if out_a:
            yield batch_of(out_a, out_b)


def _agreeing(least: float):
    """(a, b, agree): the pairs whose signatures agree in a share of at least `least` of the slots."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(n).to_pylist()), dtype=np.uint16).reshape(-1, SLOTS) for n in ("sig_a", "sig_b"))
            agree = (x == y).mean(axis=1)
            keep = pa.array(agree >= least)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(agree)], names=["a", "b", "agree"]).filter(keep)

    return run


def _across(least: float, threshold: float | None):
    """Pairs (a, b) across components of rows (g, i, j, away, rid, component, sig, bag), sorted by these: in a block those marked away come first and are compared with the others that follow.

    Without a threshold these are the pairs whose signatures agree enough; with one the links among them, of which
    one for each text and component is as good as all.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def links(r, c, s, bag, rows):
            rid, component, sig, bags = rows
            agree = (sig == s).mean(axis=1)
            hit = np.flatnonzero((component != c) & (agree >= least))
            if threshold is None:
                return hit
            met, found = set(), []
            for k in hit[np.argsort(-agree[hit], kind="stable")].tolist():
                if component[k] not in met:
                    both, union = overlap(bag, bags[k])
                    if both >= threshold * union - 1e-9:
                        met.add(component[k])
                        found.append(k)
            return np.array(found, dtype=np.int64)

        at, parts = None, []
        for batch in batches:
            keys = list(zip(*(batch.column(n).to_pylist() for n in ("g", "i", "j")), strict=True))
            away = np.array(batch.column("away").to_pylist(), dtype=bool)
            rid, component = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("rid", "component"))
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), dtype=np.uint16).reshape(-1, SLOTS)
            bags = [None if x is None else _unpacked(x) for x in batch.column("bag").to_pylist()]
            first = 0
            while first < len(keys):
                last = first
                while last < len(keys) and keys[last] == keys[first] and away[last] == away[first]:
                    last += 1
                rows = rid[first:last], component[first:last], sig[first:last], bags[first:last]
                if keys[first] != at:
                    at, parts = keys[first], []
                if away[first]:
                    parts.append(rows)
                else:
                    for part in parts:
                        for r, c, s, bag in zip(*part, strict=True):
                            hit = links(r, c, s, bag, rows)
                            if len(hit):
                                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(rows[0][hit], r)), pa.array(np.maximum(rows[0][hit], r))], names=["a", "b"])
                first = last

    return run


def _packed(bag) -> bytes:
    return bag[0].tobytes() + bag[1].astype("<u4").tobytes()


def _unpacked(data: bytes):
    import numpy as np

    n = len(data) // 12
    return np.frombuffer(data, dtype=np.uint64, count=n), np.frombuffer(data, dtype="<u4", offset=8 * n).astype(np.int64)


def _bags(batches):
    import pyarrow as pa

    hashes = WordHashes()
    for batch in batches:
        bags = [_packed(runs_of(words_of(t), hashes)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("rid"), pa.array(bags, pa.binary())], names=["rid", "bag"])


def _compared(rows: DataFrame, texts: DataFrame, size: int, least: float, threshold: float | None, bags: DataFrame | None = None) -> DataFrame:
    """Pairs across components of rows (g, rid, component), each g dealt out in blocks of about size texts by size texts."""
    shares = rows.groupBy("g", "component").agg(F.count(F.lit(1)).alias("n"))
    sizes = shares.groupBy("g").agg(F.count(F.lit(1)).alias("parts"), F.max_by("component", F.struct("n", "component")).alias("home"), F.sum("n").alias("n")).filter("parts > 1")
    mixed = written(rows.join(sizes.select("g", "home", "n"), "g").withColumn("away", F.col("component") != F.col("home")), "mixed")
    aways = mixed.groupBy("g").agg(F.count_if("away").alias("m"))
    blocks = lambda c: F.ceil(F.col(c) / size).cast("int")
    mixed = mixed.join(aways, "g").select("g", "rid", "component", "away", blocks("n").alias("ni"), blocks("m").alias("nj")).join(texts.select("rid", "sig"), "rid")
    mixed = mixed.join(bags, "rid") if bags is not None else mixed.withColumn("bag", F.lit(None).cast("binary"))
    row, column = (F.pmod(F.xxhash64("rid"), F.col(n)).cast("int") for n in ("ni", "nj"))
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    # Each text is in the blocks of its row; one that is away also, and first, in those of its column.
    places = F.concat(
        F.transform(every("nj"), lambda j: F.struct(row.alias("i"), j.alias("j"), F.lit(False).alias("away"))),
        F.when(F.col("away"), F.transform(every("ni"), lambda i: F.struct(i.alias("i"), column.alias("j"), F.lit(True).alias("away")))).otherwise(F.array().cast("array<struct<i:int,j:int,away:boolean>>")),
    )
    dealt = mixed.select("g", F.explode(places).alias("p"), "rid", "component", "sig", "bag")
    dealt = dealt.select("g", "p.i", "p.j", "p.away", "rid", "component", "sig", "bag").repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", F.desc("away"), "rid")
    return dealt.mapInArrow(_across(least, threshold), "a long, b long").distinct()


def overlap(x, y) -> tuple[int, int]:
    """Sizes of the intersection and the union of two multisets as runs_of gives them."""
    import numpy as np

    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(x[1][i], y[1][j]).sum())
    return both, int(x[1].sum() + y[1].sum()) - both


def _verified(threshold: float):
    def run(batches):
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            keep, known = [], {}
            for a, b, text_a, text_b in zip(*(batch.column(n).to_pylist() for n in ("a", "b", "text_a", "text_b")), strict=True):
                bags = []
                for r, t in ((a, text_a), (b, text_b)):
                    if r not in known:
                        if len(known) >= 64:
                            known.clear()
                        known[r] = runs_of(words_of(t), hashes)
                    bags.append(known[r])
                both, union = overlap(*bags)
                keep.append(both >= threshold * union - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _named(batches):
    import pyarrow as pa

    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text"), pa.array([text_id(words_of(t)) for t in batch.column("text").to_pylist()], pa.int64())], names=["id", "text", "rid"])


def _classes(docs: DataFrame, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """(id, rid, component, class_id), one row per row of docs; classes that share a class_id, or have none, differ in component."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    signed = written(rows.mapInArrow(_signed, f"id {kind}, rid long, sig binary"), "signatures")
    texts = written(signed.filter("sig is not null").groupBy("rid").agg(F.min("id").alias("id"), F.first("sig").alias("sig")), "texts")
    least = threshold - 5 * math.sqrt(threshold * (1 - threshold) / SLOTS)

    bands = texts.select("rid", "sig").mapInArrow(_banded, "bucket long, rid long")
    shared = written(bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")
    members = written(bands.join(shared, "bucket").withColumn("salt", F.when(F.col("n") > DEALT, F.pmod(F.xxhash64("rid"), F.ceil(F.col("n") / DEALT))).otherwise(0).cast("int")), "members")
    # The least text of each salt of a bucket meets those of the others in a bucket of their own.
    heads = members.filter(F.col("n") > DEALT).groupBy("bucket", "salt").agg(F.min("rid").alias("rid")).select(F.xxhash64("bucket").alias("bucket"), "rid", F.lit(-1).alias("salt"))
    dealt = members.select("bucket", "rid", "salt").unionByName(heads)
    pairs = dealt.repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "rid").mapInArrow(_paired, "a long, b long").distinct()

    def estimated(pairs):
        x, y = (texts.select(F.col("rid").alias(n), F.col("sig").alias(f"sig_{n}")) for n in "ab")
        return pairs.join(x, "a").join(y, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(_agreeing(least), "a long, b long, agree double")

    candidates = written(estimated(pairs), "candidates")
    families = written(components(candidates.select(F.col("a").alias("u"), F.col("b").alias("v"))), "families")
    crowded = members.filter(F.col("n") > ALL).select(F.col("bucket").alias("g"), "rid").join(families.withColumnRenamed("node", "rid"), "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    more = written(_compared(crowded, texts, DEALT, least, None), "candidates")
    if not more.isEmpty():
        candidates = written(candidates.unionByName(estimated(more)), "candidates")
        families = written(components(candidates.select(F.col("a").alias("u"), F.col("b").alias("v"))), "families")

    # One row of the documents for each text of a family, however many copies it has.
    asked = families.select(F.col("node").alias("rid")).join(texts.select("rid", "id"), "rid")
    named = rows.mapInArrow(_named, f"id {kind}, text string, rid long")
    sources = written(
        named.alias("t").join(asked.alias("q"), (F.col("t.rid") == F.col("q.rid")) & F.col("t.id").eqNullSafe(F.col("q.id"))).select("t.rid", "t.text").dropDuplicates(["rid"]), "sources"
    )
    best = lambda side: Window.partitionBy(side).orderBy(F.desc("agree"), "a", "b")
    first = candidates.withColumn("rank", F.least(F.row_number().over(best("a")), F.row_number().over(best("b")))).filter("rank <= 2")
    x, y = (sources.select(F.col("rid").alias(n), F.col("text").alias(f"text_{n}")) for n in "ab")
    links = written(first.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "text_a", "text_b").mapInArrow(_verified(threshold), "u long, v long"), "verified")
    found = written(components(links), "components")
    known = families.select(F.col("component").alias("g"), F.col("node").alias("rid")).join(found.withColumnRenamed("node", "rid"), "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    more = _compared(known, texts, BLOCK, least, threshold, sources.mapInArrow(_bags, "rid long, bag binary"))
    more = written(more.select(F.col("a").alias("u"), F.col("b").alias("v")), "verified")
    if not more.isEmpty():
        found = written(components(links.unionByName(more)), "components")

    placed = signed.select("id", "rid").join(found.withColumnRenamed("node", "rid"), "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    # Both are written first, so that their join has two shuffled sides, of which Spark can split a large class's.
    placed = written(placed, "placed")
    texts_of = placed.groupBy("component", "rid").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    classes = written(texts_of.groupBy("component").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n_texts"), F.sum("n").alias("n_docs")), "classes")
    return placed.join(classes, "component").select("id", "rid", "component", "class_id", "n_texts", "n_docs")


def near_duplicates(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, rid, class_id, n_texts, n_docs), one row per row of docs: the number of its words' text, the least id of its class, and how many different texts and documents the class has."""
    return _classes(docs, threshold, id_col, text_col).select(F.col("id").alias(id_col), "rid", "class_id", "n_texts", "n_docs")


def _with_rid(text_col: str, rid_col: str):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rid = pa.array([text_id(words_of(t)) for t in batch.column(text_col).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, rid], names=[*batch.schema.names, rid_col])

    return run


def _free(name: str, columns: list[str]) -> str:
    """The name, with marks before it while a column has it, in whatever case."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name = "~" + name
    return name


def one_of_each(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose ids name their classes, one row for each class, of several texts with that id the one of least rid; a class that has no id keeps a row without."""
    rid, place = (_free(n, docs.columns) for n in ("~rid", "~key"))
    schema = T.StructType([*docs.schema.fields, T.StructField(rid, T.LongType())])
    found = _classes(docs, threshold, id_col, text_col)
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    kept = found.filter(F.col("id").eqNullSafe(F.col("class_id"))).groupBy("component", key("id").alias(place)).agg(F.min("rid").alias(rid)).select(place, rid)
    named = docs.mapInArrow(_with_rid(text_col, rid), schema).withColumn(place, key(id_col))
    return named.join(kept, [place, rid], "left_semi").dropDuplicates([place, rid]).select(*docs.columns)
