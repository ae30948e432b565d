"""Benchmark decontamination with a hash set of normalised test n-grams.

Words are lower-cased A-Z and cut at ASCII characters that are neither letters
nor digits. A benchmark window is `n` consecutive words of an item; an item of
fewer words, but not none, is one window. Words are numbered by the windows'
vocabulary, so that only runs of known words are hashed; each window whose hash
is in the set is then compared word for word.

The windows are broadcast in blocks of at most `block_words` words. One block
is the rule, as test sets are small; of a larger one each block is met by a pass
over the documents, which is written before the next block is sent and the last
one freed; hits are united by document. Null texts have no words, repeated rows
are rows of their own, and documents of any length are worked on whole. Items
with a null id have windows that are hit like others, but name no item, so
n_items and items_sha256 leave them out. Empty tables give no hits, or no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import written

_KEPT = bytes(c | 0x20 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))
#: Words of benchmark windows that one broadcast holds: about 100 MB in a worker.
BLOCK_WORDS = 4_000_000


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(_KEPT).split() if text else []


class NgramSet:
    """Windows of several lengths over word numbers, found by hash and verified word for word."""

    def __init__(self, windows: dict[tuple[bytes, ...], list[str]]):
        import numpy as np

        self.vocabulary: dict[bytes, int] = {}
        for w in windows:
            for x in w:
                self.vocabulary.setdefault(x, len(self.vocabulary) + 1)
        self.items, self.tables = [], []
        by_length: dict[int, list[tuple[bytes, ...]]] = {}
        for w in windows:
            by_length.setdefault(len(w), []).append(w)
        for length, ws in sorted(by_length.items()):
            table = np.array([[self.vocabulary[x] for x in w] for w in ws], dtype=np.int64)
            seed = 1
            while len(np.unique(h := self.hashed(table.T, seed))) < len(ws):
                seed += 2
            order = np.argsort(h)
            self.tables.append((length, seed, h[order], table[order], len(self.items)))
            self.items += [windows[ws[i]] for i in order]

    @classmethod
    def of(cls, state) -> NgramSet:
        """From what vars() gave; broadcasts hold that, as their classes would have to be on the workers."""
        out = cls.__new__(cls)
        vars(out).update(state)
        return out

    @staticmethod
    def hashed(columns, seed: int):
        import numpy as np

        h = np.full(len(columns[0]), seed, dtype=np.uint64)
        for c in columns:
            h = (h ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    def find(self, ids):
        """(starts, lengths, window numbers) of the windows in an array of word numbers, where 0 is no word of any window."""
        import numpy as np

        unknown = np.concatenate([[0], np.cumsum(ids == 0)])
        found = []
        for length, seed, hashes, table, first in self.tables:
            if len(ids) < length:
                continue
            at = np.flatnonzero(unknown[length:] == unknown[:-length])
            if not len(at):
                continue
            h = self.hashed([ids[at + j] for j in range(length)], seed)
            k = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            same = hashes[k] == h
            at, k = at[same], k[same]
            same = np.ones(len(at), dtype=bool)
            for j in range(length):
                same &= ids[at + j] == table[k, j]
            found.append((at[same], np.full(same.sum(), length), k[same] + first))
        return [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, dtype=np.int64)] * 3


def benchmark_windows(benchmark: DataFrame, n: int, item_col: str, text_col: str) -> DataFrame:
    """(item, window): the distinct windows of each item, words joined by spaces."""

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            items, out = [], []
            for item, text in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                w = words_of(text)
                for x in dict.fromkeys(b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1)) if w):
                    items.append(item)
                    out.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(out, pa.binary())], names=["item", "window"])

    return benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).mapInArrow(cut, "item string, window binary")


def ngram_sets(benchmark: DataFrame, n: int = 10, item_col: str = "item_id", text_col: str = "text", block_words: int = BLOCK_WORDS):
    """The windows in sets of at most block_words words; the driver holds one set at a time. Yields none for an empty benchmark."""
    windows = benchmark_windows(benchmark, n, item_col, text_col).groupBy("window").agg(F.collect_set("item").alias("items"))
    if windows.isEmpty():
        return
    block, words = {}, 0
    for row in windows.toLocalIterator():
        w = tuple(bytes(row.window).split(b" "))
        block[w] = sorted(row["items"])
        words += len(w) + len(row["items"])
        if words >= block_words:
            yield NgramSet(block)
            block, words = {}, 0
    if block:
        yield NgramSet(block)


def _hits(sent):
    """For each row: id, number of words, merged hit ranges as word positions, items."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        known = NgramSet.of(sent.value) if sent is not None else None
        for batch in batches:
            ids, texts = batch.column("id"), batch.column("text").to_pylist()
            n_words, numbers, bounds = [], [], [0]
            get = known.vocabulary.get if known else None
            out = [([], [], []) for _ in texts]

            def close(first, numbers=numbers, bounds=bounds, out=out):
                if not numbers:
                    return
                starts, lengths, windows = known.find(np.array(numbers, dtype=np.int64))
                rows = np.searchsorted(np.array(bounds), starts, side="right") - 1
                for i in np.argsort(starts, kind="stable").tolist():
                    r = int(rows[i])
                    a = int(starts[i]) - bounds[r]
                    b = a + int(lengths[i])
                    s, e, items = out[first + r]
                    if s and a <= e[-1]:
                        e[-1] = max(e[-1], b)
                    else:
                        s.append(a)
                        e.append(b)
                    items.append(int(windows[i]))
                numbers.clear()
                bounds[:] = [0]

            first = 0
            for i, text in enumerate(texts):
                w = words_of(text)
                n_words.append(len(w))
                if known:
                    numbers += [get(x, 0) for x in w]
                    numbers.append(0)  # windows don't cross documents
                    bounds.append(len(numbers))
                    if len(numbers) > 500_000:
                        close(first)
                        first = i + 1
            if known:
                close(first)
            named = [sorted({x for k in set(items) for x in known.items[k] if x is not None}) if items else [] for _, _, items in out]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n_words, pa.int64()), pa.array([s for s, _, _ in out], pa.list_(pa.int64())), pa.array([e for _, e, _ in out], pa.list_(pa.int64())), pa.array(named, pa.list_(pa.string()))],
                names=["id", "n_words", "starts", "ends", "items"],
            )

    return run


_SCHEMA = "n_words long, starts array<long>, ends array<long>, items array<string>"


def _united():
    """The ranges and items that several blocks found in one document, merged."""
    ranges = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))))
    merged = F.aggregate(
        ranges,
        F.expr("cast(array() as array<struct<starts:bigint,ends:bigint>>)"),
        lambda acc, r: F.when(
            (F.size(acc) > 0) & (r["starts"] <= F.element_at(acc, -1)["ends"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["starts"].alias("starts"), F.greatest(F.element_at(acc, -1)["ends"], r["ends"]).alias("ends")))),
        ).otherwise(F.concat(acc, F.array(r))),
    )
    return merged, F.array_sort(F.array_distinct(F.flatten(F.collect_list("items"))))


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of docs: id, n_words, n_hit, n_items, items_sha256, contaminated, and the hit word ranges starts and ends (exclusive)."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sets = ngram_sets(benchmark, n, item_col, text_col, block_words)
    state, following = next(sets, None), next(sets, None)
    sent = None if state is None else spark.sparkContext.broadcast(vars(state))
    if following is None:
        found = rows.mapInArrow(_hits(sent), f"id {kind}, {_SCHEMA}")
    else:
        # A row is known by its id and text, of which copies all have the same hits.
        keyed = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("h")).alias("id"), F.col(text_col).alias("text"))
        parts, i = None, 0
        while sent is not None:
            part = written(keyed.mapInArrow(_hits(sent), f"id struct<id:{kind},h:bigint>, {_SCHEMA}").withColumn("part", F.lit(i)), "hits")
            sent.destroy()
            sent = None if following is None else spark.sparkContext.broadcast(vars(following))
            following, i = next(sets, None), i + 1
            parts = part if parts is None else parts.unionByName(part)
        merged, items = _united()
        united = parts.groupBy("id").agg(
            F.first("n_words").alias("n_words"), merged.alias("ranges"), items.alias("items"), F.count_if(F.col("part") == 0).cast("int").alias("rows")
        )
        united = united.select(F.explode(F.sequence(F.lit(1), F.col("rows"))), "*").select("id.id", "n_words", F.col("ranges.starts").alias("starts"), F.col("ranges.ends").alias("ends"), "items")
        found = united
    hit = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    return found.select(
        F.col("id").alias(id_col),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
        "starts",
        "ends",
    )


def _filtered(docs: DataFrame, sets, text_col: str, drop: bool) -> DataFrame:
    context = docs.sparkSession.sparkContext
    state = next(sets, None)
    while state is not None:
        sent = context.broadcast(vars(state))
        docs = docs.mapInArrow(_filter(sent, text_col, drop), docs.schema)
        state = next(sets, None)
        if state is not None:
            docs = written(docs, "filtered")
            sent.destroy()
    return docs


def without_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 10, text_col: str = "text", item_col: str = "item_id", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of docs in which no window occurs."""
    return _filtered(docs, ngram_sets(benchmark, n, item_col, text_col, block_words), text_col, drop=True)


def without_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10, text_col: str = "text", item_col: str = "item_id", block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs with the hit words, and what is between them, cut out of their texts."""
    return _filtered(docs, ngram_sets(benchmark, n, item_col, text_col, block_words), text_col, drop=False)


def cut_ranges(text: str, starts: list[int], ends: list[int]) -> str:
    import re

    data = text.encode("utf-8")
    places = [m.span() for m in re.finditer(rb"[^\x20]+", data.translate(_KEPT))]
    out, at = [], 0
    for a, b in zip(starts, ends, strict=True):
        out.append(data[at : places[a][0]])
        at = places[b - 1][1]
    return (b"".join(out) + data[at:]).decode("utf-8")


def _filter(sent, text_col: str, drop: bool):
    hits = _hits(sent)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            asked = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows), pa.int64()), batch.column(text_col)], names=["id", "text"])
            found = next(hits(iter([asked])))
            starts, ends = found.column("starts").to_pylist(), found.column("ends").to_pylist()
            if drop:
                yield batch.filter(pa.array([not s for s in starts], pa.bool_()))
                continue
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns[text_col] = pa.array([cut_ranges(t, s, e) if s else t for t, s, e in zip(columns[text_col].to_pylist(), starts, ends, strict=True)], batch.schema.field(text_col).type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)

    return run
