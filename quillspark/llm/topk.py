"""Exact top-k inner products by aggregation of sorted lists without random access.

Vectors become integers, floor(scale * x). Candidates are dealt into blocks of
about `block` rows and queries into blocks of about `query_block`. In a block of
candidates every component is a sorted list. For a query the lists are read from
the end that its sign prefers, step by step, all to the same depth. What has
been read of a candidate, with the worst or the best that the unread ends of the
other lists allow, gives its lower and upper bound; only candidates whose upper
bound reaches the k-th largest lower bound stay. Reading stops when the
outsiders' upper bounds are all under that and k stay, whose scores are then
resolved from what is left of the lists; or, where scores are tied or close,
when the lists end, where both bounds are the score. What a depth gives a row is
linear in the query's positive and negative components, so the bounds of all of
a block's queries at that depth are two matrix products.

Each query first meets one block of candidates. The k-th score that it finds
there goes along to the other blocks as a lower bound, so that these return a
row only where it can still count. A last rank decides. Scores are integers, so
the result is exact; ties go to the smaller id.

Vectors that are null or hold null or non-finite components take no part, nor
do rows without id; ids are of any type that has an order. Shorter vectors count
as ending in zeros. Rows that share a query's id are its own rows and no
candidates for it; a query that is repeated is answered once. Components beyond
2**31 after scaling raise an error, as their products might not fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import written


def quantised(vectors: DataFrame, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): rows that take part, v an array of longs."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = lambda c: F.when(F.abs(c * scale) < 2.0**31, F.floor(c * scale).cast("long")).otherwise(F.raise_error(F.lit("a component is too large for exact scores")).cast("long"))
    return vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite).select(F.col(id_col).alias("vec_id"), F.transform(x, whole).alias("v"))


#: Queries whose bounds are in memory at once, and the steps in which lists are read: the shares of them.
TOGETHER, STEPS = 128, (8, 4, 2, 1)


class SortedLists:
    """The lists of one block of candidates: each component's values in order, and each row's place in each list."""

    def __init__(self, v):
        import numpy as np

        self.n, width = v.shape
        order = np.argsort(v, axis=0, kind="stable")
        self.v = v
        self.place = np.empty((self.n, width), dtype=np.int32)
        np.put_along_axis(self.place, order, np.arange(self.n, dtype=np.int32)[:, None], axis=0)
        self.sorted = np.take_along_axis(v, order, axis=0)
        self.read_to: dict[int, tuple] = {}

    def read(self, depth: int):
        """What reading to a depth, from the greatest and from the least value on, leaves to multiply: rows for the upper bound with its edges, and for the lower one."""
        import numpy as np

        if depth not in self.read_to:
            from_top, from_end = self.place >= self.n - depth, self.place < depth
            found = []
            for high, low in ((self.sorted[self.n - depth], self.sorted[depth - 1]), (self.sorted[0], self.sorted[-1])):
                found += [np.hstack([np.where(from_top, self.v - high, 0), np.where(from_end, self.v - low, 0)]), np.concatenate([high, low])]
            self.read_to = {depth: tuple(found)}
        return self.read_to[depth]

    def top(self, queries, others, k: int, floors):
        """For each query (row numbers, scores) of its k best rows and those that tie with them, less the rows `others` of each; of those under its floor some may be left out."""
        import numpy as np

        found = [None] * len(queries)
        split = np.hstack([np.maximum(queries, 0), np.minimum(queries, 0)])
        for share in STEPS:
            open_ = [i for i, f in enumerate(found) if f is None]
            if not open_:
                break
            depth = -(-self.n // share)
            above, edge, below, worst = self.read(depth)
            for a in range(0, len(open_), TOGETHER):
                some = open_[a : a + TOGETHER]
                upper = above @ split[some].T + split[some] @ edge
                lower = below @ split[some].T + split[some] @ worst if depth < self.n else upper.copy()
                for j, i in enumerate(some):
                    mine = np.ones(self.n, dtype=bool)
                    mine[others[i]] = False
                    reached = lower[mine, j]
                    least = np.partition(reached, len(reached) - k)[len(reached) - k] if len(reached) >= k else None
                    least = floors[i] if least is None else least if floors[i] is None else max(least, floors[i])
                    stay = np.flatnonzero(mine if least is None else mine & (upper[:, j] >= least))
                    if len(stay) <= k or depth == self.n:
                        found[i] = stay, self.v[stay] @ queries[i] if depth < self.n else upper[stay, j]
        return found


def _exact(*matrices):
    """The matrices as numbers whose products and sums are exact."""
    import numpy as np

    most = max(m.shape[1] for m in matrices)
    for m in matrices:
        most *= 2 * max(int(np.abs(m).max(initial=0)), 1)
    return [m.astype(np.float64 if most < 1 << 53 else np.int64 if most < 1 << 62 else object) for m in matrices]


def _matrix_of(table, name: str, width: int):
    import numpy as np

    column = table.column(name).combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width), dtype=np.int64)  # no component of one that is shorter
    owner = np.repeat(np.arange(len(lengths)), lengths)
    out[owner, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _answers(k: int, id_type):
    def run(queries, rows):
        import numpy as np
        import pyarrow as pa

        found, asked_by, scores = [], [], []
        ids, query_ids = rows.column("row_id").to_numpy(), queries.column("vec_id").to_numpy()
        if len(ids) and len(query_ids):
            width = max(int(np.diff(c.combine_chunks().offsets.to_numpy()).max()) for c in (queries.column("v"), rows.column("row_v")))
            v, asked = _matrix_of(rows, "row_v", width), _matrix_of(queries, "v", width)
            v, asked = _exact(v, asked)
            floors = queries.column("floor").to_pylist()
            others = [np.flatnonzero(ids == x) for x in query_ids]
            for i, ((at, score), floor) in enumerate(zip(SortedLists(v).top(asked, others, k, floors), floors, strict=True)):
                score = score.astype(np.int64)
                if floor is not None:
                    at, score = at[score >= floor], score[score >= floor]
                order = np.lexsort((ids[at], -score))[:k]
                found.append(at[order])
                asked_by.append(np.full(len(order), i))
                scores.append(score[order])
        found, asked_by, scores = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, dtype=np.int64) for x in (found, asked_by, scores))
        return pa.Table.from_arrays(
            [queries.column("vec_id").take(pa.array(asked_by)).cast(id_type), rows.column("row_id").take(pa.array(found)).cast(id_type), pa.array(scores)], names=["query_id", "vec_id", "score"]
        )

    return run


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, block: int = 8192, query_block: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows for which is_query, a condition on column vec_id, holds."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = vectors.schema[id_col].dataType
    rows = quantised(vectors, scale, id_col, vector_col)
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).first()
    n_blocks, q_blocks = max(1, -(-counts["n"] // block)), max(1, -(-counts["q"] // query_block))
    home = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int")
    queries = rows.filter(is_query).dropDuplicates(["vec_id"]).withColumn("q_block", F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks)).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_blocks)).cast("int"))

    def met(queries, rows):
        rows = rows.select("block", F.col("vec_id").alias("row_id"), F.col("v").alias("row_v"), F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q_block"))
        answers = _answers(k, to_arrow_type(kind))
        return queries.groupBy("block", "q_block").cogroup(rows.groupBy("block", "q_block")).applyInArrow(answers, f"query_id {kind.simpleString()}, vec_id {kind.simpleString()}, score long")

    found = met(queries.withColumn("block", home).withColumn("floor", F.lit(None).cast("long")), rows)
    if n_blocks > 1:
        found = written(found, "topk-first")
        floors = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
        others = queries.join(floors, "vec_id", "left").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).filter(F.col("block") != home)
        found = found.unionByName(met(others, rows))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
