import random
from collections import defaultdict

from pyspark.sql import functions as F

from quillspark.llm import mixing as M


def targets(sizes):
    """By raising the level until nothing is left to share."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, held = sum(sizes.values()), {}
    while True:
        left = total - sum(held.values())
        free = [s for s in sizes if s not in held]
        w = sum(weight[s] for s in free)
        share = {s: weight[s] * left / w for s in free} if w else {}
        over = [s for s in free if share[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return {**held, **share}
        held |= {s: 3 * sizes[s] for s in over}


def corpus(n=1500, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        source = r.choice([*["hot"] * 6, "a", "b", "c", "é", "𝄞", "", None])
        k = r.choice([0, 1, 1, 5, r.randint(0, 60), 300 if r.random() < 0.05 else 3])
        rows.append((i, None if r.random() < 0.02 else " \t".join("w" * r.randint(1, 3) for _ in range(k)), source))
    return rows


def check(rows, out):
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len((t or "").split())
    want = targets(dict(size))
    assert len(out) == len(rows)
    taken, longest = defaultdict(int), defaultdict(int)
    for r in out:
        assert r["source_size"] == size[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    for s in size:
        assert abs(taken[s] - want[s]) <= 2 * longest[s] + 1e-6


def test_targets_and_words_taken(spark, docs_of):
    rows = corpus()
    out = M.mix(docs_of(rows).repartition(5)).collect()
    check(rows, out)
    again = M.mix(docs_of(rows[::-1]).repartition(3)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_small_sources_stop_at_three_times(spark, docs_of):
    rows = [(0, "a", "a"), (1, "a b", "b"), *((i, "x y z " * 40, "big") for i in range(2, 30))]
    check(rows, M.mix(docs_of(rows)).collect())


def test_null_and_repeated_ids(spark, docs_of):
    rows = [*corpus(300, 2), (None, "a b", "a"), (None, "a b", "a"), (5, "a b", "a"), (-4, "a b", "a")]
    check(rows, M.mix(docs_of(rows)).collect())


def test_emitted_rows_are_those_taken(spark, docs_of):
    rows = corpus(400, 3)
    d = docs_of(rows).withColumnRenamed("lang", "copies")
    want = {r["doc_id"]: r["copies"] for r in M.mix(d).collect()}
    got = defaultdict(int)
    e = M.emitted(d)
    assert e.columns == d.columns
    for r in e.collect():
        got[r["doc_id"]] += 1
    assert dict(got) == {i: c for i, c in want.items() if c}


def test_ids_of_other_types_and_one_source(spark, docs_of):
    rows = [(i, "a b c " * (i % 7), "only") for i in range(120)]
    d = docs_of(rows).withColumn("doc_id", F.concat(F.lit("id-"), "doc_id"))
    out = M.mix(d).collect()
    assert {r["doc_id"] for r in out} == {f"id-{i}" for i, _, _ in rows}
    # The only source has all words as its target, and each document is taken once.
    assert all(r["copies"] == 1 for r in out)


def test_copies_follow_the_offset(spark, docs_of):
    """A document is taken as often as target / size says, or once more; which ones are is the offset's choice."""
    d = docs_of([(0, "a b", "a"), *((i, "x y", "b") for i in range(1, 6)), *((i, "x y", "c") for i in range(6, 16))])
    rate = {"a": 32 / 6 / 2, "b": 32 / 3 / 10, "c": 32 / 2 / 20}
    taken = set()
    for k in range(4):
        out = M.mix(d, seed=f"{k}:").collect()
        assert all(int(rate[r["source"]]) <= r["copies"] <= int(rate[r["source"]]) + 1 for r in out)
        taken.add(tuple(sorted((r["doc_id"], r["copies"]) for r in out)))
    assert len(taken) > 1


def test_more_sources_than_one_task_orders(spark, docs_of, monkeypatch):
    rows = corpus(300, 4)
    want = sorted(map(str, M.mix(docs_of(rows)).collect()))
    monkeypatch.setattr(M, "FEW_SOURCES", 2)
    assert sorted(map(str, M.mix(docs_of(rows)).collect())) == want


def test_nothing(spark, docs_of):
    assert M.mix(docs_of([])).count() == 0
    assert [r["taken"] for r in M.mix(docs_of([None, "", " "])).collect()] == [0, 0, 0]
