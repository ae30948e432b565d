import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from quillspark.llm import minhash as M
from quillspark.llm.common import WordHashes
from quillspark.llm.components import components


def bag(text):
    w = (text or "").encode().lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if both else 0.0


def brute(rows):
    """Least id of each row's class."""
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    by_words = {}
    for i, t in rows:
        by_words.setdefault(" ".join((t or "").lower().split()), []).append(i)
    ids = [min(v) for v in by_words.values()]
    bags = {min(v): bag(k) for k, v in by_words.items()}
    for v in by_words.values():
        for i in v:
            parent[root(i)] = root(min(v))
    for a, b in combinations(sorted(ids), 2):
        if similarity(bags[a], bags[b]) >= 0.8:
            parent[root(b)] = root(a)
    least = {}
    for i, _ in rows:
        least[root(i)] = min(i, least.get(root(i), i))
    return {i: least[root(i)] for i, _ in rows}


def corpus(seed, families=25):
    r = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(400)]
    rows = []
    for _ in range(families):
        base = [r.choice(vocabulary) for _ in range(r.choice([3, 5, 8, 30, 80, 300]))]
        if r.random() < 0.2:
            base = base[:10] * 30
        for _ in range(r.randint(1, 6)):
            t = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 5])):
                t[r.randrange(len(t))] = r.choice(vocabulary)
            rows.append(" ".join(t) if r.random() < 0.8 else "  ".join(t).upper())
    r.shuffle(rows)
    return list(enumerate(rows))


def test_classes_are_those_of_all_pairs(spark, docs_of):
    for seed in (1, 2):
        rows = [*corpus(seed), (9001, None), (9002, ""), (9003, " \n")]
        got = {r["doc_id"]: r["class_id"] for r in M.near_duplicates(docs_of(rows)).collect()}
        assert got == brute(rows)


def test_crowded_buckets(spark, docs_of, monkeypatch):
    monkeypatch.setattr(M, "ALL", 3)
    monkeypatch.setattr(M, "DEALT", 6)
    monkeypatch.setattr(M, "BLOCK", 5)
    r = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        t = list(base)
        if i % 2:
            t[60:] = [f"v{k}" for k in range(60)]
        t[r.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(t)))
    got = {x["doc_id"]: x["class_id"] for x in M.near_duplicates(docs_of(rows)).collect()}
    assert got == brute(rows)


def test_signatures_estimate_weighted_similarity():
    r = random.Random(3)
    pairs = []
    for _ in range(120):
        a = Counter({r.randrange(60): r.choice([1, 1, 2, 5, 40]) for _ in range(40)})
        b = Counter({k: v if r.random() < 0.7 else r.choice([1, 3, 9]) for k, v in a.items() if r.random() < 0.9})
        pairs.append((a, b))
    owner, element, weight = [], [], []
    for i, c in enumerate(x for p in pairs for x in p):
        for k, v in c.items():
            owner.append(i)
            element.append(hash(("e", k)) % 2**63)
            weight.append(v)
    s = M.signatures(np.array(owner), np.array(element, dtype=np.uint64), np.array(weight), 2 * len(pairs), 256)
    errors = [(s[2 * i] == s[2 * i + 1]).mean() - similarity(a, b) for i, (a, b) in enumerate(pairs)]
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.045


def test_runs_and_overlap():
    h = WordHashes()
    a, b = (M.runs_of(M.words_of(t), h) for t in ("a b c d e f a b c d e", "a b c d e x"))
    assert M.overlap(a, b) == (1, 7 + 2 - 1)
    assert M.overlap(a, a) == (7, 7)


def test_repeated_ids_null_ids_extra_columns(spark, docs_of):
    rows = [(1, "a b c d e f g"), (1, "z y x w v u"), (None, "a b c d e f g"), (None, "q q q q q"), (3, "Z y x w v u")]
    d = docs_of(rows).withColumnRenamed("lang", "sig").withColumnRenamed("source", "rid")
    d = d.selectExpr("*", "1 as `~RID`", "'x' as `~key`")
    out = sorted(((r["doc_id"], r["class_id"]) for r in M.near_duplicates(d).collect()), key=str)
    assert out == sorted([(1, 1), (1, 1), (None, 1), (None, None), (3, 1)], key=str)
    kept = M.one_of_each(d)
    assert kept.schema == d.schema
    assert sorted(map(str, (r["text"] for r in kept.collect()))) == ["a b c d e f g", "q q q q q", "z y x w v u"]
    assert M.near_duplicates(docs_of([])).count() == 0 and M.one_of_each(docs_of([])).count() == 0


def test_components(spark):
    r = random.Random(8)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(40)] + [(500, 501 + i) for i in range(30)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: root(n) for e in edges if e[0] != e[1] for n in e}


def test_one_of_each_with_null_or_repeated_ids(spark, docs_of):
    """A class keeps one row, though all its ids are null or stand on several texts; classes with the same id keep one each."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(200)) for x in "abc")
    rows = [(None, a), (None, f"{a} end"), (7, b), (7, f"{b} end"), (9, b), (7, c), (None, c)]
    kept = M.one_of_each(docs_of(rows)).collect()
    assert sorted((r["doc_id"] or 0, r["text"][0]) for r in kept) == [(0, "a"), (7, "b"), (7, "c")]


def test_components_that_are_not_final_raise(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(200)], "u long, v long")
    with pytest.raises(RuntimeError):
        components(path, most_rounds=2)
    assert {r["component"] for r in components(path).collect()} == {0}


def test_class_sizes_and_recall_against_all_pairs(spark):
    """Over the driver's small documents: every pair at 0.8 or more, found by its rarest runs, is in one class; classes count their texts and documents."""
    import os
    from collections import Counter, defaultdict

    import pytest

    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("the driver's tables are not here")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = M.near_duplicates(docs).collect()
    bags, hashes = {}, M.WordHashes()
    for r in docs.collect():
        bags[r["doc_id"]] = M.runs_of(M.words_of(r["text"]), hashes)
    often = Counter(x for b in bags.values() for x in b[0].tolist())
    first = defaultdict(set)
    for i, (x, n) in bags.items():
        order = sorted(zip(x.tolist(), n.tolist(), strict=True), key=lambda p: (often[p[0]], p[0]))
        room = 0.2 * sum(n.tolist())  # a pair at 0.8 shares one of the rarest runs that make up over a fifth of a bag
        for x, n in order:
            first[x].add(i)
            room -= n
            if room < 0:
                break
    pairs = {(a, b) for s in first.values() for a in s for b in s if a < b}
    close = [(a, b) for a, b in pairs if (lambda v: v[0] >= 0.8 * v[1] - 1e-9)(M.overlap(bags[a], bags[b]))]
    of = {r["doc_id"]: r["class_id"] for r in out}
    assert len(close) > 50
    assert sum(of[a] == of[b] for a, b in close) == len(close)
    n_docs, texts = Counter(of.values()), defaultdict(set)
    for r in out:
        texts[r["class_id"]].add(r["rid"])
    assert all(r["n_docs"] == n_docs[r["class_id"]] and r["n_texts"] == len(texts[r["class_id"]]) for r in out)
