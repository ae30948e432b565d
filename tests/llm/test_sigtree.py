import random

import numpy as np
import pytest

from quillspark.llm import sigtree
from quillspark.llm.common import WordHashes
from quillspark.llm.minhash import runs_of

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in (text or "").translate(LOWER)).split(" ") if w]
    return frozenset(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))) if words else frozenset()


def brute(rows, percent=90):
    """(id, size, least id reachable) of each row (id, text), by all pairs."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[top(i)] = top(j)
    ids = {}
    for i, (name, _) in enumerate(rows):
        ids.setdefault(top(i), []).append(name)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(((name, len(sets[i]), least[top(i)] if sets[i] else name) for i, (name, _) in enumerate(rows)), key=str)


def edited(r, words, edits):
    words = list(words)
    for _ in range(edits):
        words[r.randrange(len(words))] = f"e{r.randrange(10**6)}"
    return " ".join(words)


def corpus(r):
    words = [f"w{i}" for i in range(3000)]
    passage = r.choices(words, k=90)
    rows = []
    for n in (9, 12, 30, 70, 200, 400):
        base = r.choices(words, k=n)
        rows += [edited(r, base, r.randrange(0, 1 + n // 25)) for _ in range(14)] + [" ".join(base[: n - r.randrange(0, 1 + n // 9)]) for _ in range(8)]
    rows += [" ".join(passage + r.choices(words, k=r.choice([3, 8, 12, 40]))) for _ in range(30)]
    rows += [" ".join(r.choices(words, k=r.randrange(1, 60))) for _ in range(25)]
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("sizes", [(64, 4096, 16), (1, 8, 2)])
def test_every_link_is_found(spark, monkeypatch, sizes):
    """With sizes of production, and with trees of many levels and blocks in every bucket."""
    for name, value in zip(("LEAF", "BLOCK", "FAN"), sizes, strict=True):
        monkeypatch.setattr(sigtree, name, value)
    monkeypatch.setattr(sigtree, "FEW_IDS", sizes[0])
    monkeypatch.setattr(sigtree, "CHUNK", 100 * sizes[0])
    monkeypatch.setattr(sigtree, "OFTEN", 3)
    rows = corpus(random.Random(sizes[0])) + [(500, None), (501, ""), (502, " \t\n"), (503, "One two"), (504, "one\x0bTWO"), (505, "É é x y"), (None, "one two"), (None, "alone with no id at all"), (0, "same id other text")]
    df = spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in rows], "doc_id long, text string, component_id string, uid int, n int").repartition(5)
    got = sigtree.jaccard_components(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_a_group_of_near_copies_is_one_component(spark):
    r = random.Random(2)
    base = [f"w{r.randrange(500)}" for _ in range(300)]
    rows = [(i, edited(r, base, 2)) for i in range(400)] + [(1000 + i, " ".join(base)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r["component_id"] for r in sigtree.jaccard_components(df).collect()} == {0}
    assert sigtree.jaccard_components(df.limit(0)).count() == 0


def test_ids_of_text_and_a_long_text(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [("b", long), ("a", long + " more"), ("c", "x y z")]
    got = sigtree.jaccard_components(spark.createDataFrame(rows, "name string, body string"), id_col="name", text_col="body")
    assert sorted(map(tuple, got.collect())) == [("a", 59_999, "a"), ("b", 59_998, "a"), ("c", 1, "c")]


def tree_of(sets, component):
    bits = sigtree.bitmaps(np.concatenate(sets), np.array([len(s) for s in sets]))
    n = np.array([len(s) for s in sets])
    return sigtree.Tree(sigtree.matrix(bits, min(map(len, bits))), n, n, np.array(component))


def test_chunks_and_bitmaps():
    hashes, r = WordHashes(), random.Random(1)
    texts = [None, "", "a", "a B", "a b c", "x " * 10, *(" ".join(r.choices("abcdefgh", k=r.randrange(40))) for _ in range(30)), " ".join(f"w{i}" for i in range(3000))]
    s, n = sigtree.shingled(texts, hashes, 3)
    at = 0
    for t, k in zip(texts, n.tolist(), strict=True):
        assert k == len(shingles(t))
        assert s[at : at + k].tolist() == sorted(runs_of(sigtree.words_of(t), hashes, 3)[0].tolist())
        at += k
    bits = sigtree.bitmaps(s, n)
    assert len(bits[-1]) * 8 >= 4 * n[-1] and len(bits[0]) * 8 == sigtree.BITS
    small = sigtree.bitmaps(s[-2998:][:400], np.array([400]))[0]
    assert (np.frombuffer(small, dtype=np.uint64) & ~sigtree.fold(bits[-1], len(small))).sum() == 0


def test_traversal_prunes_and_misses_nothing():
    r, hashes = random.Random(3), WordHashes()
    texts = []
    for g in range(40):
        base = [f"g{g}w{i}" for i in range(r.randrange(15, 250))]
        texts += [edited(r, base, r.randrange(0, 6)) for _ in range(10)]
    sets = [runs_of(t.encode().split(), hashes, 3)[0] for t in texts]
    tree = tree_of(sets, list(range(len(sets))))
    i, j = sigtree.traverse(tree, tree, 90)
    found = set(zip(i.tolist(), j.tolist(), strict=True))
    want = {(a, b) for b in range(len(sets)) for a in range(b) if 100 * (k := len(np.intersect1d(sets[a], sets[b]))) >= 90 * (len(sets[a]) + len(sets[b]) - k)}
    assert want <= found and len(found) < 2 * len(want) + 10
    left, right = tree_of(sets[:150], range(150)), tree_of(sets[150:], range(150, len(sets)))
    i, j = sigtree.traverse(left, right, 90)
    assert {(a, b) for a, b in want if a < 150 <= b} <= set(zip(i.tolist(), (j + 150).tolist(), strict=True))
    same = tree_of(sets, [0] * len(sets))
    assert not len(sigtree.traverse(same, same, 90)[0])


def test_bounds():
    for percent in (50, 80, 90, 100):
        for n in range(1, 60):
            for m in range(n, 60):
                need = next((k for k in range(n + 1) if 100 * k >= percent * (n + m - k)), None)
                assert need is None or sigtree.least_overlap(n, m, percent) == need
            partners = [m for m in range(1, 200) if m != n and 100 * min(n, m) >= percent * max(n, m)]
            other = any(100 * (n - 1) >= percent * (n + 1) for _ in (0,))
            assert sigtree.prefix_length(n, percent) > 0 or not (partners or other)


def test_sets_that_link_meet_twice_early():
    """Whatever the order: of two sets that link, the first shingles share SHARED ones, at places that leave room."""
    r = random.Random(7)
    for _ in range(2000):
        percent, n = r.choice([70, 80, 90]), r.randrange(10, 80)
        x = r.sample(range(200), n)
        y = [v for v in x if r.random() > 0.06] + r.sample(range(200, 220), r.randrange(0, 4))
        both = len(set(x) & set(y))
        if 100 * both < percent * len(set(x) | set(y)) or set(x) == set(y):
            continue
        order = {v: r.random() for v in range(220)}
        x, y = sorted(x, key=order.get), sorted(y, key=order.get)
        met = set(x[: sigtree.prefix_length(len(x), percent)]) & set(y[: sigtree.prefix_length(len(y), percent)])
        assert len(met) >= min(sigtree.SHARED, both)
        room = lambda v: min(len(x) - x.index(v), len(y) - y.index(v)) + sigtree.SHARED - 1
        assert sum(room(v) >= sigtree.least_overlap(len(x), len(y), percent) for v in met) >= sigtree.SHARED


@pytest.mark.parametrize("often", [2, 6])
def test_sets_that_link_hold_the_same_in_a_part(monkeypatch, often):
    """Whatever the sizes, also where parts of few shingles are left out."""
    monkeypatch.setattr(sigtree, "OFTEN", often)
    r, linked = np.random.default_rng(often), 0
    for _ in range(1500):
        percent, n = int(r.choice([50, 80, 90, 95])), int(r.integers(2, 400))
        pool = np.unique(r.integers(0, 2**63, size=2 * n + 20, dtype=np.uint64) * np.uint64(2))
        pool = r.permutation(pool)
        x = np.sort(pool[:n])
        y = np.sort(np.concatenate([pool[: int(r.integers(max(1, n * percent // 100), n + 1))], pool[n : n + int(r.integers(0, n * (100 - percent) // 100 + 1))]]))
        both = len(np.intersect1d(x, y))
        if both == len(x) == len(y) or 100 * both < percent * (len(x) + len(y) - both):
            continue
        keys, of = sigtree.part_keys(np.concatenate([x, y]), np.array([len(x), len(y)]), percent)
        assert set(keys[of == 0].tolist()) & set(keys[of == 1].tolist())
        linked += 1
    assert linked > 300


def test_chance_makes_no_candidates(spark, monkeypatch):
    """Texts that share shingles or a passage, as any do in a large corpus, are not compared: only near copies are."""
    compared, links = [], sigtree._links
    monkeypatch.setattr(sigtree, "_links", lambda pairs, *a: compared.append(pairs.distinct().count()) or links(pairs, *a))
    r = random.Random(5)
    words = [f"w{i}" for i in range(9)]
    passage = r.choices(words, k=40)
    rows = [(i, " ".join(passage * (i % 2) + r.choices(words, k=80))) for i in range(300)]
    rows += [(1000 + i, edited(r, rows[i][1].split(), 1)) for i in range(10)]
    got = sigtree.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    assert sum(compared) <= 100
