import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from quillspark.llm import suffix_dedup as S


def brute(rows, length, keep_first=False):
    """Per row (in the order of ids): bytes, removed, spans, digest of the rest."""
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    met, out = set(), []
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            w = t[p : p + length]
            if seen[w] > 1 and (not keep_first or w in met):
                gone[p : p + length] = b"\1" * length
            met.add(w)
        rest = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(rest).hexdigest()))
    return out


def corpus(seed, n=60):
    r = random.Random(seed)
    syllables = ["ab", "cé", "de", "日", "fg ", "h, ", "i\n"]
    text = lambda k: "".join(r.choice(syllables) for _ in range(k))
    passages = [text(r.randint(30, 160)) for _ in range(6)]
    rows = []
    for i in range(n):
        t = text(r.randint(0, 80))
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randint(0, 20)
            t += p[a : len(p) - r.randint(0, 20)] + text(r.randint(0, 30))
        rows.append((i, t))
    copy = rows[5][1]
    rows += [(n, copy), (n + 1, copy[:-1] + "x"), (n + 2, "a" * 500), (n + 3, "xy" * 300), (n + 4, None), (n + 5, ""), (n + 6, rows[3][1])]
    return rows


def got(df):
    return [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in sorted(df.collect(), key=lambda r: r["doc_id"])]


@pytest.mark.parametrize("length", [64, 200])
@pytest.mark.parametrize("keep_first", [False, True])
def test_removed_bytes_are_those_of_brute_force(spark, docs_of, length, keep_first):
    rows = corpus(length + keep_first)
    assert got(S.deduplicate(docs_of(rows).repartition(3), length, keep_first)) == brute(rows, length, keep_first)


@pytest.mark.parametrize("keep_first", [False, True])
def test_split_groups_and_cut_texts_give_the_same(spark, docs_of, monkeypatch, keep_first):
    """Many contexts of one passage, and pieces of long texts, with small bounds."""
    monkeypatch.setattr(S, "MOST", 3)
    monkeypatch.setattr(S, "BUFFER", 700)
    r = random.Random(1)
    word = lambda k: "".join(r.choice("abcdefgh ") for _ in range(k))
    passage = word(150)
    rows = [(i, word(r.randint(0, 90)) + passage + word(r.randint(0, 90))) for i in range(30)]
    rows += [(30 + i, word(3) + passage[:100] + r.choice("xy") + word(2)) for i in range(10)]
    rows.append((50, word(2000) + passage + word(800) + passage))
    assert got(S.deduplicate(docs_of(rows), 64, keep_first)) == brute(rows, 64, keep_first)


def test_repeated_rows_extra_columns_and_nothing(spark, docs_of):
    t = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(100))
    d = docs_of([(1, t), (1, t), (2, "short"), (None, t)]).withColumnRenamed("lang", "ranges").withColumnRenamed("source", "h")
    rows = S.deduplicate(d, 200, keep_first=False).collect()
    assert sorted(r["n_removed"] for r in rows) == [0, len(t), len(t), len(t)]
    assert S.deduplicate(docs_of([]), 200).count() == 0
    kept = S.deduplicate(docs_of([(1, t), (2, t)]), 200).orderBy("doc_id").collect()
    assert [r["kept"] for r in kept] == [t, ""]


def test_longest_previous_factors():
    r = random.Random(4)
    for _ in range(20):
        data = bytes(r.choice(b"abc") for _ in range(r.randint(60, 400)))
        length = r.choice([32, 40, 50])
        text = np.frombuffer(data, dtype=np.uint8)
        starts = np.array(sorted(r.sample(range(len(data) - length + 1), min(30, len(data) - length + 1))))
        lpf, source = S.longest_previous_factors(text, starts, length)
        for k, p in enumerate(starts):
            best = 0
            for q in starts[:k]:
                n = 0
                while n < length and data[p + n] == data[q + n]:
                    n += 1
                best = max(best, n)
            assert lpf[k] == best
            if best:
                assert source[k] < p and data[source[k] : source[k] + best] == data[p : p + best]


def test_nearest_smaller():
    r = random.Random(2)
    for _ in range(50):
        v = np.array(r.sample(range(100), r.randint(1, 60)))
        before, after = S.nearest_smaller(v)
        for i in range(len(v)):
            assert before[i] == max((j for j in range(i) if v[j] < v[i]), default=-1)
            assert after[i] == min((j for j in range(i + 1, len(v)) if v[j] < v[i]), default=len(v))
