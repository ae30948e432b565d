import math
import random
import zlib
from collections import Counter

import pytest

from quillspark.llm import lm as L

VOCABULARY = {b: math.log(p) for b, p in {L.SPACE: 0.1, b"a": 0.2, b"b": 0.1, b"ab": 0.15, L.SPACE + b"a": 0.05, b"bab": 0.02, b"\xc3": 0.01, b"\xa9": 0.01, "é".encode(): 0.03}.items()}


def every(text):
    """Sum over all segmentations, one by one."""
    if not text:
        return 1.0
    return sum(math.exp(VOCABULARY[text[:k]]) * every(text[k:]) for k in range(1, len(text) + 1) if text[:k] in VOCABULARY)


def test_forward_recursion():
    r = random.Random(1)
    longest, starts = max(map(len, VOCABULARY)), {p[:k] for p in VOCABULARY for k in (1, 2, 3, 4)}
    for _ in range(100):
        w = "".join(r.choice("abé") for _ in range(r.randint(0, 7))).encode()
        want = math.log(every(L.SPACE + w))
        assert abs(L.word_logp(w, VOCABULARY, longest) - want) < 1e-9
        assert abs(L._fast_logp(w, VOCABULARY, longest, starts) - want) < 1e-9


def test_long_words_stay_finite():
    pieces = {bytes([b]): math.log(1e-4) for b in range(256)}
    assert abs(L.word_logp(b"x" * 5000, pieces, 1) - 5003 * math.log(1e-4)) < 1e-5


def rows():
    r = random.Random(2)
    text = lambda: " ".join("".join(r.choice(["th", "er", "on", "É", "ing"]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(0, 40)))
    return [*((i, text()) for i in range(80)), (100, None), (101, ""), (102, "\x0bA\x1cb C  d"), (103, "x" * 3000), (3, "again"), (None, "The the THE")]


def base(docs):
    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2
    words = lambda t: (t or "").encode().lower().split()
    c = Counter(w for d, t in docs if not held(d) for w in [*words(t), "END"])
    n, v = sum(c.values()), len(c)
    out = []
    for d, t in docs:
        tokens = [*words(t), "END"]
        score = sum(math.log10((c[w] + 1) / (n + 1 * (v + 1))) for w in tokens)
        out.append((d, held(d), len(tokens), sum(c[w] > 0 for w in tokens), n, round(score, 6)))
    return sorted(out, key=str)


def test_base_scores_and_blocks(spark, docs_of, monkeypatch):
    for size, frequent in ((L.BLOCK_BYTES, L.FREQUENT), (300, 3), (300, 0)):
        monkeypatch.setattr(L, "BLOCK_BYTES", size)
        monkeypatch.setattr(L, "FREQUENT", frequent)
        got = L.lm_scores(docs_of(rows()).repartition(3)).collect()
        assert sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got), key=str) == base(rows())
        assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_scores_are_sums_over_all_segmentations(spark, docs_of, monkeypatch):
    """With a given unigram vocabulary, against segmentations one by one; with frequent words and without."""
    r = random.Random(9)
    texts = [None, "", *(" ".join("".join(r.choice("abé") for _ in range(r.randint(1, 6))) for _ in range(r.randint(1, 9))) for _ in range(40))]
    want = {i: (sum(math.log(every(L.SPACE + w)) for w in (t or "").encode().split()) - 2.0) / math.log(10) for i, t in enumerate(texts)}
    for frequent in (L.FREQUENT, 5):
        monkeypatch.setattr(L, "FREQUENT", frequent)
        got = L.lm_scores(docs_of(list(enumerate(texts))), piece_logp=VOCABULARY, end_logp=-2.0).collect()
        assert len(got) == len(want) and all(abs(x["score"] - want[x["doc_id"]]) < 1e-9 for x in got)


def test_ids_keep_their_type(spark, docs_of):
    d = docs_of([(9007199254740993, "a b"), (None, "a"), (3, "b")])
    assert {r["doc_id"] for r in L.lm_scores(d.coalesce(1)).collect()} == {9007199254740993, None, 3}
    named = d.selectExpr("'x' || doc_id AS doc_id", "text")
    assert {r["doc_id"] for r in L.lm_scores(named.coalesce(1)).collect()} == {"x9007199254740993", None, "x3"}


def test_missing_vocabulary_is_named(spark, docs_of):
    with pytest.raises(ValueError, match="model_path"):
        L.lm_scores(docs_of(["a"]), model_path="/nowhere/x.model")


def test_model_knows_its_language(spark, docs_of):
    r = random.Random(5)
    text = lambda s: " ".join("".join(r.choice(s) for _ in range(2)) for _ in range(30))
    docs = [*((i, text(["the", "ing"])) for i in range(100)), (500, text(["the", "ing"])), (501, text(["zqx", "vkj"]))]
    s = {x["doc_id"]: x["score"] / x["n_tokens"] for x in L.lm_scores(docs_of(docs)).collect()}
    assert s[500] > s[501] + 2


def test_nothing(spark, docs_of):
    assert L.lm_scores(docs_of([])).count() == 0


def test_vocabulary_has_every_byte():
    pieces = L.vocabulary(L.PIECES)
    assert {bytes([b]) for b in range(256)} <= set(pieces) and L.SPACE in pieces
