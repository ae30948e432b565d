import hashlib
import random
import re

from quillspark.llm import decontamination as D


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, n=10):
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, b in items:
            bw = words(b)
            for win in [bw[i : i + n] for i in range(len(bw) - n + 1)] or ([bw] if bw else []):
                for i in range(len(w) - len(win) + 1):
                    if w[i : i + len(win)] == win:
                        hit.update(range(i, i + len(win)))
                        found.add(str(item))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def cases():
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "naïve", "x1"]
    text = lambda k: " ".join(r.choice(vocabulary) for _ in range(k))
    items = [(i, text(k)) for i, k in enumerate([14, 10, 9, 3, 25, 1, 0, 12])] + [(8, None), (9, "..."), (1, text(11)), (10, "Zq-zq;ZQ")]
    docs = [(i, text(r.randint(0, 60))) for i in range(60)]
    docs += [(60 + i, f"{text(20)}, {b.upper() if b else ''}! {text(5)}") for i, (_, b) in enumerate(items)]
    return [*docs, (200, None), (201, ""), (201, ""), (202, "zq zq zq zq"), (None, items[0][1])], items


def test_hits_are_those_of_brute_force(spark, docs_of):
    docs, items = cases()
    b = spark.createDataFrame(items, "item_id long, text string")
    for block in (D.BLOCK_WORDS, 40):
        got = D.contamination(docs_of(docs), b, block_words=block).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
        assert sorted(map(tuple, got), key=str) == brute(docs, items)


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    r = D.contamination(docs_of(["a b"]), none).collect()
    assert [(x["n_words"], x["n_hit"], x["contaminated"]) for x in r] == [(2, 0, False)]
    assert D.contamination(docs_of([]), spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0


def test_removal(spark, docs_of):
    docs, items = cases()
    b = spark.createDataFrame(items, "item_id long, text string")
    bad = {d for d, *_, c in brute(docs, items) if c}
    for block in (D.BLOCK_WORDS, 40):
        kept = D.without_contaminated(docs_of(docs), b, block_words=block)
        assert kept.schema == docs_of(docs).schema
        assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in bad)
    cut = {r["doc_id"]: r["text"] for r in D.without_spans(docs_of([(1, "Keep, this. one TWO three four five six seven eight nine ten! and that")]), spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")).collect()}
    assert cut[1] == "Keep, this. ! and that"
