import random
import zlib

import pytest

from quillspark.llm import toxicity as X

INSULTS = ["idiot", "moron", "worthless", "pathetic", "scum"]


def corpus(n=600, seed=1):
    r = random.Random(seed)
    syllables = ["th", "er", "on", "an", "re", "nd", "at", "ti", "es", "or", "ing", "ed"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    rows, labels = [], []
    for i in range(n):
        w = [word() for _ in range(r.randint(5, 60))]
        toxic = r.random() < 0.3
        if toxic:
            for _ in range(2):
                w.insert(r.randrange(len(w)), r.choice(INSULTS))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    d = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (None, 1), (3, None), (4, labels[4][1])], "doc_id long, toxic int")
    return d, lab, dict(labels), X.fit(d, lab.filter("doc_id % 5 <> 0"))


def test_held_out_accuracy(fitted):
    d, lab, truth, _ = fitted
    out = X.toxicity(d, lab).collect()
    held = [r for r in out if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in out)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97


def test_gapped_and_inserted_letters(spark, fitted):
    _, _, _, model = fitted
    bad = ["you i.d.i.o.t now", "an idxiot here", "such w*o*r*t*h*l*e*s*s talk", "what a p a t h e t i c thing", "MORON!", "morron you", "1diot yes", "s-c-u-m"]
    good = ["there is an ending to this", "the theory of these", "", "...", None, "a b", "12345 67890", "thering onander"]
    rows = spark.createDataFrame(list(enumerate(bad + good)), "doc_id long, text string")
    value = {r["id"]: 1 / (1 + 2.718281828 ** -(model.slope * r["value"] + model.offset)) for r in model.values(rows, "doc_id", "text").collect()}
    assert sum(value[i] >= 0.5 for i in range(len(bad))) >= len(bad) - 1, value
    assert all(value[len(bad) + i] < 0.5 for i in range(len(good))), value


def test_nothing_to_learn_from(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    out = X.toxicity(docs_of(["a b", None]), none).collect()
    assert [(r["score"], r["predicted"]) for r in out] == [(0.0, 0)] * 2
    assert X.toxicity(docs_of([]), none).count() == 0
    assert X.without_toxic(docs_of(["a b"]), none).count() == 1


def test_filter_keeps_schema_and_clean_rows(spark, fitted):
    d, lab, truth, _ = fitted
    wide = d.selectExpr("doc_id", "text", "'x' AS value", "1.5 AS score")
    kept = X.without_toxic(wide, lab)
    assert kept.schema == wide.schema
    ids = {r["doc_id"] for r in kept.collect()}
    scored = {r["doc_id"] for r in X.toxicity(d, lab).collect() if not r["predicted"]}
    assert ids == scored
    assert sum(truth[i] == 0 for i in ids) / sum(v == 0 for v in truth.values()) > 0.98


def naive_features(text):
    """Weights of subsequences of a text of plain lower-case words, by the definition, each read in one window."""
    letters = " " + text + " " * X.SPAN
    found = {}
    for p in range(len(text) + 1):
        for j in range(2, X.SPAN + 1):
            for i in range(1, j):
                t = letters[p], (letters + " " * 9)[p + i], (letters + " " * 9)[p + j]
                if not (t[1] == " " and " " in (t[0], t[2])):
                    found[t] = found.get(t, 0) + X.DECAY ** (j - 2)
    words = text.split()
    for a in range(len(words)):
        found[words[a]] = found.get(words[a], 0) + X.WORD_WEIGHT
        for d in range(1, X.REACH + 1):
            if a + d < len(words):
                found[words[a], words[a + d], d] = found.get((words[a], words[a + d], d), 0) + X.WORD_WEIGHT * X.DECAY ** (d - 1)
    return {k: v / max(len(text) + 1, 16) ** 0.5 for k, v in found.items()}


def naive_kernel(a, b):
    x, y = naive_features(a), naive_features(b)
    return sum(v * y.get(k, 0) for k, v in x.items())


SHORT = ["you idiot go", "theory of it", "aaaaaa a", "go you idiot", "x", "kill you", "you kill", "scum scum scum scum"]


def mapped(texts):
    import numpy as np

    out, words, sentence, _ = X.flattened(texts, X.classes())
    return (out, words, sentence), (*X.features(out, words, sentence, X.WORDS, np.arange(len(texts))), len(texts))


def test_kernel_is_that_of_the_definition():
    _, rows = mapped(SHORT)
    got = X.Landmarks(*rows).kernel(*rows)
    for i, a in enumerate(SHORT):
        for j, b in enumerate(SHORT):
            assert abs(got[i, j] - naive_kernel(a, b)) < 1e-4, (a, b)


def test_tables_equal_the_sum_over_landmarks():
    import numpy as np

    flat, rows = mapped(SHORT)
    weight = np.random.default_rng(1).normal(size=len(SHORT))
    got = X.values(X.tables((*X.Landmarks(*rows).weighted(weight), 0.3)), *flat, X.WORDS)
    for a, g in zip(SHORT, got, strict=True):
        assert abs(sum(w * naive_kernel(a, b) for w, b in zip(weight, SHORT, strict=True)) + 0.3 - g) < 1e-4


def test_sentences_are_cut_and_marks_left_out():
    def words(text):
        out, at, sentence, _ = X.flattened([text], X.classes())
        ends = [*at[1:], len(out)][: len(at)]
        return [("".join(chr(96 + c) for c in out[a:b] if c), int(s)) for a, b, s in zip(at, ends, sentence, strict=True)]

    shown = lambda text: [w for w, _ in words(text)]
    assert shown("An i.d.i.o.t! i d i o t, s-t-u-p-1-d") == ["an", "idiot", "idiot", "stupid"]
    assert shown("12 + 34 -- !") == [] == shown("")
    assert [s for _, s in words("a cat sat. It ran\naway")] == [0, 0, 0, 1, 1, 2]
    assert shown("x" * 60) == ["x" * X.LONG, "x" * X.LONG, "x" * (60 - 2 * X.LONG)]


def test_order_of_plain_words_is_learned(spark):
    r = random.Random(5)
    vocabulary = ["".join(r.choice("bcdfghklmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 3))) for _ in range(300)] + ["kill", "you"] * 20
    rows, labels = [], []
    for i in range(800):
        w = [r.choice(vocabulary[:300]) for _ in range(r.randint(6, 30))]
        toxic = r.random() < 0.5
        k = r.randrange(len(w))
        w[k:k] = ["kill", "you"] if toxic else ["you", "kill"]
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    d, lab, truth = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)
    held = [x for x in X.toxicity(d, lab).collect() if x["held_out"]]
    toxic = [x for x in held if truth[x["doc_id"]]]
    assert sum(x["predicted"] for x in toxic) / len(toxic) > 0.9
    assert sum(x["predicted"] == truth[x["doc_id"]] for x in held) / len(held) > 0.9


def test_long_texts_count_whole_and_ids_repeat(spark, fitted):
    d, lab, truth, model = fitted
    clean = next(t for i, t in [(r["doc_id"], r["text"]) for r in d.collect()] if not truth[i])
    long = (clean + " ") * (3 * X.PART // len(clean))
    rows = [(0, long), (1, long[: X.PART] + " idiot moron " + long[X.PART :]), (2, long + "you pathetic scum"), (3, "a" * (2 * X.PART + 5)), (3, None), (3, "moron " * 4), (None, "scum idiot")]
    value = model.values(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()
    likely = [1 / (1 + 2.718281828 ** -(model.slope * r["value"] + model.offset)) >= 0.5 for r in value]
    assert likely == [False, True, True, False, False, True, True]
    again = X.toxicity(d.unionByName(d), lab).groupBy("doc_id").count().filter("count <> 2")
    assert again.count() == 0


def test_labels_of_absent_ids_use_up_no_sample(spark):
    """The sample is of labels whose documents are there, however many others the table has."""
    rows, labels = corpus(300, 5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    absent = [(10_000 + i, i % 2) for i in range(4000)]
    model = X.fit(docs, spark.createDataFrame(labels + absent, "doc_id long, toxic int"), most_toxic=60, most_clean=60, landmarks=40)
    alone = X.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), most_toxic=60, most_clean=60, landmarks=40)
    assert model is not None and (model.slope, model.offset) == (alone.slope, alone.offset)
