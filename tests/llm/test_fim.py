import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import fim

UNIT = {"char": r"(?s).", "word": r"[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", "line": r"[^\n]*\n|[^\n]+"}
TEXT = st.lists(st.sampled_from(["<P>", "<", "P", ">", "S>", "<M", "a", "é", "😀", " ", "\n", "\r\n", "\t", "\x0b", "\x00", "bc", " "]), max_size=14).map("".join)


def brute(doc_id, text, unit="char", plain=10, spm=20):
    """The same from the definition, with a list of all units."""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = re.findall(UNIT[unit], text)
    n = len(units)
    if not text or any(s in text for s in fim.SENTINELS) or h3 % 100 >= 100 - plain:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if h4 % 100 < spm else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return n, "spm" if h4 % 100 < spm else "psm", len(prefix), len(middle), out


@settings(max_examples=400, deadline=None)
@given(st.integers(-5, 10**6), TEXT, st.sampled_from(sorted(UNIT)), st.sampled_from([0, 10, 100]), st.sampled_from([0, 20, 100]))
def test_brute_force_and_round_trip(doc_id, text, unit, plain, spm):
    f = fim.FillInMiddle(unit, fim.SENTINELS, plain, spm, "1:")
    got = f.write(doc_id, text)
    assert got == brute(doc_id, text, unit, plain, spm)
    assert f.read(got[1], got[-1]) == text


def test_few_events_for_many_units():
    f = fim.FillInMiddle("char", fim.SENTINELS, 10, 20, "1:")
    events = fim.Events("é" * 100_000, "char", f.scan)
    assert events.n == 100_000 and len(events.starts) == 1
    assert [events.end_of(k) for k in (0, 1, 99_999, 100_000)] == [0, 1, 99_999, 100_000]


def test_texts_nulls_ties_and_clashing_columns(spark, monkeypatch):
    texts = [None, "", "a", "<S>", "x<M", "word " * 50_000, "é😀\n" * 30, "same", "same"]
    rows = [(i if i != 2 else None, t, "clash", "clash") for i, t in enumerate(texts)] + [(7, "same", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, form string, id string").repartition(3)
    for unit in UNIT:
        got = sorted((tuple(r) for r in fim.fill_in_middle(df, unit=unit).collect()), key=str)
        assert got == sorted(((i, *brute(i, t or "", unit)) for i, t, *_ in rows), key=str)
    digests = fim.fim_digests(df)
    assert digests.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert sorted(map(str, (tuple(r) for r in digests.collect()))) == sorted(str((i, *(b := brute(i, t or ""))[:-1], sha(b[-1]), sha(t or ""))) for i, t, *_ in rows)
    assert fim.fim_digests(df.limit(0)).count() == 0


def test_outputs_leave_in_several_batches(spark, monkeypatch):
    monkeypatch.setattr(fim, "BATCH", 1)
    out = list(fim._mapped(("char", fim.SENTINELS, 10, 20, "1:"), False)([_batch([(1, "abc"), (2, ""), (3, "def")])]))
    assert [b.num_rows for b in out] == [1, 2] and out[1].column("id").to_pylist() == [2, 3]


def _batch(rows):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])], names=["id", "text"])


@pytest.mark.parametrize("bad", [("<P>", "<P>", "<M>"), ("aba", "<S>", "<M>"), ("<P>", "><S", "<M>"), ("< P", "<S>", "<M>"), ("", "<S>", "<M>")])
def test_sentinels_that_could_not_be_read_back(spark, bad):
    with pytest.raises(ValueError):
        fim.fill_in_middle(spark.range(1).selectExpr("id as doc_id", "'x' as text"), sentinels=bad)


def test_wrong_outputs_are_refused():
    f = fim.FillInMiddle("char", fim.SENTINELS, 10, 20, "1:")
    for form, out in (("psm", "<S>a<P>b<M>c"), ("spm", "<S>a<P>b"), ("psm", "x<P>a<S>b<M>c")):
        with pytest.raises(ValueError):
            f.read(form, out)
