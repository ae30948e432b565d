import random

from pyspark.sql import functions as F

from quillspark.operators import chunking as C


def test_locators_follow_markers():
    text = "앞말<br/>둘【이    유】<br/>1. 첫 번째 항목입니다.<br/>가. 하나<br/>(1) 안<br/>나. 둘<br/>2. 두 번째 항목입니다."
    got = C.judgement_pieces(text)
    assert [w for w, _ in got] == ["", "이유 > 1", "이유 > 2"]
    assert got[1][1].split("\n\n") == ["1. 첫 번째 항목입니다.", "가. 하나", "(1) 안", "나. 둘"]


def test_repeated_locators_and_long_paragraphs():
    text = "【이유】<br/>1. " + "문장입니다. " * 300
    got = C.judgement_pieces(text)
    assert [w for w, _ in got][:3] == ["이유 > 1", "이유 > 1 (2)", "이유 > 1 (3)"] or [w for w, _ in got] == ["이유 > 1", "이유 > 1 (2)"]
    assert all(len(t) <= C.TARGET for _, t in got) and len({w for w, _ in got}) == len(got)
    assert [len(t) for _, t in C.judgement_pieces("x" * 3200)] == [1500, 1500, 200]


def test_pieces_are_packed_and_lose_nothing():
    r = random.Random(1)
    for _ in range(60):
        parts = ["".join(r.choice("abc. 가") for _ in range(r.choice([5, 50, 700, 1500, 1501, 2500]))).strip() or "x" for _ in range(r.randint(1, 8))]
        text = "<br/>".join(f"{r.choice(['', '1. ', '2. ', '가. '])}{p}" for p in parts)
        got = C.judgement_pieces(text)
        squashed = "".join("".join(t.split()) for _, t in got)
        assert squashed == "".join("".join(text.replace("<br/>", " ").split()))
        assert all(len(t) <= C.TARGET for _, t in got)
        assert len({w for w, _ in got}) == len(got)


def test_sentences():
    assert C.sentences_to("a. b. c.", 5) == ["a. b.", "c."]
    assert C.sentences_to("aaaaaaa. b.", 3) == ["aaa", "aaa", "a.", "b."]


def test_statutes():
    short = C.statute_pieces("법 제1조", "1. 짧다\n2. 글")
    assert short == [("법 제1조", "1. 짧다\n2. 글", "text")]
    rows = "┌─┐\n" + "│마. 위반 │근거 │\n" * 20 + "└─┘"
    text = "머리\nⅠ. 하나\n1. 첫째 " + "가" * 700 + "\n가. 안 " + "나" * 300 + f"\n{rows}\n나. 뒤 " + "다" * 300 + "\n2. 끝"
    got = C.statute_pieces("T", text)
    assert [(w, k) for w, _, k in got] == [
        ("T (조각 1/7)", "text"), ("T > Ⅰ", "text"), ("T > Ⅰ > 1", "text"), ("T > Ⅰ > 1 > 가", "text"), ("T (조각 5/7)", "table"), ("T > Ⅰ > 1 > 나", "text"), ("T > Ⅰ > 2", "text"),
    ]
    assert got[4][1] == rows
    long = C.statute_pieces("T", "\n".join(["1. " + "가" * 900, "나" * 900, "다" * 10]))
    assert [w for w, _, _ in long] == ["T > 1 (조각 1/2)", "T > 1 (조각 2/2)"]
    assert len(C.statute_pieces("T", "x" * 1500)) == 1


def test_tables_next_to_text():
    runs = C.table_runs("a\n│x\n│y\n\nb\n│z")
    text = "a\n│x\n│y\n\nb\n│z"
    assert [(text[a:b], t) for a, b, t in runs if t] == [("│x\n│y", True), ("│z", True)]
    assert "".join(text[a:b] for a, b, _ in runs) == text


def test_lines_to():
    assert C.lines_to("aa\nbb\ncc", 5) == ["aa\nbb", "cc"]
    assert C.lines_to("aaaaaaaa\nb", 5) == ["aaaaaaaa", "b"]


def test_chunk_rows(spark):
    from quillspark.plans import queries

    records = queries.records(spark, "/root/testdata/sf0.001")
    rows = C.chunk_judgements(records, "v1")
    assert rows.count() == rows.select("chunk_id").distinct().count()
    doc = rows.groupBy("document_id", "chunk_type", "locator").count().filter("count > 1")
    assert doc.count() == 0
    s = rows.filter("chunk_type = 'summary-headnote'").filter("document_id = '1'").orderBy("ordinal").collect()
    assert [(r["locator"], r["text"], r["fields"]["referenced_provisions"]) for r in s] == [("판시사항 [1]", "first", "law 1; law 2"), ("판시사항 [2]", "second", "law 1; law 2")]
    docs = C.index_documents(rows).filter("chunk_type = 'summary-headnote'").filter("document_id = '1'").first()
    assert docs["referenced_provisions"] == ["law 1", "law 2"]
    assert rows.filter(F.length("text") > C.TARGET).count() == 0
