import random
import re

import pytest
from pyspark.sql import functions as F

from quillspark.functions import identity as ids
from quillspark.functions import text as tx


@pytest.fixture
def of(spark):
    def run(f, *values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        out = df.select("i", f("v").alias("r")).orderBy("i").collect()
        return [r["r"].asDict(True) if hasattr(r["r"], "asDict") else r["r"] for r in out]

    return run


def test_characters(of):
    assert of(tx.dot_variants, "a·b‧c", "ㆍ", "") == [2, 0, 0]
    assert of(tx.unify_chars, "a·ᆞ‧∙•・b", "ＡＢ！　ｘ", "ㆍ") == ["aㆍㆍㆍㆍㆍㆍb", "AB! x", "ㆍ"]


def squeeze(t):
    t = re.sub("[\t \xa0\u1680\u2000-\u200a\u202f\u205f\u3000]+", " ", t)
    return re.sub("\n{2,}", "\n", "\n".join(x.strip() for x in t.split("\n"))).strip()


def test_white_space_as_python_has_it(of):
    r = random.Random(1)
    texts = ["".join(r.choice(["a", "b", " ", "\n", "\t", "\xa0", "\u3000", "\r", "\u2028"]) for _ in range(r.randint(0, 20))) for _ in range(300)]
    assert of(tx.squeeze_space, *texts) == [squeeze(t) for t in texts]


def test_markup(of):
    assert of(tx.br_to_newline, "a<br/>b<BR >c<br>") == ["a\nb\nc\n"] and of(tx.br_count, "a<br/>b<BR >") == [2]
    assert of(tx.strip_tags, "<p>x</p><개정 2016>") == [" x <개정 2016>"] and of(tx.tag_count, "<p>x</p><개정 2016>") == [2]
    images = 'a<img src="x">b<img src="y"></img>c<img src="x"/>d<img>e'
    assert of(tx.image_markers, images, "none", "") == ["a[이미지1]b[이미지2]c[이미지1]d[이미지3]e", "none", ""]
    assert of(tx.image_count, images, "none") == [3, 0]


def test_item_breaks(of):
    got = of(tx.restore_item_breaks, "수집 가. 하나 나. 둘", "라고 한다. 다음", "2019. 12. 12. 시행", "내용 1. 첫째 2. 둘째", "앞▶뒤", "앞 \\- 뒤", "항 ① 하나", "시행 2019. 1. 1. 3. 끝")
    assert got == ["수집\n가. 하나\n나. 둘", "라고 한다. 다음", "2019. 12. 12. 시행", "내용\n1. 첫째\n2. 둘째", "앞\n▶뒤", "앞\n\\- 뒤", "항\n① 하나", "시행 2019. 1. 1. 3. 끝"]


def test_deleted_and_repealed(of):
    assert of(tx.deleted_article, " 제19조 (목적) 삭제 <2011>", "제19조의2 삭제", "제19조 내용") == [True, True, False]
    assert of(tx.repealed, "제19조 삭제 <2011>", "제19조(목적) 삭제", "제19조 삭제한다") == [True, False, False]
    assert of(tx.deleted_appendix, "삭제 <2011>", "이 표에서 삭제된 항목은 다음과 같다" * 5, "내용") == [True, False, False]


def test_appendix_units_and_locators(spark, of):
    assert of(tx.appendix_unit, "1", "별표", "서식") == [True, True, False]
    with pytest.raises(Exception, match="unknown appendix kind"):
        of(tx.appendix_unit, "9")
    df = spark.createDataFrame([("0005", "02"), ("0000", ""), ("7", None)], "n string, b string")
    assert [r[0] for r in df.select(tx.appendix_locator("n", "b")).collect()] == ["별표 5의2", "별표", "별표 7"]
    assert [r[0] for r in df.limit(1).select(tx.article_locator("n", "b")).collect()] == ["제5조의2"]


def test_sections_paragraphs_markers(of):
    assert of(tx.sections, "앞【주 문】기각【이    유】1. 가", "【주문】x", "none", "") == [
        [{"name": "", "body": "앞"}, {"name": "주문", "body": "기각"}, {"name": "이유", "body": "1. 가"}], [{"name": "주문", "body": "x"}], [{"name": "", "body": "none"}], [{"name": "", "body": ""}],
    ] or [[x.asDict() for x in r] for r in of(tx.sections, "앞【주 문】기각【이    유】1. 가")] == [[{"name": "", "body": "앞"}, {"name": "주문", "body": "기각"}, {"name": "이유", "body": "1. 가"}]]
    assert of(tx.paragraphs, " a <br/><br/>b\nc<br/>") == [["a", "b\nc"]]
    marks = of(tx.marker, "1. x", "12.5 x", "2019. 12. x", "가. x", "(3) x", "x 1.", "1. 2. x")
    assert [m and tuple(m.values()) for m in marks] == [("digit", "1"), None, None, ("hangul", "가"), ("paren", "(3)"), None, None]


def test_issues(of):
    got = of(tx.issues, "[1] a / [2] b", "[1][2] both /[1] one /[2] two", "<br/> 구 법 <br/> x ", "", None, "lost [1] a [1] b", "[1] [2]")
    assert got == [{1: "a", 2: "b"}, {1: "both; one", 2: "both; two"}, {1: "구 법 x"}, {}, {}, {1: "a; b"}, {}]


def test_tables_and_lines(of):
    assert [[tuple(x) for x in r] for r in of(tx.table_spans, "머리말\n┌─┬─┐\n│a│b│\n└─┴─┘\n꼬리말", "┌", "none")] == [[(4, 21)], [(0, 1)], []]
    r = random.Random(3)
    texts = ["\n".join("x" * r.randint(0, 60) for _ in range(r.randint(1, 12))) for _ in range(100)]
    got = of(lambda c: tx.pack_lines(c, 80), *texts)
    for t, pieces in zip(texts, got, strict=True):
        assert "\n".join(pieces) == t
        assert all(len(p) <= 80 or "\n" not in p for p in pieces)
        assert all(len(a) + 1 + len(b.split("\n")[0]) > 80 for a, b in zip(pieces, pieces[1:], strict=False))


def test_overlap_excerpt_citations(spark, of):
    df = spark.createDataFrame([("abc", "xxabcxx"), ("abc", "zzz"), ("a", "abc"), ("", "abc"), ("abab", "ab")], "q string, s string")
    assert [r[0] for r in df.select(tx.bigram_overlap("q", "s")).collect()] == [1.0, 0.0, 0.0, 0.0, 0.5]
    assert of(tx.excerpt, "x" * 2000, "x" * 2001) == ["x" * 2000, "x" * 1997 + "..."]
    assert of(tx.citation_list, " a; b ;; ", None) == [["a", "b ;"], []] or of(tx.citation_list, "a; b; ; c") == [["a", "b", "c"]]
    assert of(tx.squash, "a \\b\u3000\nc") == ["abc"]


def test_identifiers(spark, of):
    import hashlib

    assert of(ids.content_hash, "한글") == ["sha256:" + hashlib.sha256("한글".encode()).hexdigest()]
    want = "doc-" + hashlib.sha256("법령\x1f001\x1f5\x1f0".encode()).hexdigest()[:24]
    assert [r[0] for r in spark.range(1).select(ids.article_id(F.lit(" 001 "), F.lit("0005"), F.lit(""))).collect()] == [want]
    assert [r[0] for r in spark.range(1).select(ids.chunk_id(F.lit("d"), F.lit("body"), F.lit(1234))).collect()] == ["d#body-1234"]
    assert of(ids.decided_date, "00010101", "20200131", "x")[0] is None
    with pytest.raises(ValueError):
        ids.family_id("record", F.lit(1))


def test_missing_text_and_markers(spark):
    df = spark.createDataFrame([("가·나\n다", ["가ㆍ나 다", "라"], ["가", "다", "나"])], "b string, e array<string>, m array<string>")
    r = df.select(tx.missing_text("b", "e").alias("x"), tx.unanchored_markers("b", "m").alias("y")).first()
    assert r["x"] == ["라"] and r["y"] == ["나"]
