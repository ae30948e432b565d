import json

import pytest

from quillspark.__main__ import main
from quillspark.operators import indexing
from quillspark.sources import services


def search(keyword, page):
    total = 250 if keyword == "a" else 0
    rows = [i for i in range(total)][(page - 1) * 100 : page * 100]
    return f"<r><totalCnt>{total}</totalCnt>" + "".join(f"<prec><id>{i}</id><pub>p{i % 2}</pub></prec>" for i in rows) + "</r>"


def test_searches(spark):
    k = spark.createDataFrame([("a",), ("b",), ("a",)], "keyword string")
    found = services.searched(k, search, {"serial": "id", "publisher": "pub"})
    assert found.count() == 250 and found.filter("pos = 249").first()["serial"] == "249"
    aliases = spark.createDataFrame([("t", "a", 0), ("u", "b", 0)], "target string, keyword string, order int")
    assert services.discovered(found, aliases).count() == 250
    d = services.detailed(found.limit(3).select("serial"), lambda s: "<x><c>text</c></x>" if s != "1" else "<x><c></c></x>", {"content": "c"})
    assert {r["content"] for r in d.collect()} == {"text"}
    with pytest.raises(services.IncompleteSearch):
        list(services.pages(lambda k, p: "<broken", "a"))
    endless = lambda k, p: "<r><totalCnt>99999999</totalCnt><prec><id>1</id></prec></r>"
    with pytest.raises(services.IncompleteSearch, match="pages"):
        list(services.pages(endless, "a"))
    nested = services.detailed(found.limit(1).select("serial"), lambda s: "<x><c>te<b>xt</b> all</c></x>", {"content": "c"})
    assert nested.first()["content"] == "text all"


def test_retries():
    calls, waits = [], []

    def failing(url, timeout):
        calls.append(url)
        raise OSError("no")

    with pytest.raises(OSError):
        services.get("http://x", {"q": "1"}, opener=failing, sleep=waits.append)
    assert len(calls) == 3 and waits == [0.3, 0.6]


def test_page_ranges(spark):
    r = spark.createDataFrame([("d", 1, 2)], "document string, first long, last long")
    blocks = "\n".join(json.dumps(x) for x in ({"type": "page", "content": "1"}, {"type": "text", "content": "x"}, {"type": "page", "content": "2"}))
    assert [x["content"] for x in services.parsed_ranges(r, lambda *a: blocks).orderBy("pos").collect()] == ["1", "x", "2"]
    with pytest.raises(Exception, match="page marks"):
        services.parsed_ranges(r, lambda *a: "{}").collect()
    assert b'name="f"; filename="n"' in services.multipart({"a": "b"}, {"f": ("n", b"x")}, "B")


def test_index(spark, tmp_path):
    path = str(tmp_path / "index")
    docs = spark.createDataFrame([("a", "1"), ("b", "2")], "chunk_id string, text string")
    assert indexing.create(spark, path, docs) and not indexing.create(spark, path, docs)
    indexing.upsert(path, docs)
    indexing.upsert(path, spark.createDataFrame([("b", "3"), ("c", "4")], "chunk_id string, text string"))
    assert sorted(tuple(r) for r in indexing.read_index(spark, path).collect()) == [("a", "1"), ("b", "3"), ("c", "4")]
    with pytest.raises(ValueError):
        indexing.upsert(path, docs.union(docs))
    assert indexing.index_name("x", "v2.1") == "x-v2-1-chunk-v2-index-v2"
    b = indexing.in_batches(spark.range(70).selectExpr("id", "1 AS g"), ["id"], 32, ["g"])
    assert [r["count"] for r in b.groupBy("batch").count().orderBy("batch").collect()] == [32, 32, 6]
    log = str(tmp_path / "log")
    with pytest.raises(KeyError), indexing.usage_log(spark, log, tokens=5):
        raise KeyError
    assert json.loads(spark.read.text(log).first()[0])["outcome"] == "failure: KeyError"


def test_commands(spark, tmp_path):
    rec = {
        "documentId": "a", "documentKind": "judgement", "title": "t", "text": "【주문】 의료법 <br/>1. 기각", "contentHash": "sha256:" + "0" * 64, "admission": "exempt", "usage": "index_eligible", "inDefaultCorpus": True,
        "identity": {"documentKind": "judgement", "caseSerial": "1", "caseName": "n", "caseNumber": "1", "court": "c", "caseCategory": "x", "decidedOn": "20200101", "judgementType": "x", "headnote": "", "holding": "", "referencedProvisions": "", "referencedPrecedents": ""},
        "provenance": {"provider": "p"}, "linkedLaws": [], "limitations": [],
    }
    r, q = tmp_path / "r.jsonl", tmp_path / "q.json"
    r.write_text(json.dumps(rec, ensure_ascii=False))
    q.write_text(json.dumps([{"id": 1, "question": "기각"}], ensure_ascii=False))
    assert main(["chunk", str(r), str(tmp_path / "chunks")]) == 0
    assert main(["index", str(tmp_path / "chunks"), str(tmp_path / "index")]) == 0
    assert main(["search", str(q), str(tmp_path / "index"), str(tmp_path / "hits")]) == 0
    assert spark.read.parquet(str(tmp_path / "hits")).count() == 1
    m = tmp_path / "m.json"
    m.write_text(json.dumps({"files": [], "coverageByDocumentKind": [], "coverageByProvider": [], "coverageByUsage": []}))
    assert main(["validate", str(r), str(m)]) == 1
