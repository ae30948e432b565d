import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from quillspark.functions import responses as R
from quillspark.operators import answering, cleaning, evaluation, indexing, records, release, retrieval, selection, validation
from quillspark.plans import queries
from quillspark.sources import readers, schemas

SF = "/root/testdata/sf0.001"


def test_cleaning(spark):
    df = spark.createDataFrame([("①\n① 항 <개정 2016.2.3>  <신설 2017>\n1.\n1. 호·목<img src='a'>",), ("x",)], "c string")
    r = cleaning.clean_column(df, cleaning.clean_law, "c", "n").collect()[0]
    assert r["c"] == "① 항\n1. 호ㆍ목[이미지1]"
    assert (r["n"]["amend_removed"], r["n"]["numbers_deduped"], r["n"]["dots_unified"], r["n"]["images_indexed"]) == (2, 2, 1, 1)
    p = spark.createDataFrame([("a<br/>b &amp; &lt;b&gt;<p>c</p>&nbsp;d",)], "c string")
    done = cleaning.clean_column(p, cleaning.clean_precedent, "c", "n")
    r = done.first()
    assert r["c"] == "a\nb & <b> c d" and r["n"]["entities_unescaped"] == 1 and r["n"]["residual_tags"] == 2
    assert cleaning.cleaning_totals(done, "n").first()["br_replaced"] == 1
    again = cleaning.clean_column(df, cleaning.clean_law, "c")
    assert cleaning.idempotency_violations(again, cleaning.clean_law, "c").first()[0] == 0
    rows = spark.createDataFrame([(0, "k", "aa", "s0"), (1, "k", "bbb", "s1"), (2, "k", "ccc", "s2"), (3, "", "x", "s3"), (4, None, "yy", "s4")], "pos int, k string, t string, s string")
    kept = {r["pos"]: (r["kept"], r["excluded_reason"]) for r in cleaning.dedupe_by_longest(rows, "k", "t", "s").collect()}
    assert [p for p, (k, _) in kept.items() if k] == [1, 4] or {p for p, (k, _) in kept.items() if k} == {1, 4}
    assert "s1" in kept[2][1]


def test_linkage(spark):
    rows = [("의료법 제27조", "x"), ("", "구 약사법 제1조, 표시·광고의 공정화에 관한 법률 제3조"), ("민법 제1조", "화장품법 제2조"), ("", "none"), ("의료기사등에관한법률약사법 제2조", ""), ("", "피고인은 의료법 (2010) 제5조")]
    df = spark.createDataFrame(rows, "refs string, body string")
    got = [(r["domain_label"], r["matched_laws"]) for r in selection.label_precedents(df, "refs", "body").collect()]
    assert got[0] == ("core", ["의료법"])
    assert got[1] == ("core", ["약사법", "표시ㆍ광고의 공정화에 관한 법률"])
    assert got[2] == ("candidate", ["화장품법"]) and got[3] == ("excluded", [])
    assert "약사법" not in got[4][1] and got[5][0] == "core"


def raw(serial, **over):
    return {"판례일련번호": serial, "사건명": "의료법위반", "사건번호": serial, "법원명": "대법원", "선고일자": "20200101", "판시사항": "", "판결요지": "", "참조조문": "", "참조판례": "", "content": "", "source": "s"} | over


def test_ledger(spark):
    law = "의료법 제27조 "
    rows = [
        raw("1", content=law + "문신 의료행위"), raw("2", content="아무 관련 없음"), raw("3", content=law + "숙박업 광고"), raw("4", content=law + "무엇"), raw("5", content=""),
        raw("6", content=law + "문신 광고", 사건번호="X"), raw("7", content=law + "문신 광고 더 길다", 사건번호="X"),
    ]
    df = spark.createDataFrame(rows)
    led = {r["case_serial"]: r for r in selection.ledger(df).collect()}
    assert [led[str(i)]["decision"] for i in range(1, 8)] == ["include", "exclude", "exclude", "review", "exclude", "exclude", "include"]
    assert led["1"]["reason_codes"] == ["TARGET_LAW_CORE", "AESTHETIC_SUBJECT_MATCH", "LEGAL_ISSUE_MATCH"]
    assert led["3"]["reason_codes"][1] == "OUTSIDE_AESTHETIC_DOMAIN" and led["5"]["reason_codes"] == ["MISSING_FULL_TEXT"]
    assert led["4"]["reason_codes"] == ["TARGET_LAW_CORE", "AESTHETIC_SUBJECT_UNCLEAR", "LEGAL_ISSUE_UNCLEAR"]
    assert led["6"]["duplicate_of"] == "7"
    assert selection.selected(df, selection.ledger(df)).count() == 2
    ok = selection.approve(selection.ledger(df), spark.createDataFrame([("4",)], "case_serial string"))
    assert {r["decision"] for r in ok.filter("case_serial = '4'").collect()} == {"include"}
    with pytest.raises(ValueError):
        selection.approve(selection.ledger(df), spark.createDataFrame([("99",)], "case_serial string"))


def test_reviews(spark):
    cases = selection.review_case(spark.createDataFrame([raw("1", content="긴 본문 " * 3000), raw("2", content="문신 시술")]))
    assert len(cases.first()["body"]) < 12100
    said = spark.createDataFrame(
        [("1", ("include", "high", None, None, None, [("body", "없는 말")])), ("2", ("include", "high", None, None, None, [("body", " 문신 "), ("other", "x")]))],
        f"caseSerial string, review {selection.REVIEW.simpleString()}",
    )
    got = {r["caseSerial"]: (r["decision"], r["usableCandidate"], len(r["evidence"])) for r in selection.reviewed(cases.join(said, "caseSerial")).collect()}
    assert got == {"1": ("review", False, 0), "2": ("include", True, 1)}


def test_records_and_release(spark):
    rows = spark.createDataFrame(
        [raw("10", content="본문 하나", 판결유형="null", 데이터출처명="P", 사건종류명="형사", ragTargets=["의료법"], linkage={"의료법": "core"}), raw("9", content="본문 둘", 판결유형="판결", 데이터출처명="P", 사건종류명="형사", ragTargets=[], linkage={}, 사건번호="10")],
        "판례일련번호 string, 사건명 string, 사건번호 string, 법원명 string, 선고일자 string, 판시사항 string, 판결요지 string, 참조조문 string, 참조판례 string, content string, source string, 판결유형 string, 데이터출처명 string, 사건종류명 string, ragTargets array<string>, linkage map<string,string>"
        .replace("판례일련번호", "`판례일련번호`").replace("사건명", "`사건명`").replace("사건번호", "`사건번호`").replace("법원명", "`법원명`").replace("선고일자", "`선고일자`").replace("판시사항", "`판시사항`").replace("판결요지", "`판결요지`")
        .replace("참조조문", "`참조조문`").replace("참조판례", "`참조판례`").replace("판결유형", "`판결유형`").replace("데이터출처명", "`데이터출처명`").replace("사건종류명", "`사건종류명`"),
    ).withColumn("rawArtifactPath", F.lit("")).withColumn("rawArtifactHash", F.lit(""))
    grouped = records.group_ids(rows)
    assert {r["sourceGroupId"] for r in grouped.collect()} == {"group-9"}
    art = spark.createDataFrame([(f"source-native/{s}.xml", "sha256:" + "0" * 64, dt.datetime(2024, 1, 1)) for s in ("9", "10")], "path string, sha256 string, modified timestamp")
    recs = records.judgements(grouped, art, "https://example.org/").cache()
    assert recs.schema.fieldNames() == schemas.RECORD.fieldNames()
    assert validation.violations(recs).count() == 0
    codes = {r["code"] for r in validation.release_findings(recs, spark.createDataFrame([], schemas.MANIFEST)).collect()}
    assert {"sentinel_judgement_type", "body_only_judgement", "duplicate_decision"} <= codes
    files = spark.createDataFrame([("a.jsonl", "records", "sha256:" + "1" * 64, 5, 2)], "path string, kind string, sha256 string, byteSize long, recordCount long")
    m = release.manifest(recs, files, "v1", "s1", "2024-01-01", "d", "me")
    assert release.total_records(m).first()[0] == 2
    assert validation.manifest_violations(m).count() == 0
    validation.assert_supplied(recs, m)
    with pytest.raises(ValueError, match="record_count_mismatch"):
        validation.assert_supplied(recs.limit(1), m)
    with pytest.raises(ValueError):
        records.judgements(grouped, art.limit(1), "u").collect()
    path = "provenance.rawArtifactPath"
    assert validation.records_for_index(recs, ["source-nat"]).count() == 2
    with pytest.raises(validation.EvaluationLeak, match="precedent-10"):
        validation.index_inputs(recs, ["source-native/"])
    assert recs.select(path).first()[0].startswith("source-native/")


def test_statute_records(spark):
    base = {"doc_type": "law_article", "법령명": "화장품법", "법령ID": "001", "MST": "9", "법령구분": "법률", "소관부처": "x", "공포일자": "20200101", "시행일자": "20200201", "조문번호": "0005", "조문가지번호": "2", "조문제목": "목적", "조문시행일자": "", "content": "제5조의2 내용", "별표번호": "", "별표가지번호": "", "별표제목": "", "별표시행일자": "", "contentCleaned": "", "locator": "", "rawArtifactPath": "p", "rawArtifactHash": "sha256:" + "0" * 64}
    appendix = base | {"doc_type": "law_appendix", "별표번호": "1", "contentCleaned": "표", "locator": "별표 1"}
    out = {r["title"]: r for r in records.statutes(spark.createDataFrame([base, appendix]), F.lit("2024-01-01")).collect()}
    assert set(out) == {"화장품법 제5조의2", "화장품법 별표 1"}
    assert out["화장품법 별표 1"]["text"] == "표" and out["화장품법 제5조의2"]["identity"]["statute"]["unitEffectiveOn"] == "20200201"
    with pytest.raises(Exception, match="unsupported|missing"):
        records.statutes(spark.createDataFrame([base | {"doc_type": "x"}]), F.lit("2024-01-01")).collect()
    with pytest.raises(ValueError, match="several units"):
        records.statutes(spark.createDataFrame([base, base]), F.lit("2024-01-01"))


def test_constraints(spark):
    recs = queries.records(spark, SF).limit(3)
    bad = recs.withColumn("admission", F.lit("restricted")).withColumn("documentId", F.lit("bad id"))
    broken = validation.violations(bad).first()["broken"]
    assert {"document_id", "restricted_use"} <= set(broken)
    with pytest.raises(ValueError):
        validation.checked(bad)


def test_retrieval_and_fusion(spark):
    lists = [spark.createDataFrame([("q", d, i) for i, d in enumerate(ds, 1)], "question string, doc string, rank int") for ds in (["a", "b", "c"], ["b", "a", "d"])]
    got = [(r["doc"], r["score"]) for r in retrieval.rank_fusion(lists).orderBy("rank").collect()]
    assert [d for d, _ in got] == ["a", "b", "c", "d"] and got[0][1] == pytest.approx(1 / 61 + 1 / 62)
    weighed = [r["doc"] for r in retrieval.rank_fusion(lists, weights=(1, 5)).orderBy("rank").collect()]
    assert weighed[0] == "b"
    assert retrieval.rank_fusion(lists[:1]).orderBy("rank").first()["score"] == 1 / 61
    with pytest.raises(ValueError):
        retrieval.rank_fusion(lists, weights=(1,))
    docs = spark.createDataFrame([(1, "the cat sat", "cat"), (2, "the dog", None), (3, "a cat and a dog", "x")], "doc int, text string, title string")
    q = spark.createDataFrame([("q1", "Cat!"), ("q2", "none")], "question string, text string")
    r = retrieval.bm25(q, docs, boosts=retrieval.BOOSTS and {"text": 1.0, "title": 0.5}).collect()
    assert [x["doc"] for x in sorted(r, key=lambda x: x["rank"])] == [1, 3]
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0])], "doc int, embedding array<float>")
    qv = spark.createDataFrame([("q", [2.0, 1.0])], "question string, embedding array<float>")
    assert [(x["doc"], x["score"]) for x in retrieval.knn(qv, v).orderBy("rank").collect()] == [(1, 0.8944), (2, 0.4472), (3, 0.0)]
    retrieval.checked_index(v, 2)
    with pytest.raises(ValueError):
        retrieval.checked_index(v, 3)


def test_ranks_are_by_whole_values(spark):
    v = spark.createDataFrame([(1, [1.0, 0.004]), (2, [1.0, 0.0]), (3, None)], "doc int, embedding array<double>")
    q = spark.createDataFrame([("q", [1.0, 0.0])], "question string, embedding array<double>")
    assert [(r["doc"], r["score"]) for r in retrieval.knn(q, v).orderBy("rank").collect()] == [(2, 1.0), (1, 1.0)]
    assert retrieval.knn(q.limit(0), v).count() == 0
    with pytest.raises(Exception, match="finite numbers"):
        retrieval.knn(q, spark.createDataFrame([(1, [1.0])], "doc int, embedding array<double>")).collect()
    docs = spark.createDataFrame([(1, "cat cat dog"), (2, "dog dog cat")], "doc int, text string")
    asked = spark.createDataFrame([("a", "cat dog dog dog")], "question string, text string")
    assert [r["doc"] for r in retrieval.bm25(asked, docs).orderBy("rank").collect()] == [2, 1]


def test_joins_by_place_reviews_and_groups(spark):
    chunks = spark.createDataFrame([(f"c{i:02}", i) for i in range(30)], "chunk_id string, n int")
    vectors = spark.createDataFrame([(i, [float(i)]) for i in range(30)], "pos long, embedding array<double>")
    assert all(r["embedding"] == [float(r["n"])] for r in indexing.with_vectors(chunks, vectors, "chunk_id").collect())
    with pytest.raises(ValueError, match="29 vectors"):
        indexing.with_vectors(chunks, vectors.limit(29), "chunk_id")
    serials = lambda *s: spark.createDataFrame([(x,) for x in s], "serial string")
    assert [r[0] for r in readers.to_review(serials("a", "b", "b"), serials("a", "b", "c"), serials("a")).collect()] == ["b"]
    with pytest.raises(KeyError, match="z"):
        readers.to_review(serials("z"), serials("a"), serials("a"))
    assert validation.shared_groups(spark.createDataFrame([("g",), ("g",), ("h",), (None,), (None,)], "sourceGroupId string")).first()[0] == 1
    at = spark.createDataFrame([("2024-01-02T03:04:05.9",), ("2024-01-02T03:04:05+09:00",), (None,)], "t string").select(F.unix_timestamp(readers.moment(F.col("t"))).alias("s")).collect()
    assert [r["s"] for r in at] == [1704164645, 1704132245, None]


def test_knn_in_blocks(spark, monkeypatch):
    v = spark.createDataFrame([(i, [float(i % 7), float(i % 5), 1.0]) for i in range(60)], "doc int, embedding array<float>")
    q = v.select(F.col("doc").alias("question"), "embedding").limit(20)
    want = sorted(map(tuple, retrieval.knn(q, v, k=5).collect()))
    monkeypatch.setattr(retrieval, "FEW", 3)
    assert sorted(map(tuple, retrieval.knn(q, v, k=5).collect())) == want


def test_answers(spark):
    docs = spark.createDataFrame([("c1", "d1", "First sentence. Second.", "statute", ["note"]), ("c2", "d2", "Other.", "judgement", [])], "chunk_id string, document_id string, text string, document_kind string, record_limitations array<string>")
    fused = spark.createDataFrame([(1, "c1", 1, 0.5), (1, "c2", 2, 0.4)], "question int, doc string, rank int, score double")
    q = spark.createDataFrame([(1, "what"), (2, "nothing")], "question int, text string")

    def by(said):
        return {r["question"]: r for r in answering.answers(q, fused, docs, (lambda p: said) if said else answering.extractive).collect()}

    a = by(None)
    assert a[1]["status"] == "answered" and a[1]["answer"] == "First sentence" and [c["chunk_id"] for c in a[1]["citations"]] == ["c1"]
    assert a[1]["limitations"] == ["Citation c1: note", answering.CURRENT_LAW]
    assert a[2]["status"] == "insufficient_evidence" and a[2]["hits"] == []
    a = by(json.dumps({"status": "answered", "answer": "x", "cited_chunk_ids": ["zz", "c2", "aa", 5]}))
    assert a[1]["limitations"] == ["Model cited unknown chunk_id(s), dropped: aa, zz"] and a[1]["status"] == "answered"
    a = by(json.dumps({"status": "answered", "answer": "x", "cited_chunk_ids": ["zz"]}))
    assert a[1]["status"] == "insufficient_evidence" and "never retrieved: zz" in a[1]["limitations"][0] and len(a[1]["hits"]) == 2
    assert by(json.dumps({"status": "out_of_scope", "answer": "x"}))[1]["status"] == "out_of_scope"
    a = by("not json")
    assert a[1]["status"] is None and "no JSON" in a[1]["error"] and a[1]["answer"] is None and a[2]["status"] == "insufficient_evidence"
    with pytest.raises(Exception, match="no JSON"):
        answering.answers(q, fused, docs, lambda p: "not json", strict=True).collect()

    def down(p):
        raise ConnectionError("gone")

    r = answering.answers(q, fused, docs, down).filter("question = 1").first()
    assert r["status"] == "dependency_unavailable" and r["hits"] == []


def test_responses():
    good = '{"status": "answered", "answer": "a", "cited_chunk_ids": ["c"]}'
    for t in (good, f"```json\n{good}\n```", f"```\n{good}\n```", good + " and more", f"```json\n{good}\n```\nmore prose"):
        assert R.read_answer(t)["cited_chunk_ids"] == ["c"], t
    assert R.read_answer("[]")["error"] and R.read_answer("{")["error"]
    assert R.read_answer('{"status": "new"}')["status"] == "insufficient_evidence"
    assert R.read_answer('{"status": "answered", "cited_chunk_ids": null}')["cited_chunk_ids"] == []
    assert R.read_verdict('{"grounding": "grounded"}') == {"grounding": "grounded", "justification": "", "error": None}
    assert R.read_verdict('{"grounding": "grounded"} more')["error"] and R.read_verdict('{"grounding": "x"}')["error"]


def test_judge_and_embedder(spark):
    rows = spark.createDataFrame([("q", "a", [("t",)])], "question string, answer string, passages array<struct<text:string>>")
    r = answering.judged(rows, lambda p: '{"grounding": "unsupported", "justification": "j"}').first()
    assert (r["grounding"], r["justification"], r["judge_error"]) == ("unsupported", "j", None)
    c = spark.createDataFrame([(f"t{i}",) for i in range(70)], "text string")
    assert answering.embedded(c, lambda t: [[float(len(x)), 0.0] for x in t], 2).count() == 70
    with pytest.raises(Exception, match="vectors"):
        answering.embedded(c, lambda t: [[0.0]], 2).collect()


def test_token_budget():
    now = [0.0]
    b = answering.TokenBudget(100, lambda: now[0])
    assert b.consume(60) == 0 and b.consume(40) == 0
    now[0] = 10.0
    assert b.consume(1) == 50.0
    now[0] = 130.0
    assert b.consume(100) == 0


def test_metrics(spark):
    q = spark.createDataFrame([(1, ["a"]), (2, ["z"]), (3, ["b"])], "question int, relevant array<string>")
    ranked = spark.createDataFrame([(1, "a", 1), (2, "y", 1), (3, "x", 1), (3, "b", 2)], "question int, doc string, rank int")
    m = evaluation.recall_mrr(evaluation.scored(q, ranked)).first()
    assert (m["recall"], m["mrr"], m["n"]) == (pytest.approx(2 / 3), pytest.approx(0.5), 3)
    assert {r["k"]: round(r["recall"], 3) for r in evaluation.recall_curve(q, ranked).collect()} == {1: 0.333, 3: 0.667, 5: 0.667, 10: 0.667, 20: 0.667}
    assert evaluation.either_retriever(q, [ranked]).first()[0] == pytest.approx(2 / 3)
    res = spark.createDataFrame(
        [("answered", "answered", ["l"], "grounded", None, 10, 1), ("answered", "insufficient_evidence", [], None, None, 10, 1), ("out_of_scope", "out_of_scope", [], None, "bad", 10, 1)],
        "expected_status string, status string, limitations array<string>, grounding string, judge_error string, tokens_in int, tokens_out int",
    )
    a = evaluation.answer_metrics(res).first()
    assert a["answered_status_match_rate"] == 0.5 and a["insufficient_evidence_refusal_accuracy"] is None and a["false_refusal_count"] == 1
    assert a["judge_parse_error_count"] == 1 and a["limitations_fired_count"] == 1 and a["estimated_cost_usd"] == pytest.approx(0.000135)


def test_sources(spark, tmp_path):
    rec = {"documentId": "a", "documentKind": "judgement", "identity": {"documentKind": "judgement", "caseSerial": "1"}, "provenance": {"provider": "p"}, "linkedLaws": []}
    good, bad = tmp_path / "good.jsonl", tmp_path / "bad.jsonl"
    good.write_text(json.dumps(rec) + "\n\n" + json.dumps(rec | {"documentId": "b\u2028"}, ensure_ascii=False) + "\n")
    assert schemas.read_records(spark, [str(good)]).count() == 2
    assert schemas.read_records(spark, [str(good)]).first()["identity"]["judgement"]["caseSerial"] == "1"
    bad.write_text(json.dumps(rec | {"identity": {"caseSerial": "1", "extra": 2}}))
    with pytest.raises(ValueError, match="extra"):
        schemas.read_records(spark, [str(bad)])
    simple = schemas.typed({"a": "string"})
    assert readers.read_jsonl(spark, str(tmp_path / "none"), simple).count() == 0
    with pytest.raises(FileNotFoundError):
        readers.read_jsonl(spark, str(tmp_path / "none"), simple, missing_ok=False)
    d = readers.described_files(spark, [str(good)], "records").first()
    assert d["byteSize"] == good.stat().st_size
    xml = "<법령><조문><조문단위><조문번호>1</조문번호><조문여부>조문</조문여부><조문내용>제1조</조문내용><항><항내용>① 가</항내용>\n<호><호내용>1. 나</호내용>\n<목><목내용>가. 다</목내용></목></호></항></조문단위><조문단위><조문번호>2</조문번호><조문여부>조문</조문여부><조문내용>제2조</조문내용></조문단위><조문단위><조문번호>1</조문번호><조문여부>전문</조문여부><조문내용>제1장</조문내용></조문단위></조문></법령>"
    rows = readers.law_articles(spark.createDataFrame([("m", xml)], "mst string, xml string")).orderBy("조문번호").collect()
    assert [r["content"] for r in rows] == ["제1조\n① 가\n1. 나\n가. 다", "제2조"]
    for broken in (xml[:-9], "<법령></법령>"):
        with pytest.raises(Exception, match="no XML|no article"):
            readers.law_articles(spark.createDataFrame([(broken,)], "xml string")).collect()
    app = "<법령><별표><별표단위><별표번호>0001</별표번호><별표구분>별표</별표구분><별표내용>표 내용</별표내용></별표단위><별표단위><별표번호>2</별표번호><별표구분>서식</별표구분><별표내용>x</별표내용></별표단위></별표></법령>"
    got = {r["별표번호"]: (r["reason"], r["locator"]) for r in readers.law_appendices(spark.createDataFrame([(app,)], "xml string")).collect()}
    assert got == {"0001": (None, "별표 1"), "2": ("form", "별표 2")}
    found = spark.createDataFrame([("q", "법", "법률", 2), ("q", "법", "대통령령", 1), ("r", "다른", "법률", 1)], "query string, `법령명` string, `법령구분` string, pos int")
    assert [r["pos"] for r in readers.resolve_law(found, "법", "법률").collect()] == [2]
    assert readers.resolve_law(found, "법", "법률", strict=False).count() == 2
    out = tmp_path / "pub"
    readers.publish(spark.range(3), str(out))
    with pytest.raises(ValueError):
        readers.publish(spark.range(1), str(out), complete=False)
    assert spark.read.json(str(out)).count() == 3
    blobs = spark.createDataFrame([(bytearray(b"x"),), (bytearray(b"x"),), (bytearray(b"y"),)], "content binary")
    none = spark.createDataFrame([], "path string, content binary")
    assert readers.new_artifacts(blobs, none).count() == 2
    with pytest.raises(ValueError):
        readers.new_artifacts(blobs, spark.createDataFrame([("artifacts/zz", bytearray(b"x"))], "path string, content binary"))


def test_archives_are_reproducible():
    files = {"b": b"2", "a": b"1"}
    assert release.tar_bytes(files) == release.tar_bytes(dict(sorted(files.items())))
    assert release.zip_bytes(files) == release.zip_bytes(dict(sorted(files.items())))
    assert release.checksums(files).splitlines()[0].endswith("  a")


def test_streaming(spark, tmp_path):
    from quillspark.streaming import resume

    src, out = tmp_path / "in", tmp_path / "out"
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "serial string, v int").coalesce(1).write.json(str(src))
    stream = lambda: spark.readStream.schema("serial string, v int").json(str(src))
    resume.merge_into(stream(), str(out), "serial", str(tmp_path / "cp")).awaitTermination()
    spark.createDataFrame([("b", 4), ("c", 5)], "serial string, v int").coalesce(1).write.mode("append").json(str(src))
    resume.merge_into(stream(), str(out), "serial", str(tmp_path / "cp")).awaitTermination()
    assert sorted(r["serial"] for r in spark.read.parquet(str(out)).collect()) == ["a", "b", "c"]
    q = resume.first_of_each(stream(), "serial").writeStream.format("memory").queryName("firsts").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("firsts").count() == 3
