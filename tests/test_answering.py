"""Accounting of model calls, and vectors asked for within a limit."""

import json

import pytest

from quillspark.operators import answering
from quillspark.operators.answering import Reply


def model(prompt, max_tokens):
    if "lost" in prompt:
        raise ConnectionError("gone")
    if "long" in prompt:
        return Reply('{"status": "answ', 7, max_tokens, "max_tokens")
    if "prose" in prompt:
        return Reply("I think so", 5, 3, "end_turn")
    return Reply(json.dumps({"status": "answered", "answer": "x", "cited_chunk_ids": ["c1"], "grounding": "grounded", "justification": "j"}), 10, 2, "end_turn")


def test_totals_are_the_sums_of_rows(spark):
    prompts = spark.createDataFrame([(1, "fine"), (2, "long"), (3, None), (4, "lost"), (5, "prose"), (6, "fine")], "id int, prompt string").repartition(3)
    replies, totals = answering.accounted(answering.replied(prompts, model, 50), "calls")
    rows = {r["id"]: r for r in replies.collect()}
    assert totals.get == {"calls": 5, "tokens_in": 32, "tokens_out": 57, "truncated": 1, "unavailable": 1}
    assert sum(r["tokens_in"] for r in rows.values()) == 32 and sum(r["tokens_out"] for r in rows.values()) == 57
    assert rows[2]["raw"] is None and "max_tokens (50)" in rows[2]["error"] and rows[2]["tokens_out"] == 50
    assert rows[4]["failure"] == "ConnectionError: gone" and rows[4]["error"] is None
    assert rows[3]["raw"] is None and rows[3]["tokens_in"] == 0 and rows[5]["raw"] == "I think so"
    none, totals = answering.accounted(answering.replied(prompts.limit(0), model), "none")
    assert none.count() == 0 and totals.get["tokens_in"] == 0


def test_errors_are_of_their_rows(spark):
    docs = spark.createDataFrame([("c1", "d1", "Text.", "judgement", None)], "chunk_id string, document_id string, text string, document_kind string, record_limitations array<string>")
    asked = [(1, "fine"), (2, "long"), (3, "prose"), (4, "lost"), (5, "without hits")]
    q = spark.createDataFrame(asked, "question int, text string")
    fused = spark.createDataFrame([(i, "c1", 1, 0.5) for i in range(1, 5)], "question int, doc string, rank int, score double")
    rows = {r["question"]: r for r in answering.answers(q, fused, docs, model=model, max_tokens=9).collect()}
    assert [rows[i]["status"] for i in range(1, 6)] == ["answered", None, None, "dependency_unavailable", "insufficient_evidence"]
    assert rows[2]["error"].startswith("truncated") and rows[3]["error"].startswith("no JSON") and rows[1]["error"] is None
    assert [(rows[i]["tokens_in"], rows[i]["tokens_out"]) for i in range(1, 6)] == [(10, 2), (7, 9), (5, 3), (0, 0), (0, 0)]
    assert rows[2]["answer"] is None and rows[2]["citations"] == [] and len(rows[2]["hits"]) == 1


def test_a_judges_tokens_count_without_a_verdict(spark):
    rows = spark.createDataFrame([(1, "q", a, [("p",)], "kept") for a in ("fine", "long", "prose", "lost", None)], "id int, question string, answer string, passages array<struct<text:string>>, error string")
    got = {r["answer"]: r for r in answering.judged(rows, model=model, max_tokens=4).collect()}
    assert got["fine"]["grounding"] == "grounded" and got["fine"]["judge_error"] is None and got["fine"]["error"] == "kept"
    assert got["long"]["judge_error"].startswith("truncated") and (got["long"]["judge_tokens_in"], got["long"]["judge_tokens_out"]) == (7, 4)
    assert got["prose"]["judge_error"].startswith("no JSON") and got["prose"]["judge_tokens_out"] == 3
    assert got["lost"]["judge_error"] == "ConnectionError: gone" and got[None]["judge_error"] is None and got[None]["judge_tokens_in"] == 0


class Clock:
    """Time that passes in sleep and with each call alone."""

    def __init__(self):
        self.now = 0.0

    def __call__(self):
        return self.now

    def sleep(self, seconds):
        self.now += seconds


def test_no_window_exceeds_the_limit_over_four_tasks(spark):
    clock = Clock()

    def embedder(texts):
        clock.sleep(1.5)
        return [[float(len(t))] for t in texts]

    chunks = spark.createDataFrame([(i, "x" * (1 + i * 7 % 40) if i else None, "sent") for i in range(600)], "id int, text string, other string")
    rows = answering.paced(chunks, embedder, 1, limit=1000, tasks=4, batch=16, clock=clock, sleep=clock.sleep).collect()
    assert {r["id"]: r["embedding"] for r in rows} == {i: [float(1 + i * 7 % 40 if i else 0)] for i in range(600)}
    calls = sorted({(r["sent"]["at"], r["sent"]["task"], r["sent"]["call"], r["sent"]["tokens"]) for r in rows})
    assert len({c[1] for c in calls}) == 4 and max(c[0] for c in calls) > 120
    for at, *_ in calls:
        assert sum(c[3] for c in calls if at - 60 < c[0] <= at) <= 1000
    assert sum(c[3] for c in calls) == sum(len(t or "") for _, t, _ in chunks.collect())


def test_pacing_says_what_it_cannot_do(spark):
    chunks = spark.createDataFrame([("x" * 30,)], "text string")
    with pytest.raises(Exception, match="more than the 25"):
        answering.paced(chunks, lambda t: [[0.0]] * len(t), 1, limit=100, tasks=4).collect()
    with pytest.raises(ValueError, match="shared out to 4"):
        answering.paced(chunks, lambda t: [], 1, limit=3, tasks=4)
    budget = answering.SlidingBudget(10, lambda: 0.0)
    budget.record(6)
    assert budget.wait(4) == 0.0 and budget.wait(5) == 60.0
    assert answering.token_batches([5, 5, 5, 20, 1], 2, 10) == [slice(0, 2), slice(2, 3), slice(3, 4), slice(4, 5)]
    assert answering.token_batches([], 2, 10) == []
