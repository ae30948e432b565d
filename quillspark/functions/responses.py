"""Prompts for models, and what their answers say."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.sources.schemas import typed

ANSWER = typed({"status": "string", "answer": "string", "cited_chunk_ids": ["string"], "error": "string"})
VERDICT = typed({"grounding": "string", "justification": "string", "error": "string"})
# Fixed values.
STATUSES = ("answered", "out_of_scope", "insufficient_evidence", "dependency_unavailable")
GROUNDINGS = ("grounded", "partially_grounded", "unsupported")
PROMPT_VERSION, JUDGE_PROMPT_VERSION = "prompt-v2", "judge-prompt-v2"


def unfenced(raw: str) -> str:
    """What stands in a Markdown fence that a text begins with; other texts as they are, without white space around them."""
    text = raw.strip()
    if not text.startswith("```"):
        return text
    _, _, body = text.partition("\n")
    head, _, last = body.rpartition("\n")
    return (head if last.strip().startswith("```") else body).strip()


def read_answer(raw: str | None) -> dict:
    """The first JSON value of an answer, which must be an object; what comes after it doesn't count. error says why there is none."""
    try:
        value, _ = json.JSONDecoder().raw_decode(unfenced(raw or ""))
    except ValueError as e:
        return {"status": None, "answer": None, "cited_chunk_ids": [], "error": f"no JSON: {e}"}
    if not isinstance(value, dict):
        return {"status": None, "answer": None, "cited_chunk_ids": [], "error": "the answer is no JSON object"}
    status = value.get("status")
    if status != "answered":
        return {"status": "out_of_scope" if status == "out_of_scope" else "insufficient_evidence", "answer": None, "cited_chunk_ids": [], "error": None}
    cited, answer = value.get("cited_chunk_ids"), value.get("answer")
    return {"status": status, "answer": answer if isinstance(answer, str) else None, "cited_chunk_ids": [c for c in cited if isinstance(c, str)] if isinstance(cited, list) else [], "error": None}


def read_verdict(raw: str | None) -> dict:
    """A judge's answer, which must be one JSON object and nothing else."""
    try:
        value = json.loads(unfenced(raw or ""))
    except ValueError as e:
        return {"grounding": None, "justification": None, "error": f"no JSON: {e}"}
    if not isinstance(value, dict) or value.get("grounding") not in GROUNDINGS:
        return {"grounding": None, "justification": None, "error": "no known verdict"}
    return {"grounding": value["grounding"], "justification": str(value.get("justification") or ""), "error": None}


@F.pandas_udf(ANSWER)
def parse_answer(raw: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_answer(r) for r in raw], columns=["status", "answer", "cited_chunk_ids", "error"])


@F.pandas_udf(VERDICT)
def parse_verdict(raw: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_verdict(r) for r in raw], columns=["grounding", "justification", "error"])


@F.pandas_udf(typed(["string"]))
def parse_reviews(raw: pd.Series) -> pd.Series:
    """The objects of a JSON array, each as JSON; null if there is no array. First and last line of a fenced text go."""

    def one(r):
        text = (r or "").strip()
        if text.startswith("```"):
            text = text.partition("\n")[2].rpartition("\n")[0]
        try:
            value = json.loads(text)
        except ValueError:
            return None
        return [json.dumps(v, ensure_ascii=False) for v in value if isinstance(v, dict)] if isinstance(value, list) else None

    return raw.map(one)


def answer_prompt(question: Column, chunks: Column) -> Column:
    """A question with its chunks (array<struct<chunk_id, text>>)."""
    shown = F.array_join(F.transform(chunks, lambda c: F.concat(F.lit("["), c["chunk_id"], F.lit("]\n"), c["text"])), "\n\n")
    rules = (
        'Answer only from the passages. Reply with one JSON object: {"status": "answered" | "insufficient_evidence" | "out_of_scope", '
        '"answer": string or null, "cited_chunk_ids": [ids of the passages that the answer rests on]}.'
    )
    return F.concat(F.lit(f"{rules}\n\nPassages:\n"), shown, F.lit("\n\nQuestion: "), question)


def judge_prompt(question: Column, answer: Column, chunks: Column) -> Column:
    shown = F.array_join(F.transform(chunks, lambda c: c["text"]), "\n\n")
    rules = 'Say whether the passages support the answer. Reply with one JSON object: {"grounding": "grounded" | "partially_grounded" | "unsupported", "justification": string}.'
    return F.concat(F.lit(f"{rules}\n\nQuestion: "), question, F.lit("\n\nAnswer: "), answer, F.lit("\n\nPassages:\n"), shown)
