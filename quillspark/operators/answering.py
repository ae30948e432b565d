"""Grounded answers: from fused hits and a generator's text to responses.

A batch of questions is one plan: hits are gathered by question, a generator
runs over Arrow batches, its text is parsed, and cited ids are held against
what was retrieved. An answer stands only on ids that were; others are named in
its limitations.
"""

from __future__ import annotations

import json
import time
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions import responses as rs
from quillspark.functions import text as tx
from quillspark.operators.batches import bounded

#: What an answer that rests on a statute says of the law's date.
CURRENT_LAW = "Cited statutes are as of the dataset's freeze; check that they are still in force."
CONNECTIVITY = (ConnectionError, TimeoutError)


class Generator(Protocol):
    def __call__(self, prompt: str) -> str: ...


class Embedder(Protocol):
    def __call__(self, texts: list[str]) -> list[list[float]]: ...


def extractive(prompt: str) -> str:
    """A generator without a model: it answers with the first sentence of the first passage and cites it."""
    passages = prompt.partition("Passages:\n")[2].rpartition("\n\nQuestion:")[0]
    head, _, body = passages.partition("\n")
    if not head.startswith("["):
        return json.dumps({"status": "insufficient_evidence", "answer": None, "cited_chunk_ids": []})
    return json.dumps({"status": "answered", "answer": body.split(". ")[0], "cited_chunk_ids": [head[1:-1]]}, ensure_ascii=False)


#: Tokens that an answer may have, if nothing else is said.
MAX_TOKENS = 4096
# Fixed value: how a model says that it stopped at that number.
TRUNCATED = "max_tokens"


@dataclass(frozen=True)
class Reply:
    """What a model said, what it read and wrote for it, and why it stopped."""

    text: str | None
    tokens_in: int = 0
    tokens_out: int = 0
    stop: str | None = None


class Model(Protocol):
    def __call__(self, prompt: str, max_tokens: int) -> Reply: ...


def plain(generator: Generator) -> Model:
    """A generator of texts as a model, without counts."""

    def reply(prompt, max_tokens):
        return Reply(generator(prompt))

    return reply


def _reply(model: Model, prompt: str | None, max_tokens: int) -> tuple:
    """(raw, tokens_in, tokens_out, stop, failure, error) of one prompt; none is sent where it is null."""
    if prompt is None:
        return None, 0, 0, None, None, None
    try:
        r = model(prompt, max_tokens)
    except CONNECTIVITY as e:
        return None, 0, 0, None, f"{type(e).__name__}: {e}", None
    if r.stop == TRUNCATED:  # the text is a fragment, which would only be called unreadable
        return None, r.tokens_in, r.tokens_out, r.stop, None, f"truncated: the model hit max_tokens ({max_tokens}) before its answer was whole"
    return r.text, r.tokens_in, r.tokens_out, r.stop, None, None


def replied(prompts: DataFrame, model: Model, max_tokens: int = MAX_TOKENS, prompt: str = "prompt") -> DataFrame:
    """prompts with raw, tokens_in, tokens_out, stop, failure and error, a call for each prompt that isn't null.

    Connectivity errors are failure; an answer that was cut off is error, its tokens counted; all other exceptions stop the job.
    Columns of these names are replaced. A task that Spark runs again asks again, and what was paid for its first attempt isn't in the rows.
    """
    names = ["raw", "tokens_in", "tokens_out", "stop", "failure", "error"]
    kept = prompts.drop(*names)

    def run(batches):
        import pyarrow as pa

        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        for batch in bounded(batches, prompt):
            said = [_reply(model, p, max_tokens) for p in batch.column(prompt).to_pylist()]
            own = [pa.array([r[i] for r in said], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=[*batch.schema.names, *names])

    said = T.StructType.fromDDL("raw string, tokens_in long, tokens_out long, stop string, failure string, error string")
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *said.fields]))


def accounted(replies: DataFrame, name: str, prompt: str = "prompt") -> tuple[DataFrame, Observation]:
    """The replies, and an observation of their totals, which is filled by the first action on them: calls, tokens_in, tokens_out, truncated, unavailable."""
    totals = Observation(name)
    zero = lambda c: F.coalesce(c, F.lit(0))
    seen = replies.observe(
        totals, F.count(prompt).alias("calls"), zero(F.sum("tokens_in")).alias("tokens_in"), zero(F.sum("tokens_out")).alias("tokens_out"),
        F.count_if(F.col("stop") == TRUNCATED).alias("truncated"), F.count("failure").alias("unavailable"),
    )
    return seen, totals


def generated(prompts: DataFrame, generator: Generator, prompt: str = "prompt") -> DataFrame:
    """prompts with raw and failure: connectivity errors become text in failure, all others stop the job."""
    return replied(prompts, plain(generator), prompt=prompt).drop("tokens_in", "tokens_out", "stop", "error")


def _texts(c: Column) -> Column:
    return F.array_join(c, ", ")


def grounded(rows: DataFrame) -> DataFrame:
    """rows (parsed: status, answer, cited_chunk_ids; fused: array of structs with chunk_id; known: array of structs with chunk_id, document_kind, record_limitations) with status, answer, citations, limitations.

    known may hold more than fused: caveats are taken from it, citations only from fused.
    """
    p, none = F.col("parsed"), F.array().cast("array<string>")
    ids = F.transform("fused", lambda h: h["chunk_id"])
    cited = F.coalesce(p["cited_chunk_ids"], none)
    real = F.filter(cited, lambda c: F.array_contains(ids, c))
    false = F.array_sort(F.array_distinct(F.filter(cited, lambda c: ~F.array_contains(ids, c))))
    claimed = p["status"] == "answered"
    stands = claimed & (F.size(real) > 0) & (tx.strip(F.coalesce(p["answer"], F.lit(""))) != "")
    detail = F.when(F.size(cited) > 0, F.concat(F.lit("claimed chunk_id(s) never retrieved: "), _texts(F.array_sort(F.array_distinct(cited))))).otherwise(F.lit("claimed no chunk_id(s) at all"))
    empty = F.array(F.concat(F.lit("Model claimed status=answered with zero real citations ("), detail, F.lit(").")))
    dropped = F.when(F.size(false) > 0, F.array(F.concat(F.lit("Model cited unknown chunk_id(s), dropped: "), _texts(false)))).otherwise(none)
    of = F.map_from_entries(F.transform("known", lambda k: F.struct(k["chunk_id"], k)))
    at = lambda c: F.try_element_at(of, c)
    notes = F.array_distinct(
        F.flatten(F.transform(cited, lambda c: F.transform(F.coalesce(at(c)["record_limitations"], none), lambda n: F.concat(F.lit("Citation "), c, F.lit(": "), n))))
    )
    statute = F.when(F.exists(cited, lambda c: F.coalesce(at(c)["document_kind"] == "statute", F.lit(False))), F.array(F.lit(CURRENT_LAW))).otherwise(none)
    return rows.select(
        *[c for c in rows.columns if c not in ("status", "answer", "citations", "limitations")],
        F.when(claimed & ~stands, "insufficient_evidence").otherwise(F.coalesce(p["status"], F.lit("insufficient_evidence"))).alias("status"),
        F.when(stands, p["answer"]).alias("answer"),
        F.when(stands, F.transform(real, lambda c: F.element_at(F.filter("fused", lambda h: h["chunk_id"] == c), 1))).otherwise(F.array().cast(rows.schema["fused"].dataType)).alias("citations"),
        F.when(stands, F.concat(dropped, notes, statute)).when(claimed & (F.size(real) == 0), empty).otherwise(none).alias("limitations"),
    )


def answers(
    questions: DataFrame, fused: DataFrame, docs: DataFrame, generator: Callable[[str], str] = extractive, question: str = "question", text: str = "text", doc: str = "chunk_id",
    model: Model | None = None, max_tokens: int = MAX_TOKENS, strict: bool = False,
) -> DataFrame:
    """(question, status, answer, citations, limitations, hits, tokens_in, tokens_out, error) for each question; one without hits isn't sent to the model.

    An answer that was cut off or can't be read is an error of its row, which has no status then; the others of the batch stand. strict raises it.
    A model takes the generator's place where one is given.
    """
    own = docs.select(F.col(doc).alias("doc"), "document_id", F.col(text).alias("~text"), "document_kind", F.coalesce("record_limitations", F.array().cast("array<string>")).alias("record_limitations"))
    hit = F.struct("rank", F.col("doc").cast("string").alias("chunk_id"), "document_id", "score", tx.excerpt("~text").alias("excerpt"), F.col("~text").alias("text"), "document_kind", "record_limitations")
    by_question = fused.join(own, "doc").groupBy(question).agg(F.sort_array(F.collect_list(hit)).alias("fused"))
    rows = questions.select(question, F.col(text).alias("~q")).join(by_question, question, "left")
    prompt = F.when(F.size("fused") > 0, rs.answer_prompt(F.col("~q"), F.transform("fused", lambda h: F.struct(h["chunk_id"].alias("chunk_id"), h["text"].alias("text")))))
    said = replied(rows.withColumn("prompt", prompt), model or plain(generator), max_tokens)
    parsed = said.withColumn("parsed", rs.parse_answer("raw")).withColumn("fused", F.coalesce("fused", F.array().cast(said.schema["fused"].dataType))).withColumn("known", F.col("fused"))
    error = F.coalesce(F.col("error"), F.when(F.col("raw").isNotNull(), F.col("parsed.error")))
    if strict:
        error = F.when(error.isNotNull(), F.raise_error(error).cast("string"))
    done = grounded(parsed.withColumn("error", error))
    none = F.lit(None)
    return done.select(
        question,
        F.when(F.col("failure").isNotNull(), "dependency_unavailable").when(F.col("error").isNotNull(), none).otherwise(F.col("status")).alias("status"),
        "answer",
        F.transform("citations", lambda c: F.struct(c["document_id"].alias("document_id"), c["chunk_id"].alias("chunk_id"), c["excerpt"].alias("excerpt"))).alias("citations"),
        "limitations",
        F.when(F.col("failure").isNotNull(), F.array().cast("array<struct<document_id:string,chunk_id:string,rank:int,score:double>>"))
        .otherwise(F.transform("fused", lambda h: F.struct(h["document_id"].cast("string").alias("document_id"), h["chunk_id"].cast("string").alias("chunk_id"), h["rank"].alias("rank"), h["score"].alias("score"))))
        .alias("hits"),
        "tokens_in",
        "tokens_out",
        "error",
    )


def judged(rows: DataFrame, judge: Generator | None = None, model: Model | None = None, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """rows (question, answer, passages: array<struct<text>>) with grounding, justification, judge_error and the judge's tokens, which count whether its verdict can be read or not.

    An answer that is null isn't judged. What a verdict is missing for is judge_error: cut off, unreadable, or no connection.
    """
    prompt = F.when(F.col("answer").isNotNull(), rs.judge_prompt(F.col("question"), F.col("answer"), F.col("passages")))
    said = replied(rows.select(F.struct(*rows.columns).alias("row"), prompt.alias("prompt")), model or plain(judge), max_tokens)
    error = F.coalesce(F.col("error"), F.col("failure"), F.when(F.col("prompt").isNotNull(), F.col("~v.error")))
    return said.withColumn("~v", rs.parse_verdict("raw")).select("row.*", "~v.grounding", "~v.justification", error.alias("judge_error"), F.col("tokens_in").alias("judge_tokens_in"), F.col("tokens_out").alias("judge_tokens_out"))


def embedded(chunks: DataFrame, embedder: Embedder, dimension: int, text: str = "text", batch: int = 32, vector: str = "embedding") -> DataFrame:
    """chunks with vectors, asked for in batches in order; another number or size of vectors raises."""

    def run(batches):
        for pdf in batches:
            vectors: list[list[float]] = []
            for i in range(0, len(pdf), batch):
                vectors += _vectors(embedder, pdf[text].iloc[i : i + batch].tolist(), dimension)
            yield pdf.assign(**{vector: vectors})

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chunks.schema.fields)
    return chunks.mapInPandas(run, f"{ddl}, `{vector}` array<float>")


def _vectors(embedder: Embedder, texts: list[str], dimension: int) -> list[list[float]]:
    got = embedder(texts)
    if len(got) != len(texts) or any(len(v) != dimension for v in got):
        raise ValueError(f"{len(texts)} vectors of {dimension} components are expected")
    return got


class SlidingBudget:
    """Tokens that any window of seconds allows, wherever it begins."""

    def __init__(self, limit: int, clock: Callable[[], float], window: float = 60.0):
        self.limit, self.clock, self.window = limit, clock, window
        self.sent: deque[tuple[float, int]] = deque()

    def wait(self, tokens: int) -> float:
        """The seconds after which so many may be sent."""
        if tokens > self.limit:
            raise ValueError(f"{tokens} tokens are more than the {self.limit} that a window allows")
        now = self.clock()
        while self.sent and self.sent[0][0] <= now - self.window:
            self.sent.popleft()
        spent, wait = sum(t for _, t in self.sent), 0.0
        for at, t in self.sent:
            if spent + tokens <= self.limit:
                break
            spent, wait = spent - t, at + self.window - now
        return max(0.0, wait)

    def record(self, tokens: int) -> None:
        self.sent.append((self.clock(), tokens))


def token_batches(sizes: list[int], most_texts: int, most_tokens: int) -> list[slice]:
    """Runs of texts, in order, of at most so many texts and tokens each."""
    out, first, tokens = [], 0, 0
    for i, n in enumerate(sizes):
        if i > first and (i - first == most_texts or tokens + n > most_tokens):
            out.append(slice(first, i))
            first, tokens = i, 0
        tokens += n
    return [*out, slice(first, len(sizes))] if sizes else out


def paced(
    chunks: DataFrame, embedder: Embedder, dimension: int, limit: int, tasks: int, text: str = "text", batch: int = 32, vector: str = "embedding", window: float = 60.0,
    tokens: Callable[[str], int] = len, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep, on_batch: Callable[[int, int], None] | None = None,
) -> DataFrame:
    """chunks with vectors and `sent` (task, call, at, tokens: by what call a row was asked for), no more than `limit` tokens in any window of seconds over all tasks.

    The limit is shared out: the rows go to `tasks` partitions, of which each keeps limit / tasks in every window, so together they
    keep the limit however many run at once. A task's later attempt first waits a window, in which what its earlier one sent runs out.
    Speculative copies would spend beside the original, so they must be off. A text of more tokens than a task's share raises: fewer tasks are needed.
    on_batch(tokens, calls so far) is called in the task after each batch that came back. A null text counts as empty.
    The rows must not be computed by two actions at once; write them.
    """
    conf = chunks.sparkSession.conf
    if conf.get("spark.speculation", "false") == "true":
        raise ValueError("spark.speculation must be off where a limit is shared out")
    share = limit // tasks
    if share < 1:
        raise ValueError(f"a limit of {limit} can't be shared out to {tasks} tasks")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        call = pa.struct([("task", pa.int32()), ("call", pa.int32()), ("at", pa.float64()), ("tokens", pa.int64())])
        context = TaskContext.get()
        if context.attemptNumber():
            sleep(window)
        budget, calls = SlidingBudget(share, clock, window), 0
        for rows in bounded(batches, text):
            texts = [t or "" for t in rows.column(text).to_pylist()]
            sizes = [tokens(t) for t in texts]
            vectors, sent = [], []
            for part in token_batches(sizes, batch, share):
                n = sum(sizes[part])
                if (wait := budget.wait(n)) > 0:
                    sleep(wait)
                at = clock()
                budget.record(n)
                vectors += _vectors(embedder, texts[part], dimension)
                calls += 1
                sent += [{"task": context.partitionId(), "call": calls, "at": at, "tokens": n}] * (part.stop - part.start)
                if on_batch:
                    on_batch(n, calls)
            own = [pa.array(vectors, pa.list_(pa.float32())), pa.array(sent, call)]
            yield pa.RecordBatch.from_arrays([*rows.columns, *own], names=[*rows.schema.names, vector, "sent"])

    asked = chunks.drop(vector, "sent")
    own = T.StructType.fromDDL(f"`{vector}` array<float>, sent struct<task:int,call:int,at:double,tokens:long>")
    return asked.repartition(tasks).mapInArrow(run, T.StructType([*asked.schema.fields, *own.fields]))


class TokenBudget:
    """Tokens a window of seconds allows; says how long to wait before more are sent. The window begins with what is sent first in it."""

    def __init__(self, limit: int, clock: Callable[[], float], window: float = 60.0):
        self.limit, self.clock, self.window = limit, clock, window
        self.since, self.spent = clock(), 0

    def consume(self, tokens: int) -> float:
        now = max(self.clock(), self.since)
        left = self.since + self.window - now
        wait = left if left > 0 and self.spent + tokens > self.limit else 0.0
        if left <= 0 or wait:
            self.since, self.spent = now + wait, 0
        self.spent += tokens
        return wait
