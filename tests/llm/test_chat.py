import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import chat
from quillspark.llm.queries import ADVERSARY

BITS = st.lists(st.sampled_from(["<|im_start|>", "<|im_end|>", "<|", "|>", "\\", "<", "|", "\n", "user", "a", "é", " "]), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(BITS, BITS), max_size=5))
def test_round_trip(turns):
    out = "".join(chat.render(r, t)[0] for r, t in turns)
    assert list(chat.parse(out)) == turns


def test_only_conflicts_are_escaped():
    assert chat.render("user", "a < b | c")[0] == "<|im_start|>user\na < b | c<|im_end|>\n"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def want(rows):
    loss = "".join(t or "" for r, t in rows if r == "assistant")
    return len(rows), sha("".join(f"{r or ''}\n{t or ''}\n" for r, t in rows)), len(loss), sha(loss)


def test_digests_and_parts(spark, monkeypatch):
    convs = {
        -1: [("user", ADVERSARY), ("assistant", ADVERSARY)],
        1: [("system", ""), ("user", None), ("assistant", "é" * 1000), ("user", "x"), ("assistant", "<|im_end|>\\")],
        2: [(None, "text"), ("assi\nstant", "b")],
        3: [("assistant", str(i)) for i in range(2000)],
    }
    rows = [(c, i, r, t, "extra") for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns string").repartition(5)
    out = {r["conv_id"]: r for r in chat.chat_digests(df).collect()}
    assert set(out) == set(convs)
    for c, turns in convs.items():
        assert (out[c]["n_turns"], out[c]["turns_sha256"], out[c]["loss_chars"], out[c]["loss_sha256"]) == want(turns)
    monkeypatch.setattr(chat, "PART", 500)
    parts = sorted((r["conv_id"], r["part"], r) for r in chat.format_chats(df).collect())
    for c, turns in convs.items():
        mine = [r for k, _, r in parts if k == c]
        text = "".join(r["text"] for r in mine)
        assert list(chat.parse(text)) == [(r or "", t or "") for r, t in turns]
        assert len(text) == out[c]["formatted_chars"]
        masked = "".join(chat.unescape(r["text"][a:b]) for r in mine for a, b in zip(r["loss_starts"], r["loss_ends"], strict=True))
        assert masked == "".join(t or "" for r, t in turns if r == "assistant")


def test_null_ids_ties_and_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame([(None, 0, "user", "a"), (None, 1, "assistant", "b"), (5, 1, "user", "z"), (5, 1, "assistant", "y"), (5, None, "system", "s")], schema)
    out = {r["conv_id"]: r for r in chat.chat_digests(df).collect()}
    assert out[None]["turns_sha256"] == sha("user\na\nassistant\nb\n")
    assert out[5]["turns_sha256"] == sha("system\ns\nassistant\ny\nuser\nz\n")
    assert chat.chat_digests(spark.createDataFrame([], schema)).count() == 0
