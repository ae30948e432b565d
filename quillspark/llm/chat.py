"""Chat formatting whose output is proved by parsing it.

A turn is written as

    <|im_start|>role\\ntext<|im_end|>\\n

The parser is deterministic: it looks for the next start mark, the first line
end, the next end mark. After each turn is written it is parsed again, and if
the role or the text that comes back differs, the text, then the role, then both
are escaped until they are the same: `<`, backslashes, `|` gets one backslash
more, which the parser takes away. Line ends in roles are escaped as \\n.

The loss mask covers the text of assistant turns, once each.

Conversations are sorted by turn (then role and text, for turns that tie; null
turns first) within a partition and written as a stream: a conversation of any
length needs the memory of one turn, and its text may leave in several parts.
Digests are of a whole conversation in order, so one task sees each conversation.
Null roles and texts count as empty, and rows without conv_id are one conversation.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
_MARK = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_ROLE = re.compile(r"[\\\n]")
_ROLE_BACK = re.compile(r"\\([\\n])")


def escape(text: str) -> str:
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return _ROLE.sub(lambda m: "\\n" if m[0] == "\n" else "\\\\", escape(role))


def unescape_role(role: str) -> str:
    return unescape(_ROLE_BACK.sub(lambda m: "\n" if m[1] == "n" else "\\", role))


def parse(text: str):
    """(role, text) of each turn of a formatted text; ValueError if it is none."""
    at = 0
    while at < len(text):
        if not text.startswith(START, at):
            raise ValueError(f"no turn starts at {at}")
        line = text.find("\n", at)
        end = text.find(END, at)
        if line < 0 or end < 0 or line > end or not text.startswith("\n", end + len(END)):
            raise ValueError(f"a turn that starts at {at} doesn't end")
        role = text[at + len(START) : line]
        if START in role or START in text[line:end]:
            raise ValueError(f"a turn starts inside the one at {at}")
        yield unescape_role(role), unescape(text[line + 1 : end])
        at = end + len(END) + 1


def render(role: str, text: str) -> tuple[str, str, str]:
    """A turn as it is written and the role and text that parsing it gives back, which equal the arguments."""
    for shown_role, shown_text in ((role, text), (role, escape(text)), (escape_role(role), text), (escape_role(role), escape(text))):
        out = f"{START}{shown_role}\n{shown_text}{END}\n"
        try:
            turns = list(parse(out))
        except ValueError:
            continue
        if turns == [(role, text)]:
            return out, *turns[0]
    raise ValueError("a turn can't be written so that it is read back")


class _Conversation:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss, self.chars = conv_id, 0, 0, 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, role: str, text: str) -> str:
        out, role, text = render(role, text)
        self.turns += 1
        self.chars += len(out)
        self.turn_hash.update(f"{role}\n{text}\n".encode())
        if role == "assistant":
            self.loss += len(text)
            self.loss_hash.update(text.encode())
        return out


def _rows(batches):
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in ("conv", "role", "text")), strict=True)


def _digests(batches):
    import pyarrow as pa

    def out(c):
        return pa.RecordBatch.from_pylist(
            [{"conv": x.conv_id, "n_turns": x.turns, "turns_sha256": x.turn_hash.hexdigest(), "loss_chars": x.loss, "loss_sha256": x.loss_hash.hexdigest(), "formatted_chars": x.chars} for x in c],
            schema=pa.schema([("conv", kind), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]),
        )

    at, done, kind = None, [], None
    for batch in batches:
        kind = batch.schema.field("conv").type
        for conv, role, text in _rows([batch]):
            if at is None or at.conv_id != conv:
                done += [at] if at else []
                at = _Conversation(conv)
            at.add(role or "", text or "")
        if done:
            yield out(done)
            done = []
    if at:
        yield out([at])


def _texts(batches):
    """(conv, part, text, loss_starts, loss_ends): parts of at most about PART characters, or one turn, with the mask as ranges of code points in the part."""
    import pyarrow as pa

    at, part, text, n, starts, ends = None, 0, [], 0, [], []
    for batch in batches:
        kind = batch.schema.field("conv").type
        out = []
        for conv, role, said in _rows([batch]):
            if at is None or at.conv_id != conv or n > PART:
                if at:
                    out.append((at.conv_id, part, "".join(text), starts, ends))
                part = part + 1 if at and at.conv_id == conv else 0
                at = at if part else _Conversation(conv)
                text, n, starts, ends = [], 0, [], []
            turn = at.add(role or "", said or "")
            if role == "assistant":
                starts.append(n + turn.index("\n") + 1)
                ends.append(n + len(turn) - len(END) - 1)
            text.append(turn)
            n += len(turn)
        yield _parts(out, kind)
    if at:
        yield _parts([(at.conv_id, part, "".join(text), starts, ends)], kind)


PART = 1 << 20


def _parts(rows, kind):
    import pyarrow as pa

    kinds = [kind, pa.int32(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["conv", "part", "text", "loss_starts", "loss_ends"])


def _sorted(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(F.col("conv_id").alias("conv"), "turn", "role", "text")
    return rows.repartition(F.col("conv")).sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text").select("conv", "role", "text")


def chat_digests(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of each conversation, as read back from its formatted text."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    return (
        _sorted(conversations)
        .mapInArrow(_digests, f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
        .withColumnRenamed("conv", "conv_id")
    )


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, part, text, loss_starts, loss_ends: the formatted conversations."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    return (
        _sorted(conversations)
        .mapInArrow(_texts, f"conv {kind}, part int, text string, loss_starts array<long>, loss_ends array<long>")
        .withColumnRenamed("conv", "conv_id")
    )
