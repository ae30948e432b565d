"""Fill-in-middle: texts cut at two units and put together for infilling.

A text of n units is cut after the smaller and after the larger of two hashed
numbers from 0 to n: prefix, middle, suffix. It is written

    psm   <P>prefix<S>suffix<M>middle
    spm   <S>suffix<P>prefix<M>middle
    plain the text itself: empty texts, those that hold a sentinel, and a hashed share

Units are matched left to right over code points: `char`, each code point;
`word`, each run of ASCII white space and each run of anything else; `line`, up
to and with each line feed.

One scan. A single Aho-Corasick automaton knows the sentinels and the ASCII
characters at which the class of units changes (white space for words, the line
feed for lines, none for code points). What it meets are the events of a text.
Between two events nothing changes, so the units of a gap are arithmetic: its
length for code points, one for words and lines. The events, with the units
before each, are all that the cuts need: the k-th unit ends in the segment that
a binary search finds. No list of units is made.

Reading back scans the output with the same automaton: its only sentinels are
the three that were written, in the order of the form, because no sentinel ends
as another begins (checked when the operator is made) and the texts hold none.
A text that would not be read back raises an error.

Null texts count as empty and are plain. A null id is hashed as the empty text.
Each row is on its own: repeated rows give repeated results, ties don't matter,
an empty table gives none, other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The ASCII characters at which units change, for each kind of units.
CHANGES = {"char": "", "word": "\t\n\x0b\x0c\r ", "line": "\n"}
SENTINELS = ("<P>", "<S>", "<M>")
#: Characters of output that one Arrow batch holds, or one text.
BATCH = 1 << 23


def automaton(unit: str, sentinels: tuple[str, str, str]):
    """Finds the ends of sentinels (value: their number) and of changing characters (value: -1)."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for c in CHANGES[unit]:
        found.add_word(c, -1)
    for i, s in enumerate(sentinels):
        found.add_word(s, i)
    found.make_automaton()
    return found


def checked(unit: str, sentinels: tuple[str, str, str]) -> tuple[str, str, str]:
    if unit not in CHANGES:
        raise ValueError(f"units are {', '.join(CHANGES)}, not {unit}")
    if len(set(sentinels)) != 3 or not all(sentinels):
        raise ValueError("three different sentinels are needed")
    for a in sentinels:
        for b in sentinels:
            if any(a.endswith(b[:k]) for k in range(1, len(b))) or a != b and (a in b or b in a):
                raise ValueError(f"{a} and {b} overlap, so that outputs couldn't be read back")
            if any(c in a for c in CHANGES["word"]):
                raise ValueError(f"{a} holds white space")
    return tuple(sentinels)


class Events:
    """The events of a text: segments by their start, with the units before each."""

    def __init__(self, text: str, unit: str, scan):
        self.sentinels: list[tuple[int, int]] = []
        starts, before, n, at = [], [], 0, 0  # at: the end of the last segment

        def segment(end: int, units: int):
            nonlocal n, at
            if end > at:
                starts.append(at)
                before.append(n)
                n, at = n + units, end

        run = False  # whether the last segment is white space between words
        for end, what in scan.iter(text):
            if what >= 0:
                self.sentinels.append((what, end + 1))
            elif unit == "line":
                segment(end + 1, 1)
            else:
                if end > at:
                    segment(end, 1)
                    run = False
                if run:
                    at = end + 1
                else:
                    segment(end + 1, 1)
                    run = True
        segment(len(text), len(text) - at if unit == "char" else 1)
        self.starts, self.before, self.n, self.length, self.unit = starts, before, n, len(text), unit

    def end_of(self, k: int) -> int:
        """The offset after the first k units."""
        if k == self.n:
            return self.length
        i = bisect_left(self.before, k + 1) - 1  # the segment that holds unit k, counted from 0
        return self.starts[i] + (k - self.before[i] if self.unit == "char" else 0)


class FillInMiddle:
    def __init__(self, unit: str, sentinels: tuple[str, str, str], plain: int, spm: int, seed: str):
        self.unit, self.sentinels, self.plain, self.spm, self.seed = unit, sentinels, plain, spm, seed
        self.scan = automaton(unit, sentinels)

    def write(self, doc_id, text: str) -> tuple[int, str, int | None, int | None, str]:
        """(n, form, prefix_chars, middle_chars, output)"""
        events = Events(text, self.unit, self.scan)
        n = events.n
        digest = hashlib.sha256(f"{self.seed}{'' if doc_id is None else doc_id}".encode()).digest()
        h1, h2, h3, h4 = (int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))
        if not text or events.sentinels or h3 % 100 >= 100 - self.plain:
            return n, "plain", None, None, text
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = events.end_of(a), events.end_of(b)
        p, s, m = self.sentinels
        if h4 % 100 < self.spm:
            return n, "spm", a, b - a, f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}"
        return n, "psm", a, b - a, f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}"

    def read(self, form: str, output: str) -> str:
        """The text that an output of this form was made of."""
        if form == "plain":
            return output
        order = {"psm": (0, 1, 2), "spm": (1, 0, 2)}[form]
        met = [(what, end) for end, what in self.scan.iter(output) if what >= 0]
        if tuple(what for what, _ in met) != order or met[0][1] + 1 != len(self.sentinels[order[0]]):
            raise ValueError(f"this is no output of the form {form}")
        ends = [end + 1 for _, end in met]
        first = output[ends[0] : ends[1] - len(self.sentinels[order[1]])]
        second = output[ends[1] : ends[2] - len(self.sentinels[2])]
        prefix, suffix = (first, second) if form == "psm" else (second, first)
        return prefix + output[ends[2] :] + suffix


def _mapped(options: tuple, digests: bool):
    def run(batches):
        import pyarrow as pa

        fim = FillInMiddle(*options)
        columns = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
        columns += [("output_sha256", pa.string()), ("restored_sha256", pa.string())] if digests else [("output", pa.string())]

        def batch_of(ids, rows):
            return pa.RecordBatch.from_arrays([ids, *(pa.array(c, kind) for c, (_, kind) in zip(zip(*rows, strict=True), columns, strict=True))], names=["id", *(name for name, _ in columns)])

        for batch in batches:
            ids, texts = batch.column("id"), batch.column("text")
            rows, first, held = [], 0, 0
            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                *row, output = fim.write(ids[i].as_py(), text)
                restored = fim.read(row[1], output)
                if restored != text:
                    raise ValueError("an output doesn't give its text back")
                if digests:
                    rows.append((*row, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256(restored.encode()).hexdigest()))
                else:
                    rows.append((*row, output))
                    held += len(output)
                    if held >= BATCH:
                        yield batch_of(ids.slice(first, i + 1 - first), rows)
                        rows, first, held = [], i + 1, 0
            if rows:
                yield batch_of(ids.slice(first), rows)

    return run


def _applied(docs: DataFrame, columns: str, digests: bool, id_col: str, text_col: str, unit: str, sentinels: tuple[str, str, str], plain: int, spm: int, seed: str) -> DataFrame:
    if not (0 <= plain <= 100 and 0 <= spm <= 100):
        raise ValueError("shares are percentages")
    options = (unit, checked(unit, sentinels), plain, spm, seed)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_mapped(options, digests), f"id {kind}, n long, form string, prefix_chars long, middle_chars long, {columns}")
    return rows.withColumnRenamed("id", id_col)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "char", sentinels: tuple[str, str, str] = SENTINELS, plain: int = 10, spm: int = 20, seed: str = "1:") -> DataFrame:
    """id, n, form, prefix_chars, middle_chars, output of each row; plain percent stay as they are, spm percent of the others have the suffix first."""
    return _applied(docs, "output string", False, id_col, text_col, unit, sentinels, plain, spm, seed)


def fim_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "char", sentinels: tuple[str, str, str] = SENTINELS, plain: int = 10, spm: int = 20, seed: str = "1:") -> DataFrame:
    """As fill_in_middle, with the SHA-256 of the output and of what is read back from it in place of the output."""
    return _applied(docs, "output_sha256 string, restored_sha256 string", True, id_col, text_col, unit, sentinels, plain, spm, seed)
