"""Structure-aware, lineage-carrying chunks of judgements and statutes.

A document gives several rows in one pass without a shuffle: its text is walked
through once, with headings, markers and sizes as the only state, on Arrow
batches. Chunks never overlap and never cross a section.

Fixed values: version names, the size of a chunk, separators and locator forms.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions import identity as ids
from quillspark.functions import text as tx
from quillspark.operators.batches import bounded

NORMALIZATION_VERSION = "norm-v1"
CHUNKING_VERSION = "chunk-v2"
TARGET = tx.TARGET_CHARS

_HEADING = re.compile("【([^】]*)】")
# List markers by level, ends of sentences, numbered items.
_MARKERS = (("digit", re.compile(r"(\d{1,2})\.(?!\d)(?!\s*\d{1,2}\.)")), ("hangul", re.compile(r"([가-힣])\.")), ("paren", re.compile(r"(\(\d+\))")))
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+")
_ITEM = re.compile(rf"(?:^|\n)([ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]+|\d{{1,3}}|[{tx.ITEM_LETTERS}])\.\s")
_BOXED = re.compile(f"[{tx.BOX_LINES}]")


def sections_of(text: str) -> list[tuple[str, str]]:
    """(heading without white space, what follows); text before the first heading has the heading ''."""
    parts = _HEADING.split(text)
    named = list(zip(["", *("".join(n.split()) for n in parts[1::2])], parts[0::2], strict=True))
    return named[1:] if len(named) > 1 and not parts[0] else named


def located(heading: str, body: str) -> Iterator[tuple[str, str, str]]:
    """(group, locator, paragraph): a marker is kept until one of its level or a higher level comes. Groups differ by heading and number."""
    open_at = {"digit": "", "hangul": "", "paren": ""}
    levels = list(open_at)
    for paragraph in filter(None, map(str.strip, body.split("<br/>"))):
        for level, pattern in _MARKERS:
            if m := pattern.match(paragraph):
                open_at[level] = m[1]
                for lower in levels[levels.index(level) + 1 :]:
                    open_at[lower] = ""
                break
        # Text under no heading is one group: its locators begin with the number.
        yield (open_at["digit"] if heading else ""), " > ".join(filter(None, [heading, *open_at.values()])), paragraph


def sentences_to(text: str, most: int) -> list[str]:
    """Sentences put together up to `most` characters; one that is longer is cut."""
    out: list[str] = []
    room = 0  # how much the last piece may still take, with its space
    for s in filter(None, _SENTENCE_END.split(text)):
        if len(s) > most:
            out += [s[i : i + most] for i in range(0, len(s), most)]
            room = 0
        elif room > len(s):
            out[-1] += f" {s}"
            room -= len(s) + 1
        else:
            out.append(s)
            room = most - len(s)
    return out


def packed(rows: list[tuple[str, str]], most: int = TARGET) -> Iterator[tuple[str, str]]:
    """(locator of the first, paragraphs joined by an empty line), up to `most` characters; longer paragraphs alone, by sentences."""
    held: list[str] = []
    where, size = "", 0
    for locator, p in rows:
        if held and (len(p) > most or size + 2 + len(p) > most):
            yield where, "\n\n".join(held)
            held = []
        if len(p) > most:
            yield from ((locator, s) for s in sentences_to(p, most))
        elif held:
            held.append(p)
            size += 2 + len(p)
        else:
            held, where, size = [p], locator, len(p)
    if held:
        yield where, "\n\n".join(held)


class Distinct(dict):
    """The n-th use of a locator in a document, from the second on, has ' (n)' after it."""

    def of(self, locator: str) -> str:
        n = self[locator] = self.get(locator, 0) + 1
        return locator if n == 1 else f"{locator} ({n})"


def judgement_pieces(text: str, most: int = TARGET) -> list[tuple[str, str]]:
    """(locator, text) of a judgement's body."""
    names, out = Distinct(), []
    for heading, body in sections_of(text):
        run: list[tuple[str, str]] = []
        at = None
        for group, locator, paragraph in [*located(heading, body), (None, "", "")]:
            if group != at and run:
                out += [(names.of(x), t) for x, t in packed(run, most)]
                run = []
            at = group
            run.append((locator, paragraph))
    return out


def table_runs(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, is table) of the runs of lines with and without box-drawing characters, line ends between them left out of tables."""
    runs, at = [], 0
    for line in text.split("\n"):
        boxed = bool(_BOXED.search(line))
        if runs and runs[-1][2] == boxed:
            runs[-1][1] = at + len(line)
        else:
            runs.append([at, at + len(line), boxed])
        at += len(line) + 1
    # What stands between two tables' ends and starts belongs to the text there.
    out = []
    for i, (a, b, boxed) in enumerate(runs):
        out.append((a, b, True) if boxed else (a - (i > 0), b + (i + 1 < len(runs)), False))
    return out


def statute_sections(text: str) -> list[tuple[str, str | None, bool]]:
    """(text, marker path or None, is table), cut at item markers outside tables; the path goes on after a table."""
    out, path = [], ["", "", ""]
    for start, end, boxed in table_runs(text):
        gap = text[start:end]
        if boxed:
            out.append((gap, None, True))
            continue
        found = list(_ITEM.finditer(gap))
        cuts = [m.start(1) for m in found] + [len(gap)]
        if (head := gap[: cuts[0]].strip("\n")).strip():
            out.append((head, None, False))
        for m, stop in zip(found, cuts[1:], strict=True):
            level = 1 if m[1].isdecimal() else 2 if m[1] in tx.ITEM_LETTERS else 0
            path[level:] = [m[1], *[""] * (2 - level)]
            if (piece := gap[m.start(1) : stop].rstrip("\n")).strip():
                out.append((piece, " > ".join(filter(None, path)), False))
    return out


def lines_to(text: str, most: int = TARGET) -> list[str]:
    """Whole lines put together up to `most` characters; a longer line is a piece of its own."""
    out: list[str] = []
    for i, line in enumerate(text.split("\n")):
        if i and len(out[-1]) + 1 + len(line) <= most:
            out[-1] += f"\n{line}"
        else:
            out.append(line)
    return out


def statute_pieces(title: str, text: str, most: int = TARGET) -> list[tuple[str, str, str]]:
    """(locator, text, layout) of a statute unit."""
    parts: list[tuple[str, str | None, bool]] = []
    for body, path, boxed in [(text, None, False)] if len(text) < most else statute_sections(text):
        pieces = [body] if len(body) < most else lines_to(body, most)
        n = len(pieces)
        parts += [(p, f"{path} (조각 {i}/{n})" if path is not None and n > 1 else path, boxed) for i, p in enumerate(pieces, 1)]
    names, n = Distinct(), len(parts)
    return [
        (names.of(title if n == 1 else f"{title} > {path}" if path is not None else f"{title} (조각 {i}/{n})"), p, "table" if boxed else "text") for i, (p, path, boxed) in enumerate(parts, 1)
    ]


def _rows(cut, kinds: str):
    def run(batches):
        import pyarrow as pa

        for batch in bounded(batches, "text"):
            keys, out = [], []
            for i, row in enumerate(batch.select(["title", "text"]).to_pylist()):
                for n, piece in enumerate(cut(row)):
                    keys.append(i)
                    out.append((n, *piece))
            # A piece doesn't carry the whole text it is of.
            carried = batch.select([c for c in batch.schema.names if c != "text"]).take(pa.array(keys, pa.int32()))
            columns = [pa.array([r[k] for r in out], pa.int32() if k == 0 else pa.string()) for k in range(len(kinds.split(",")))]
            yield pa.RecordBatch.from_arrays([*carried.columns, *columns], names=[*carried.schema.names, *(c.split()[0] for c in kinds.split(", "))])

    return run


def _pieces(records: DataFrame, cut, kinds: str) -> DataFrame:
    schema = T.StructType([*(f for f in records.schema.fields if f.name != "text"), *T.StructType.fromDDL(kinds).fields])
    return records.mapInArrow(_rows(cut, kinds), schema)


def _chunks(pieces: DataFrame, chunk_type: str, dataset_version: str) -> DataFrame:
    return pieces.select(
        ids.chunk_id("document_id", F.lit(chunk_type), "ordinal").alias("chunk_id"),
        "document_id",
        F.lit(chunk_type).alias("chunk_type"),
        "ordinal",
        F.col("piece").alias("text"),
        ids.content_hash("piece").alias("content_hash"),
        "document_kind",
        F.lit(dataset_version).alias("dataset_version"),
        F.lit(NORMALIZATION_VERSION).alias("normalization_version"),
        F.lit(CHUNKING_VERSION).alias("chunking_version"),
        "title",
        "source_uri",
        "official_number",
        "locator",
        "linked_laws",
        "fields",
        "record_limitations",
    )


JUDGEMENT_FIELDS = "case_name string, court string, decided_on string, case_number string, referenced_provisions string, referenced_precedents string, issue_ordinal int"


def _judgement_fields(provisions, precedents, issue):
    i = F.col("identity.judgement")
    return F.struct(
        i["caseName"].alias("case_name"), i["court"].alias("court"), F.when(i["decidedOn"] != ids.SENTINEL_DATE, i["decidedOn"]).alias("decided_on"), i["caseNumber"].alias("case_number"),
        provisions.alias("referenced_provisions"), precedents.alias("referenced_precedents"), issue.cast("int").alias("issue_ordinal"),
    )


def _base(records: DataFrame, kind: str, number: str) -> DataFrame:
    return records.filter(F.col("documentKind") == kind).select(
        F.col("documentId").alias("document_id"), F.col("documentKind").alias("document_kind"), "title", "text", F.col("provenance.sourceUrl").alias("source_uri"),
        F.col(f"identity.{kind}.{number}").alias("official_number"), F.col("linkedLaws").alias("linked_laws"), F.col("limitations").alias("record_limitations"), "identity",
    )


def chunk_bodies(records: DataFrame, dataset_version: str) -> DataFrame:
    """Chunks of the bodies of judgement records."""
    none = F.lit("")
    rows = _base(records, "judgement", "caseNumber").withColumn("fields", _judgement_fields(none, none, F.lit(None))).drop("identity")
    return _chunks(_pieces(rows, lambda r: judgement_pieces(r["text"] or ""), "ordinal int, locator string, piece string"), "body", dataset_version)


def chunk_summaries(records: DataFrame, dataset_version: str) -> DataFrame:
    """A chunk for each numbered issue of headnote and holding, with what the same number cites."""
    rows = _base(records, "judgement", "caseNumber")
    i = F.col("identity.judgement")
    rows = rows.withColumn("~laws", tx.issues(i["referencedProvisions"])).withColumn("~cases", tx.issues(i["referencedPrecedents"]))
    found = None
    for field, chunk_type, label in (("headnote", "summary-headnote", "판시사항"), ("holding", "summary-holding", "판결요지")):
        entries = F.sort_array(F.transform(F.map_entries(tx.issues(i[field])), lambda e: F.struct(e["key"].alias("n"), e["value"].alias("piece"))))
        part = rows.select("*", F.posexplode(entries).alias("ordinal", "~issue")).filter(F.col("~issue.piece") != "").withColumn("piece", F.col("~issue.piece"))
        n = F.col("~issue.n")
        cites = lambda m: F.coalesce(F.try_element_at(F.col(m), n), F.lit(""))  # noqa: E731, B023
        part = part.withColumn("fields", _judgement_fields(cites("~laws"), cites("~cases"), n)).withColumn("locator", F.concat(F.lit(f"{label} ["), n.cast("string"), F.lit("]")))
        part = _chunks(part, chunk_type, dataset_version)
        found = part if found is None else found.unionByName(part)
    return found


def chunk_judgements(records: DataFrame, dataset_version: str) -> DataFrame:
    return chunk_bodies(records, dataset_version).unionByName(chunk_summaries(records, dataset_version))


def chunk_statutes(records: DataFrame, dataset_version: str) -> DataFrame:
    i = F.col("identity.statute")
    rows = _base(records, "statute", "mst").withColumn(
        "fields",
        F.struct(
            i["lawName"].alias("law_name"), i["unitKind"].alias("unit_kind"), i["articleNumber"].alias("article_number"), i["appendixNumber"].alias("appendix_number"),
            F.when(tx.repealed("text"), "repealed").otherwise("current").alias("status"),
        ),
    ).drop("identity").withColumn("record_limitations", F.array().cast("array<string>"))
    pieces = _pieces(rows, lambda r: statute_pieces(r["title"] or "", r["text"] or ""), "ordinal int, locator string, piece string, layout string")
    return _chunks(pieces.withColumn("fields", F.col("fields").withField("layout", F.col("layout"))), "body", dataset_version)


def index_documents(chunks: DataFrame) -> DataFrame:
    """Chunks as flat documents of an index: the variant's fields as columns, laws by strength in three arrays."""
    strength = lambda s: F.transform(F.filter("linked_laws", lambda x: x["strength"] == s), lambda x: x["lawName"])
    kept = [c for c in chunks.columns if c not in ("linked_laws", "fields", "chunk_type", "ordinal")]
    own = [f.name for f in chunks.schema["fields"].dataType.fields]
    shown = {
        "decided_on": lambda: ids.decided_date("fields.decided_on"),
        "referenced_provisions": lambda: F.when(F.col("fields.referenced_provisions") != "", tx.citation_list("fields.referenced_provisions")),
        "referenced_precedents": lambda: F.when(F.col("fields.referenced_precedents") != "", tx.citation_list("fields.referenced_precedents")),
    }
    return chunks.select(
        *kept, "chunk_type", "ordinal", *(strength(s).alias(f"linked_law_names_{s}") for s in ("core", "candidate", "unlinked")),
        *((shown[f]() if f in shown else F.nullif(F.col(f"fields.{f}"), F.lit("")) if f not in ("issue_ordinal",) else F.col(f"fields.{f}")).alias(f) for f in own),
    )
