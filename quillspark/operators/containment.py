"""Which texts hold which of a set of phrases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of phrases that one pass over the texts looks for.
PASS_CHARS = 20_000_000


def _finder(sent):
    def run(batches):
        import ahocorasick
        import pyarrow as pa

        machine = ahocorasick.Automaton()
        for phrase, names in sent.value.items():
            machine.add_word(phrase, names)
        if sent.value:
            machine.make_automaton()
        for batch in batches:
            docs, items = [], []
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if text and sent.value:
                    for i in sorted({n for _, names in machine.iter(text) for n in names}):
                        docs.append(doc)
                        items.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(docs, batch.column("doc").type), pa.array(items, pa.string())], names=["doc", "item"])

    return run


def containing(docs: DataFrame, phrases: DataFrame, doc: str, item: str, text: str = "text") -> DataFrame:
    """(doc, item): each text with the ids (as text) of the phrases it holds verbatim; empty phrases are in none.

    Phrases are looked for all at once, in as many passes as their size asks for; a pass sends at most PASS_CHARS.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    grouped = phrases.filter(F.length(text) > 0).groupBy(F.col(text).alias("p")).agg(F.collect_set(F.col(item).cast("string")).alias("names"))
    kind = rows.schema["doc"].dataType.simpleString()
    found, part, size = None, {}, 0

    def passed(part):
        out = rows.mapInArrow(_finder(spark.sparkContext.broadcast(part)), f"doc {kind}, item string")
        return out if found is None else found.unionByName(out)

    for r in grouped.toLocalIterator():
        part[r["p"]] = list(r["names"])
        size += len(r["p"])
        if size >= PASS_CHARS:
            found, part, size = passed(part), {}, 0
    return passed(part) if part or found is None else found
