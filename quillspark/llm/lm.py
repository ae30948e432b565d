"""Language-model scores: the probability of a text over all its segmentations.

Words are lower-cased A-Z and cut at ASCII white space; an end follows the last.
The model is a unigram model over an existing vocabulary of subword pieces: a
text is a sequence of pieces, and its probability is the sum over every
sequence that spells it, by a forward recursion over bytes in log space. As no
piece spans a word start, that sum is the product over words, and a word is
worked on once however often it occurs. The pieces' probabilities come from the
training documents, whose words the vocabulary's own tokenizer segments, with
add-one smoothing over the vocabulary; the vocabulary itself is not trained.

Documents are cut into blocks of bounded size, each with the distinct words in
it and its documents as numbers of them. Word counts are summed over blocks, and
each word is scored once. The `frequent` words of most occurrences, a bounded
table, are then sent to all tasks, which sum them up for the documents of a
block without a shuffle. Only the rest, words and their places in a block, go
by join, so neither texts nor frequent words are shuffled, no join has a hot
key, and no task holds more than a block. Null texts are empty: an end alone.
Ids are of any type, repeated rows are counted and scored like others, and a
text of any length is in one block.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import crc32_of, written

#: The vocabulary's file, for a sentencepiece processor; a parameter of lm_scores, read on the driver.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: Words whose scores are sent to all tasks, about 20 MB in a worker.
FREQUENT = 200_000
SPACE = "▁".encode()
#: Bytes of text in a block, but for a longer single text; and distinct words in it, above which it is closed.
BLOCK_BYTES, BLOCK_WORDS = 24 << 20, 400_000
_BLOCK = "block string, words array<binary>, counts array<long>, doc array<{id}>, held array<boolean>, sizes array<int>, at binary, times binary, tokens long, ends long"
_REST = "block string, doc array<{id}>, held array<boolean>, tokens binary, known binary, base binary, logp binary, sizes array<int>, at binary, times binary, words array<binary>"


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8").lower().split() if text else []


def _blocks(folds: int, fold: int):
    def run(batches):
        from collections import Counter

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        schema = None

        def fresh():
            return {}, [], [], [], [], [], 0

        words, docs, held, sizes, at, times, size = fresh()

        def closed():
            position = np.concatenate(at) if at else np.zeros(0, dtype=np.uint32)
            n = np.concatenate(times) if times else np.zeros(0, dtype=np.uint32)
            learned = np.repeat(~np.array(held, dtype=bool), sizes)
            counts = np.bincount(position[learned], n[learned], len(words)).astype(np.int64)
            ends = held.count(False)
            row = [[f"{task}-{number}"], [list(words)], [counts.tolist()], [docs], [held], [sizes], [position.tobytes()], [n.tobytes()], [int(counts.sum())], [ends]]
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            schema = schema or pa.schema(
                [("block", pa.string()), ("words", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64())), ("doc", pa.list_(batch.schema.field("id").type)), ("held", pa.list_(pa.bool_())),
                 ("sizes", pa.list_(pa.int32())), ("at", pa.binary()), ("times", pa.binary()), ("tokens", pa.int64()), ("ends", pa.int64())]
            )
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                seen = Counter(words_of(text))
                at.append(np.array([words.setdefault(w, len(words)) for w in seen], dtype=np.uint32))
                times.append(np.fromiter(seen.values(), dtype=np.uint32, count=len(seen)))
                docs.append(doc)
                held.append(crc32_of(doc, folds) == fold)
                sizes.append(len(seen))
                size += len(text or "")
                if size >= BLOCK_BYTES or len(words) >= BLOCK_WORDS:
                    yield closed()
                    number += 1
                    words, docs, held, sizes, at, times, size = fresh()
        if docs:
            yield closed()

    return run


def vocabulary(path: str) -> list[bytes]:
    """The pieces as bytes, a word start as SPACE; single bytes stand for byte pieces. Pieces that a word can't hold are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = []
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            found.append(bytes([int(model.id_to_piece(i)[3:-1], 16)]))
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            p = model.id_to_piece(i)
            if "▁" not in p[1:] and p != "▁▁":
                found.append(p.encode())
    return list(dict.fromkeys(found))


def _piece_counts(model_bytes):
    def run(batches):
        import pyarrow as pa
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes.value)
        as_bytes = [bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).encode() for i in range(model.get_piece_size())]
        total: dict[int, int] = {}
        for batch in batches:
            words = [w.decode("utf-8", "replace") for w in batch.column("word").to_pylist()]
            for ids, n in zip(model.encode(words, num_threads=1), batch.column("c").to_pylist(), strict=True):
                for i in ids:
                    total[i] = total.get(i, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array([as_bytes[i] for i in total], pa.binary()), pa.array(list(total.values()), pa.int64())], names=["piece", "n"])

    return run


def word_logp(word: bytes, pieces: dict[bytes, float], longest: int) -> float:
    """Natural log of the sum over all segmentations of SPACE + word of the product of their pieces' probabilities."""
    text = SPACE + word
    n = len(text)
    ahead = [-math.inf] * (n + 1)
    ahead[0] = 0.0
    get, log1p, exp = pieces.get, math.log1p, math.exp
    for a in range(n):
        base = ahead[a]
        for b in range(a + 1, min(n, a + longest) + 1):
            p = get(text[a:b])
            if p is not None:
                x, y = base + p, ahead[b]
                if y == -math.inf:
                    ahead[b] = x
                elif x > y:
                    ahead[b] = x + log1p(exp(y - x))
                else:
                    ahead[b] = y + log1p(exp(x - y))
    return ahead[n]


def _word_scores(sent):
    def run(batches):
        import pyarrow as pa

        pieces = sent.value
        longest = max(map(len, pieces))
        starts = {p[:k] for p in pieces for k in (1, 2, 3, 4)}
        for batch in batches:
            words = batch.column("word").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array([_fast_logp(w, pieces, longest, starts) for w in words], pa.float64())], names=["word", "c", "logp"])

    return run


def _fast_logp(word: bytes, pieces: dict[bytes, float], longest: int, starts: set[bytes]) -> float:
    """word_logp with probabilities scaled to stay in range, and long pieces looked up only where one can start."""
    text = SPACE + word
    n = len(text)
    if n > 64:
        return word_logp(word, pieces, longest)
    ahead = [0.0] * (n + 1)
    ahead[0] = 1.0
    get, exp = pieces.get, math.exp
    for a in range(n):
        base = ahead[a]
        if base == 0.0:
            continue
        most = min(n, a + longest)
        near = min(most, a + 4)
        for b in range(a + 1, near + 1):
            p = get(text[a:b])
            if p is not None:
                ahead[b] += base * exp(p)
        if most > near and text[a:near] in starts:
            for b in range(near + 1, most + 1):
                p = get(text[a:b])
                if p is not None:
                    ahead[b] += base * exp(p)
    return math.log(ahead[n]) if ahead[n] > 1e-280 else word_logp(word, pieces, longest)


def _partly(sent, n: int, v: int, ends: int, end_logp: float):
    """Blocks with what their documents have of frequent words summed up, and their other words."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        words, c, logp = sent.value
        number = {w: i for i, w in enumerate(words)}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in ("words", "sizes", "at", "times")}
                own = row["words"].as_py()
                place = np.fromiter((number.get(w, -1) for w in own), dtype=np.int64, count=len(own))
                at, times = np.frombuffer(row["at"].as_py(), dtype=np.uint32), np.frombuffer(row["times"].as_py(), dtype=np.uint32)
                sizes = np.array(row["sizes"].as_py(), dtype=np.int64)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                tokens = np.bincount(owner, times, len(sizes)) + 1
                rare = place[at] < 0
                of, met, k = owner[~rare], times[~rare].astype(np.float64), place[at[~rare]]
                known = np.bincount(of, met * (c[k] > 0), len(sizes)) + (ends > 0)
                base = np.bincount(of, met * np.log10((c[k] + 1) / (n + 1 * (v + 1))), len(sizes)) + math.log10((ends + 1) / (n + 1 * (v + 1)))
                log = np.bincount(of, met * logp[k], len(sizes)) + end_logp
                left = np.flatnonzero(place < 0)
                new = np.cumsum(place < 0) - 1
                columns = [
                    batch.column("block").slice(i, 1), batch.column("doc").slice(i, 1), batch.column("held").slice(i, 1),
                    *(pa.array([x.astype(np.float64).tobytes()]) for x in (tokens, known, base, log)),
                    pa.array([np.bincount(owner[rare], minlength=len(sizes)).tolist()], pa.list_(pa.int32())),
                    pa.array([new[at[rare]].astype(np.uint32).tobytes()]), pa.array([times[rare].tobytes()]), pa.array([[own[j] for j in left.tolist()]], pa.list_(pa.binary())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "doc", "held", "tokens", "known", "base", "logp", "sizes", "at", "times", "words"])

    return run


def _score(n: int, v: int):
    """Adds to the documents of one block what its other words give."""

    def run(block, answers):
        import numpy as np
        import pyarrow as pa

        parts = []
        places, c, logp = (answers.column(x).to_numpy() for x in ("place", "c", "logp"))
        for i in range(block.num_rows):
            row = {name: block.column(name)[i].as_py() for name in ("tokens", "known", "base", "logp", "sizes", "at", "times", "width")}
            tokens, known, base, log = (np.frombuffer(row[x], dtype=np.float64) for x in ("tokens", "known", "base", "logp"))
            count, score = np.zeros(row["width"]), np.zeros(row["width"])
            count[places], score[places] = c, logp
            at, times = np.frombuffer(row["at"], dtype=np.uint32), np.frombuffer(row["times"], dtype=np.uint32).astype(np.float64)
            m = len(tokens)
            owner = np.repeat(np.arange(m), row["sizes"])
            known = known + np.bincount(owner, times * (count[at] > 0), m)
            base = base + np.bincount(owner, times * np.log10((count[at] + 1) / (n + 1 * (v + 1))), m)
            log = log + np.bincount(owner, times * score[at], m)
            docs, held = (block.column(x).combine_chunks().slice(i, 1).flatten() for x in ("doc", "held"))
            whole = lambda x: pa.array(x.astype(np.int64))
            parts.append(
                pa.Table.from_arrays([docs, held, whole(tokens), whole(known), pa.array(base), pa.array(log / math.log(10)), pa.array(np.full(m, n, dtype=np.int64))], names=["id", "held_out", "n_tokens", "n_known", "base_score", "score", "train_tokens"])
            )
        return pa.concat_tables(parts)

    return run


def lm_scores(
    docs: DataFrame, folds: int = 7, fold: int = 2, model_path: str = PIECES, piece_logp: dict[bytes, float] | None = None, end_logp: float = math.log(0.05), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of docs; rows of the fold are held out of counts and model.

    With piece_logp, the natural logarithms of the pieces of a unigram vocabulary (SPACE being a word's start), these are
    the model, with end_logp for an end; every byte should be a piece. Else the pieces of model_path are counted.
    """
    sc = docs.sparkSession.sparkContext
    kind = docs.schema[id_col].dataType.simpleString()
    blocks = written(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_blocks(folds, fold), _BLOCK.format(id=kind)), "lm-blocks")
    counts = blocks.select(F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("n")))).groupBy("word").agg(F.sum("n").alias("c"))
    counts = written(counts, "lm-counts")
    sums = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("ends"), F.lit(0)).alias("ends")).first()
    n, ends = sums["tokens"] + sums["ends"], sums["ends"]
    v = counts.filter("c > 0").count() + (ends > 0)

    if piece_logp is None:
        try:
            with open(model_path, "rb") as f:
                model = sc.broadcast(f.read())  # a vocabulary file, of fixed size
        except OSError as e:
            raise ValueError(f"the vocabulary {model_path} can't be read on the driver; give its place as model_path, or scores as piece_logp") from e
        rows = counts.filter("c > 0").mapInArrow(_piece_counts(model), "piece binary, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        seen = {bytes(r["piece"]): r["n"] for r in rows}  # at most one for each piece of the vocabulary
        pieces = vocabulary(model_path)
        total = sum(seen.get(p, 0) for p in pieces) + ends + len(pieces) + 1
        piece_logp = {p: math.log((seen.get(p, 0) + 1) / total) for p in pieces}
        end_logp = math.log((ends + 1) / total)

    scored = written(counts.mapInArrow(_word_scores(sc.broadcast(piece_logp)), "word binary, c long, logp double"), "lm-scores")
    top = scored.orderBy(F.desc("c"), "word").limit(FREQUENT).toArrow()
    frequent = sc.broadcast((top["word"].to_pylist(), top["c"].to_numpy(), top["logp"].to_numpy()))
    rest = written(blocks.select("block", "words", "doc", "held", "sizes", "at", "times").mapInArrow(_partly(frequent, n, v, ends, end_logp), _REST.format(id=kind)), "lm-rest")
    answers = rest.select("block", F.posexplode("words").alias("place", "word")).join(scored, "word").select(F.col("block").alias("of"), "place", "c", "logp")
    found = (
        rest.withColumn("width", F.size("words"))
        .drop("words")
        .groupBy("block")
        .cogroup(answers.groupBy("of"))
        .applyInArrow(_score(n, v), f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, train_tokens long")
    )
    return found.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
