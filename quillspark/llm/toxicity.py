"""Toxicity scores from a subsequence string-kernel SVM with Nyström landmarks.

Texts are read as sentences: they end at line ends and after a word that ends
in `.`, `!` or `?`; a sentence of more than WORDS words is read as all its runs
of WORDS words. Letters are folded to a to z (accents and look-alike digits
too); marks between letters and blanks between single letters are dropped, so
i.d.i.o.t and i d i o t read as idiot.

The kernel of two sentences is an inner product of subsequence counts, scaled
by the roots of their lengths. Counted are subsequences of three characters,
word ends being one, at most SPAN characters apart, each with DECAY to the
power of the characters it skips; and words and ordered pairs of words at most
REACH apart, likewise. So an insult with letters put in stays near the plain
one, and two plain words in one order can be told from the other order.

Training takes a bounded sample of labelled rows, of whole texts (`most_toxic`,
`most_clean`). A toxic document vouches for one of its sentences only, a clean
one for all. The machine is fitted on sentences of all documents, then anew on
each toxic document's most toxic sentence against the most toxic ones of clean
documents, round by round (MI-SVM). These are found by scoring the whole sample
on the executors, so no sentence or word of it is left out. The first round has
to begin somewhere: with up to `first` sentences of each document, chosen by hash,
`first_in_all` of toxic and of clean ones. Documents are scored by a machine
that was fitted without their part of the sample (FOLDS), here and for the curve.
Losses are squared hinges that give up what lies far on the other side, as some
labels are wrong. Landmarks are `landmarks` of the sentences, half of them
toxic; the Nyström map turns sentences into vectors by their kernel with these.
As the kernel is an inner product, the machine's sum over landmarks is one
table over subsequences, and scoring costs the same for any number of landmarks.

A text scores as its most toxic sentence, mapped to (0, 1) by a logistic curve
fitted on the sample. Null texts, empty ones and those without letters score as
LOWEST. Texts of over PART characters are read in parts that overlap, so that a
text of any length needs bounded memory; all its parts count. Without labels of
both kinds every text gets the score 0. Labels with null ids or values are left
out; of repeated labels the highest counts, of repeated ids one text is learned
from and all are scored. Scoring is one narrow pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import crc32_mod, mix64, written

#: Words in a sentence's window; words longer than LONG letters count as several.
WORDS, LONG = 4, 24
#: Characters that a subsequence spans, words that a pair spans, and what each skipped one costs.
SPAN, REACH, DECAY = 5, 3, 0.7
TRIPLES = 64**3
#: Parts of the sample, each scored by a machine that hasn't seen it when sentences are chosen and the curve is fitted.
FOLDS = 3
#: Weight of words and pairs beside letters, and bits of their table.
WORD_WEIGHT, WORD_BITS = 0.7, 20
#: Characters that are scored at once, and of a part of a long text with what the next one repeats.
TOGETHER, PART, OVERLAP = 1 << 18, 1 << 18, 1 << 10
#: Decision value of a text without letters.
LOWEST = -3.0
_PAIRS = [(i, j) for j in range(2, SPAN + 1) for i in range(1, j)]
_SIMILAR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
#: Codes of characters: 0 of none, 1 to 26 of a to z, up to 63 of other letters; of what only looks like a letter the letter's and _DIGIT.
_OTHERS, _DIGIT, _BLANK = 37, 64, 255


def classes():
    """The code of each code point under 0x2E80, _BLANK for white space. Capital letters have the code of small ones."""
    import numpy as np

    out = np.zeros(0x2E80, dtype=np.uint8)
    for point in range(0x2E80):
        c = chr(point).lower()[0]
        if c.isspace():
            out[point] = _BLANK
        elif c in _SIMILAR:
            out[point] = _DIGIT | ord(_SIMILAR[c]) & 31
        elif c.isalpha():
            out[point] = ord(c) & 31 if "a" <= c <= "z" else 27 + ord(c) % _OTHERS
    return out


def _parts(text: str):
    """The text, or parts of PART characters that end at blanks where there are any, each but the first from about OVERLAP characters before."""
    a = 0
    while len(text) - a > PART:
        b = max(text.rfind(" ", a + PART // 2, a + PART), text.rfind("\n", a + PART // 2, a + PART))
        b = b if b > 0 else a + PART
        yield text[a:b]
        c = max(text.rfind(" ", b - 2 * OVERLAP, b - OVERLAP), text.rfind("\n", b - 2 * OVERLAP, b - OVERLAP))
        a = c if c > 0 else b - OVERLAP
    yield text[a:] if a else text


def flattened(texts: list[str], known):
    """(characters, first of each word, sentence of each word, text of each word), arrays; characters are codes, 0 a blank, sentences far enough apart for no subsequence to join them."""
    import numpy as np

    points = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    none = np.zeros(0, dtype=np.int64)
    kind = known[np.minimum(points, len(known) - 1)]
    far = points >= len(known)
    kind[far] = 27 + points[far] % _OTHERS
    blank = kind == _BLANK
    # Tokens lie between blanks; one of digits that look like letters keeps them only beside enough letters.
    new = ~blank
    new[1:] &= blank[:-1]
    token = np.cumsum(new) - 1
    n = int(token[-1]) + 1 if len(token) else 0
    letter, digit = (kind > 0) & (kind < _DIGIT), (kind >= _DIGIT) & ~blank
    letters, digits = np.bincount(token[letter], minlength=n), np.bincount(token[digit], minlength=n)
    plenty = (letters > 0) & (2 * letters >= digits)
    kept = np.flatnonzero(letter | (digit & plenty[np.maximum(token, 0)]))
    if not len(kept):
        return np.zeros(0, dtype=np.uint8), none, none, none
    # A sentence ends with a line, a text, or a word that a full stop follows; single letters with stops are one word.
    size = np.bincount(token[kept], minlength=n)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(points) + 1) - 1
    last_mark = np.zeros(n, dtype=np.uint32)
    inked = np.flatnonzero(~blank)
    ends_token = np.append(token[inked][1:] != token[inked][:-1], True)
    last_mark[token[inked[ends_token]]] = points[inked[ends_token]]
    line = np.concatenate([[0], np.cumsum(points == 10)])
    breaks = (((last_mark == 46) | (last_mark == 33) | (last_mark == 63)) & (size != 1)) | (line[last] > line[first]) | (line[np.minimum(last + 1, len(points))] > line[first])
    # Of the tokens that have letters: sentence and text.
    alive = np.flatnonzero(size)
    sentence = np.concatenate([[0], np.cumsum(breaks)])[:-1][alive]
    offsets = np.cumsum([len(t) + 1 for t in texts])
    text = np.searchsorted(offsets, first[alive], side="right")
    size = size[alive]
    fresh = np.ones(len(alive), dtype=bool)  # whether a sentence begins
    fresh[1:] = sentence[1:] != sentence[:-1]
    glued = np.zeros(len(alive), dtype=bool)
    glued[1:] = (size[1:] == 1) & (size[:-1] == 1) & ~fresh[1:]
    gap = np.where(fresh, SPAN + 1, np.where(glued, 0, 1))
    which = np.repeat(np.arange(len(alive)), size)
    place = np.arange(len(kept)) + np.cumsum(gap)[which]
    out = np.zeros(int(place[-1]) + 2 + SPAN, dtype=np.uint8)
    out[place] = kind[kept] & 63
    # Words: tokens that aren't glued to the one before; long ones begin again.
    begin = np.zeros(len(out), dtype=bool)
    start = place[np.concatenate([[0], np.cumsum(size)[:-1]])]
    begin[start[~glued]] = True
    whole = np.flatnonzero(begin)
    at = place - whole[np.searchsorted(whole, place, side="right") - 1]
    begin[place[at % LONG == 0]] = True
    words = np.flatnonzero(begin)
    owner = np.searchsorted(start, words, side="right") - 1
    return out, words, sentence[owner], text[owner]


def triples(out):
    """(numbers, decay) of the subsequences of three characters from each character on, one array for each pattern of gaps; 0 for those of blanks side by side."""
    import numpy as np

    c = np.concatenate([out, np.zeros(SPAN, dtype=np.uint8)]).astype(np.int32)
    n = len(out)
    a = c[:n] << 12
    for i, j in _PAIRS:
        b = c[i : n + i]
        number = a | b << 6 | c[j : n + j]
        number[((a == 0) | (c[j : n + j] == 0)) & (b == 0)] = 0
        yield number, DECAY ** (j - 2)


def word_numbers(out, words, sentence):
    """(first word, number, decay) of the words and of the pairs of a sentence's words, as arrays for each distance."""
    import numpy as np

    ends = np.append(words[1:], len(out))
    code = out.astype(np.uint64)
    inside = np.arange(len(out)) - words[np.maximum(np.searchsorted(words, np.arange(len(out)), side="right") - 1, 0)]
    power = np.ones(64, dtype=np.uint64)
    power[1:] = np.uint64(0x9E3779B97F4A7C15)
    np.multiply.accumulate(power, out=power)
    total = np.concatenate([[np.uint64(0)], np.cumsum(code * power[np.clip(inside, 0, 63)])])
    h = mix64(total[ends] - total[words])
    shift = np.uint64(64 - WORD_BITS)
    yield np.arange(len(words)), (h >> shift).astype(np.int64), 1.0
    for d in range(1, REACH + 1):
        both = np.flatnonzero(sentence[d:] == sentence[:-d])
        yield both, (mix64(h[both] * np.uint64(0xBF58476D1CE4E5B9 + 2 * d) + h[both + d]) >> shift).astype(np.int64), DECAY ** (d - 1)


def stops(out, words, sentence):
    """Where each word ends."""
    import numpy as np

    end = np.append(words[1:], len(out)) - 1
    end[np.append(sentence[1:] != sentence[:-1], True)] -= SPAN
    return end


def windows(out, words, sentence, width: int):
    """(first word, last word, first character, end, scale) of every run of `width` words of a sentence, or of a shorter sentence."""
    import numpy as np

    n = len(words)
    new = np.ones(n, dtype=bool)
    new[1:] = sentence[1:] != sentence[:-1]
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], n)
    end = np.repeat(ends, ends - starts)
    first = np.flatnonzero(new | (np.arange(n) + width <= end))
    last = np.minimum(first + width, end[first]) - 1
    a = words[first] - 1
    b = stops(out, words, sentence)[last]
    return first, last, a, b, 1.0 / np.sqrt(np.maximum(b - a, 16))


def values(model, out, words, sentence, width: int):
    """The decision value of each window."""
    import numpy as np

    table, by_word, bias = model
    g = np.zeros(len(out), dtype=np.float32)
    for number, decay in triples(out):
        g += np.float32(decay) * table[number]
    h = np.zeros(len(words), dtype=np.float64)
    for at, number, decay in word_numbers(out, words, sentence):
        h[at] += WORD_WEIGHT * decay * by_word[number]
    g = np.concatenate([[0.0], np.cumsum(g, dtype=np.float64)])
    h = np.concatenate([[0.0], np.cumsum(h)])
    first, last, a, b, scale = windows(out, words, sentence, width)
    return (g[b] - g[a] + h[last + 1] - h[first]) * scale + bias


def features(out, words, sentence, width: int, chosen):
    """(row, feature, value) of the chosen windows: triples by number, words and pairs above them, summed up by row and feature."""
    import numpy as np

    first, last, a, b, scale = (x[chosen] for x in windows(out, words, sentence, width))
    rows, ids, weights = [], [], []
    length = b - a
    row = np.repeat(np.arange(len(a)), length)
    at = np.arange(len(row)) + np.repeat(a - (np.cumsum(length) - length), length)
    for number, decay in triples(out):
        number = number[at]
        ok = number > 0
        rows.append(row[ok])
        ids.append(number[ok].astype(np.int64))
        weights.append(np.full(int(ok.sum()), decay))
    count = last - first + 1
    row = np.repeat(np.arange(len(a)), count)
    at = np.arange(len(row)) + np.repeat(first - (np.cumsum(count) - count), count)
    for of, number, decay in word_numbers(out, words, sentence):
        full = np.full(len(words), -1, dtype=np.int64)
        full[of] = number
        number = full[at]
        ok = number >= 0
        rows.append(row[ok])
        ids.append(number[ok] + TRIPLES)
        weights.append(np.full(int(ok.sum()), WORD_WEIGHT * decay))
    # The map has WORD_WEIGHT once, so that the kernel has its square and a table's entry is met with WORD_WEIGHT again.
    rows, ids, weights = map(np.concatenate, (rows, ids, weights))
    key, where = np.unique(rows << 32 | ids, return_inverse=True)
    row = key >> 32
    return row, key & 0xFFFFFFFF, np.bincount(where, weights) * scale[row]


class Landmarks:
    """Sparse rows of features, met by feature; features that OFTEN or more of the rows have are kept as a dense matrix."""

    OFTEN = 12

    def __init__(self, row, ids, value, n: int):
        import numpy as np

        order = np.argsort(ids, kind="stable")
        self.columns, first = np.unique(ids[order], return_index=True)
        self.first = np.append(first, len(ids))
        self.row, self.value, self.n = row[order], value[order], n
        often = np.diff(self.first) >= self.OFTEN
        self.place = np.where(often, np.cumsum(often) - 1, -1)
        self.dense = np.zeros((int(often.sum()), n), dtype=np.float32)
        where = np.repeat(self.place, np.diff(self.first))
        self.dense[where[where >= 0], self.row[where >= 0]] = self.value[where >= 0]

    def kernel(self, row, ids, value, n: int):
        """Of n rows of features, sorted by row, with the landmarks."""
        import numpy as np

        out = np.zeros((n, self.n), dtype=np.float32)
        at = np.minimum(np.searchsorted(self.columns, ids), len(self.columns) - 1)
        ok = self.columns[at] == ids
        row, at, value = row[ok], at[ok], value[ok]
        place = self.place[at]
        often, rare = place >= 0, place < 0
        rows_often, place, value_often = row[often], place[often], value[often].astype(np.float32)
        row, at, value = row[rare], at[rare], value[rare]
        for k in range(0, n, 256):
            m = min(256, n - k)
            x, y = np.searchsorted(rows_often, (k, k + m))
            part = np.zeros((m, len(self.dense)), dtype=np.float32)
            part[rows_often[x:y] - k, place[x:y]] = value_often[x:y]
            x, y = np.searchsorted(row, (k, k + m))
            met = self.first[at[x:y] + 1] - self.first[at[x:y]]
            who = np.repeat(np.arange(x, y), met)
            which = np.arange(len(who)) + np.repeat(self.first[at[x:y]] - (np.cumsum(met) - met), met)
            flat = (row[who] - k) * self.n + self.row[which]
            out[k : k + m] = part @ self.dense + np.bincount(flat, value[who] * self.value[which], m * self.n).reshape(m, self.n)
        return out

    def weighted(self, weight):
        """(columns, sum over landmarks of weight times row)."""
        import numpy as np

        where = np.repeat(np.arange(len(self.columns)), np.diff(self.first))
        return self.columns, np.bincount(where, weight[self.row] * self.value, len(self.columns)).astype(np.float32)


def fit_svm(z, y, weight, start=None, ridge: float = 3e-4, steps: int = 20, far: float = 1.0):
    """Squared-hinge SVM by Newton steps, then again without the rows that lie beyond `far` on the other side; z has a column of ones."""
    import numpy as np

    w, use = np.zeros(z.shape[1]) if start is None else start, np.ones(len(y), dtype=bool)
    for _ in range(2):
        for _ in range(steps):
            inside = use & (y * (z @ w) < 1)
            if not inside.any():
                break
            zi = z[inside] * weight[inside, None].astype(np.float32)
            new = np.linalg.solve(ridge * weight.sum() * np.eye(len(w)) + zi.T @ z[inside], zi.T @ y[inside])
            done = np.abs(new - w).max() < 1e-3 * np.abs(new).max()
            w = new
            if done:
                break
        use = y * (z @ w) > -far
    return w


def joined(sentences: list[bytes]):
    """flattened() of windows as _chosen gives them: characters with what follows, each a sentence of its own."""
    import numpy as np

    lead = b"\0" * (SPAN + 1)
    out = np.frombuffer(lead + lead.join(sentences) + lead, dtype=np.uint8)  # as many blanks at the end as flattened() leaves
    blank = out == 0
    begin = ~blank
    begin[1:] &= blank[:-1]
    sizes = np.array([len(s) + SPAN + 1 for s in sentences])
    starts = np.cumsum(sizes) - sizes + SPAN + 1
    whole = np.flatnonzero(begin)
    inked = np.flatnonzero(~blank)
    at = inked - whole[np.searchsorted(whole, inked, side="right") - 1]
    begin[inked[at % LONG == 0]] = True
    words = np.flatnonzero(begin)
    return out, words, np.searchsorted(starts, words, side="right") - 1


def fit_machines(sentences: list[bytes], toxic, fold, landmarks: int, width: int):
    """Machines fitted on the sentence windows of all folds but one, for each fold, and on all; as (features, weights, bias)."""
    import numpy as np

    def mapped(some):
        out, words, sentence = joined(some)
        first = windows(out, words, sentence, width)[0]
        begins = np.ones(len(first), dtype=bool)
        begins[1:] = sentence[first[1:]] != sentence[first[:-1]]
        return *features(out, words, sentence, width, np.flatnonzero(begins)), len(some)

    pick = np.random.default_rng(7)
    base = []
    for side in (True, False):
        distinct = sorted({s for s, t in zip(sentences, toxic, strict=True) if t == side})
        base += [distinct[i] for i in pick.permutation(len(distinct))[: landmarks // 2 if side else landmarks - len(base)]]
    marks = Landmarks(*mapped(base))
    eigen, vectors = np.linalg.eigh(marks.kernel(*mapped(base)).astype(np.float64))
    kept = eigen > 1e-5 * eigen.max()
    root = (vectors[:, kept] / np.sqrt(eigen[kept])).astype(np.float32)
    # A last row is a sentence that shares nothing with any landmark: it is clean, as a text no word of which was seen must be.
    z = np.zeros((len(sentences) + 1, root.shape[1] + 1), dtype=np.float32)
    for i in range(0, len(sentences), 1024):
        z[i : min(i + 1024, len(sentences)), :-1] = marks.kernel(*mapped(sentences[i : i + 1024])) @ root
    z[:, -1] = 1
    y = np.append(np.where(toxic, 1.0, -1.0), -1.0)
    weight = np.where(y > 0, max(1.0, (y < 0).sum() / max((y > 0).sum(), 1) / 4), 1.0)
    weight[-1] = weight.sum() / 50
    fold = np.append(fold, FOLDS)
    whole = fit_svm(z, y, weight)
    fitted = [fit_svm(z[fold != f], y[fold != f], weight[fold != f], whole) for f in range(FOLDS)]
    return [(*marks.weighted(root.astype(np.float64) @ w[:-1]), float(w[-1])) for w in (*fitted, whole)]


def tables(machine):
    """(table, table of words, bias) of a machine."""
    import numpy as np

    columns, weight, bias = machine
    table, by_word = np.zeros(TRIPLES, dtype=np.float32), np.zeros(1 << WORD_BITS, dtype=np.float32)
    low = columns < TRIPLES
    table[columns[low]] = weight[low]
    by_word[columns[~low] - TRIPLES] = weight[~low]
    return table, by_word, bias


def fit_curve(f, y, steps: int = 50):
    """(slope, offset) of the logistic curve of labels y over values f; the slope is positive."""
    import numpy as np

    x = np.stack([f, np.ones(len(f))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w + np.clip(np.linalg.solve(h, x.T @ (y - p) - 1e-3 * w), -2, 2)
    return max(float(w[0]), 1e-3), float(w[1])


def _groups(texts: list):
    """(numbers of texts, parts) of at most about TOGETHER characters, the parts of a long text in several."""
    numbers, parts, size = [], [], 0
    for i, text in enumerate(texts):
        for part in _parts(text or ""):
            if parts and size + len(part) > TOGETHER:
                yield numbers, parts
                numbers, parts, size = [], [], 0
            numbers.append(i)
            parts.append(part)
            size += len(part)
    if parts:
        yield numbers, parts


def most_toxic_of(model, texts: list, known, width: int = WORDS):
    """The highest decision value of each text."""
    import numpy as np

    best = np.full(len(texts), LOWEST)
    for numbers, parts in _groups(texts):
        out, words, sentence, text = flattened(parts, known)
        if len(words):
            value = values(model, out, words, sentence, width)
            np.maximum.at(best, np.array(numbers)[text[windows(out, words, sentence, width)[0]]], value)
    return best


def _scored(sent):
    def run(batches):
        import pyarrow as pa

        model, known = tables(sent.value), classes()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(most_toxic_of(model, batch.column("text").to_pylist(), known))], names=["id", "value"])

    return run


def chosen_of(model, texts: list, known, width: int, most: int):
    """Up to `most` sentence windows of each text, of highest value, or without a model of least hash; as lists of bytes.

    Windows are codes of characters, with the words that follow in the sentence up to REACH.
    """
    import numpy as np
    import xxhash

    found = [[] for _ in texts]
    for numbers, parts in _groups(texts):
        out, words, sentence, text = flattened(parts, known)
        if not len(words):
            continue
        at, last, a, _, _ = windows(out, words, sentence, width)
        stop = stops(out, words, sentence)
        final = last.copy()
        for d in range(1, REACH + 1):
            more = np.minimum(last + d, len(words) - 1)
            same = sentence[more] == sentence[last]
            final[same] = more[same]
        part = text[at]
        if model is not None:
            order = -values(model, out, words, sentence, width)
        else:
            seeds = np.array([xxhash.xxh3_64_intdigest(p.encode("utf-8", "replace")) for p in parts], dtype=np.uint64)
            inside = at - np.searchsorted(text, part)
            order = mix64(seeds[part] + inside.astype(np.uint64)).astype(np.float64)
        sorted_at = np.lexsort((at, order, part))
        rank = np.arange(len(at)) - np.searchsorted(part[sorted_at], part[sorted_at])
        for k in sorted_at[rank < most].tolist():
            found[numbers[part[k]]].append((float(order[k]), bytes(out[a[k] + 1 : stop[final[k]]]).strip(b"\0")))
    return [[w for _, w in sorted(f)[:most]] for f in found]


def _by_fold(batch, sent):
    """(model, row numbers) of the rows of each fold of a batch; the model is the one that hasn't seen them."""
    fold = batch.column("fold").to_numpy(zero_copy_only=False)
    for f in range(FOLDS):
        rows = (fold == f).nonzero()[0]
        if len(rows):
            yield None if sent is None else tables(sent.value[f]), rows.tolist()


def _chosen(sent, first: tuple[int, int], width: int):
    """(toxic, fold, window) of rows (text, toxic, fold): the most toxic window of each text, or without machines some at first, of toxic and of clean texts."""

    def run(batches):
        import pyarrow as pa

        known = classes()
        for batch in batches:
            texts, toxic = batch.column("text").to_pylist(), batch.column("toxic").to_pylist()
            out = [], [], []
            for model, rows in _by_fold(batch, sent):
                for side, most in ((True, first[0]), (False, first[1])):
                    mine = [i for i in rows if toxic[i] == side]
                    for i, windows_of in zip(mine, chosen_of(model, [texts[i] for i in mine], known, width, 1 if model else most), strict=True):
                        for w in windows_of:
                            for column, v in zip(out, (side, batch.column("fold")[i].as_py(), w), strict=True):
                                column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.bool_()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary())], names=["toxic", "fold", "window"])

    return run


def _unseen(sent):
    """(value, toxic) of rows (text, toxic, fold), by the machine that was fitted on the other folds."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        known = classes()
        for batch in batches:
            texts, value = batch.column("text").to_pylist(), np.zeros(batch.num_rows)
            for model, rows in _by_fold(batch, sent):
                value[rows] = most_toxic_of(model, [texts[i] for i in rows], known)
            yield pa.RecordBatch.from_arrays([pa.array(value), batch.column("toxic")], names=["value", "toxic"])

    return run


class Model:
    """What fit() learned: tables over subsequences with their bias, and the curve."""

    def __init__(self, machine, slope: float = 1.0, offset: float = 0.0):
        self.machine, self.slope, self.offset = machine, slope, offset

    def values(self, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        kind = docs.schema[id_col].dataType.simpleString()
        sent = docs.sparkSession.sparkContext.broadcast(self.machine)
        return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_scored(sent), f"id {kind}, value double")

    def score(self, value):
        return 1 / (1 + F.exp(-(value * self.slope + self.offset)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    most_toxic: int = 4000,
    most_clean: int = 8000,
    landmarks: int = 400,
    first: int = 16,
    first_in_all: int = 12_000,
    widths: tuple[int, ...] = (2 * WORDS, WORDS, WORDS),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model | None:
    """Learns from labels (id, toxic) of docs. The sample is of the labels, among those of ids that docs has, whose hashed ids come first, and is written once."""
    context = docs.sparkSession.sparkContext
    known = labels.filter(F.col(id_col).isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col(id_col).alias("id")).agg((F.max("toxic") > 0).alias("toxic"))
    # Labels of ids that docs doesn't have use up none of the sample.
    known = known.join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")
    ordered = [known.filter(F.col("toxic") == side).orderBy(F.xxhash64("id"), "id").limit(n) for side, n in ((True, most_toxic), (False, most_clean))]
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ordered[0].unionByName(ordered[1])), "id")
    # Of rows with one id, the text of least hash.
    sample = sample.groupBy("id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("toxic").alias("toxic")).withColumn("fold", F.pmod(F.hash("id"), F.lit(FOLDS)).cast("int"))
    sample = written(sample.repartition(max(8, context.defaultParallelism), "id").select("text", "toxic", "fold"), "toxicity-sample")

    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None
    each = tuple(max(1, min(first, first_in_all // sizes[side])) for side in (True, False))
    machines, clean = None, set()
    for width in widths:
        # At most first_in_all windows of toxic and of clean rows, or one of each row.
        met = sample.mapInArrow(_chosen(context.broadcast(machines[:-1]) if machines else None, each, width), "toxic boolean, fold int, window binary").toArrow()
        rows = list(zip(met["window"].to_pylist(), met["toxic"].to_pylist(), met["fold"].to_pylist(), strict=True))
        toxic = sorted((w, f) for w, t, f in rows if t)
        clean |= {(w, f) for w, t, f in rows if not t}
        if not toxic or not clean:
            return None
        machines = _fitted(toxic, sorted(clean), landmarks, width)
    model = Model(machines[-1])
    met = sample.mapInArrow(_unseen(context.broadcast(machines[:-1])), "value double, toxic boolean").toArrow()
    model.slope, model.offset = fit_curve(met["value"].to_numpy(), met["toxic"].to_numpy().astype(float))
    return model


def _fitted(toxic: list[tuple[bytes, int]], clean: list[tuple[bytes, int]], landmarks: int, width: int):
    import numpy as np

    rows = toxic + clean
    return fit_machines([w for w, _ in rows], np.array([True] * len(toxic) + [False] * len(clean)), np.array([f for _, f in rows]), landmarks, width)


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, held_out, score, predicted), one row per row of docs; ids in fold 0 of crc32 are held out of the fit."""
    learned = labels.filter(crc32_mod(id_col, folds) != 0)
    model = fit(docs, learned, id_col=id_col, text_col=text_col, **options)
    if model is None:
        scored = docs.select(F.col(id_col).alias("id"), F.lit(0.0).alias("score"))
    else:
        scored = model.values(docs, id_col, text_col).select("id", model.score(F.col("value")).alias("score"))
    return scored.select(F.col("id").alias(id_col), "score").select(id_col, (crc32_mod(id_col, folds) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, folds: int = 5, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs with a score under one half."""
    model = fit(docs, labels.filter(crc32_mod(id_col, folds) != 0), id_col=id_col, text_col=text_col, **options)
    if model is None:
        return docs
    sent, least = docs.sparkSession.sparkContext.broadcast(model.machine), -model.offset / model.slope

    def run(batches):
        import pyarrow as pa

        machine, known = tables(sent.value), classes()
        for batch in batches:
            yield batch.filter(pa.array(most_toxic_of(machine, batch.column(text_col).to_pylist(), known) < least))

    return docs.mapInArrow(run, docs.schema)
