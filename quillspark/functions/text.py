"""Column functions over text: characters, white space, mark-up, markers, overlap.

All of them are expressions that Spark compiles; none calls Python. White space
is meant as Unicode has it (`(?U)` in patterns), except where a set is given.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
DOT = "ㆍ"
DOT_VARIANTS = "·ᆞ‧∙•・"
ITEM_LETTERS = "가나다라마바사아자차카타파하"
BULLETS = "▶▷■○●"
BOX_LINES = "┌┬┐│└┴┘├┤┼─━"
SPACES = r"\u0009\u0020\u00A0\u1680\u2000-\u200A\u202F\u205F\u3000"
TARGET_CHARS = 1500
EXCERPT_CHARS = 2000

_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F))) + "\u3000"
_NARROW = "".join(map(chr, range(0x21, 0x7F))) + " "


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def dot_variants(c: Column | str) -> Column:
    """How many middle dots are not the unified one."""
    return (F.length(col(c)) - F.length(F.translate(col(c), DOT_VARIANTS, ""))).cast("long")


def unify_chars(c: Column | str) -> Column:
    """One middle dot for all its variants; full-width ASCII and the ideographic space become ASCII."""
    return F.translate(F.translate(col(c), DOT_VARIANTS, DOT * len(DOT_VARIANTS)), _WIDE, _NARROW)


def squeeze_space(c: Column | str) -> Column:
    """Runs of spaces become one, lines are trimmed, empty lines go; line ends stay."""
    one = F.regexp_replace(col(c), f"[{SPACES}]+", " ")
    trimmed = F.regexp_replace(one, r"(?U)(?<=\n)[\s&&[^\n]]+|[\s&&[^\n]]+(?=\n)", "")
    return strip(F.regexp_replace(trimmed, r"\n{2,}", "\n"))


def br_to_newline(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"(?i)<br\s*/?>", "\n")


def br_count(c: Column | str) -> Column:
    return F.regexp_count(col(c), F.lit(r"(?i)<br\s*/?>")).cast("long")


# Fixed value: tags whose names start with a Latin letter; amendment notes in angle brackets are none.
TAG = r"</?[A-Za-z][A-Za-z0-9]*[^>]*>"


def strip_tags(c: Column | str, replacement: str = " ") -> Column:
    return F.regexp_replace(col(c), TAG, replacement)


def tag_count(c: Column | str) -> Column:
    return F.regexp_count(col(c), F.lit(TAG)).cast("long")


# Fixed value.
IMAGE = r"<img[^>]*>\s*(?:</img>)?"


def _image_keys(c: Column) -> Column:
    """The source of each image tag; one without has a key from the number of sources before it, which is new unless it came just before."""
    tags = F.regexp_extract_all(c, F.lit(IMAGE), F.lit(0))
    empty = F.array().cast("array<string>")

    def add(keys: Column, tag: Column) -> Column:
        own = F.when(tag.rlike('src="[^"]*"'), F.regexp_extract(tag, 'src="([^"]*)"', 1)).otherwise(F.concat(F.lit("__nosrc_"), F.size(F.array_distinct(keys)).cast("string")))
        return F.concat(keys, F.array(own))

    return F.aggregate(tags, empty, add)


def image_count(c: Column | str) -> Column:
    return F.size(F.array_distinct(_image_keys(col(c)))).cast("long")


def image_markers(c: Column | str, label: str = "이미지") -> Column:
    """Image tags as [label N], N counting distinct sources by first appearance."""
    keys = _image_keys(col(c))
    pieces = F.split(col(c), IMAGE, -1)
    marks = F.transform(keys, lambda k: F.concat(F.lit(f"[{label}"), F.array_position(F.array_distinct(keys), k).cast("string"), F.lit("]")))
    joined = F.concat(F.array(F.element_at(pieces, 1)), F.zip_with(marks, F.slice(pieces, 2, F.size(keys)), lambda m, p: F.concat(m, p)))
    return F.when(F.size(keys) == 0, col(c)).otherwise(F.array_join(joined, ""))


def restore_item_breaks(c: Column | str) -> Column:
    """Line breaks before bullets, escaped dashes, and item markers that stand after a space; a number after a number is a date, not a marker."""
    out = F.regexp_replace(col(c), rf"(?U)(?<=\S)[{SPACES}]*([{BULLETS}])", "\n$1")
    out = F.regexp_replace(out, rf"(?U)(?<=\S)[{SPACES}]*(\\-)", "\n$1")
    marker = rf"(?U)(?<=\S)(?:[{SPACES}]+([{ITEM_LETTERS}]\.)|(?<!\d)(?<!\d\.)[{SPACES}]+(\d{{1,2}}\.))(?=[{SPACES}])"
    out = F.regexp_replace(out, marker, "\n$1$2")
    return F.regexp_replace(out, rf"(?U)(?<=\S)[{SPACES}]+([①-⑮])", "\n$1")


def squash(c: Column | str) -> Column:
    """Without any white space or backslash, for comparing quotations."""
    return F.regexp_replace(col(c), r"(?U)[\s\\]+", "")


def deleted_article(c: Column | str) -> Column:
    return strip(c).rlike(r"(?U)^제\d+조(의\d+)?\s*(\([^)]*\))?\s*삭제")


def deleted_appendix(c: Column | str) -> Column:
    return F.contains(col(c), F.lit("삭제")) & (deleted_article(c) | (F.length(strip(c)) <= 60))


def repealed(c: Column | str) -> Column:
    return strip(c).rlike(r"(?U)^제\d+조(?:의\d+)?\s*삭제\b")


def appendix_unit(kind: Column | str) -> Column:
    """Whether a unit's kind is an appendix (not a form); an unknown kind raises when the value is used."""
    return (
        F.when(col(kind).isin("1", "별표"), True)
        .when(col(kind).isin("2", "3", "4", "서식", "별지", "별지서식"), False)
        .otherwise(F.raise_error(F.concat(F.lit("unknown appendix kind: "), F.coalesce(col(kind), F.lit("null")))).cast("boolean"))
    )


def _no_zeros(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), "^0+", "")


def appendix_locator(number: Column | str, branch: Column | str) -> Column:
    n, b = _no_zeros(col(number)), _no_zeros(col(branch))
    return F.concat(F.lit("별표"), F.when(n != "", F.concat(F.lit(" "), n)).otherwise(""), F.when(b != "", F.concat(F.lit("의"), b)).otherwise(""))


def article_locator(number: Column | str, branch: Column | str) -> Column:
    b = F.coalesce(F.try_to_number(F.nullif(strip(F.coalesce(col(branch), F.lit(""))), F.lit("")), F.lit("999999")).cast("int"), F.lit(0))
    return F.concat(F.lit("제"), col(number).cast("int").cast("string"), F.lit("조"), F.when(b != 0, F.concat(F.lit("의"), b.cast("string"))).otherwise(""))


def vocabulary_hits(text: Column, terms: list[str]) -> Column:
    """The terms that the text contains, in the order of the vocabulary."""
    return F.filter(F.array(*map(F.lit, terms)), lambda t: F.contains(text, t)) if terms else F.array().cast("array<string>")


def missing_text(body: Column | str, expected: Column | str) -> Column:
    """Those of an array of snippets that a text, both normalised to one line, doesn't contain."""
    line = lambda x: F.regexp_replace(squeeze_space(unify_chars(x)), "\n", " ")
    found = line(col(body))
    return F.filter(col(expected), lambda s: ~F.contains(found, line(s)))


def unanchored_markers(body: Column | str, markers: Column | str) -> Column:
    """Those of an array of markers that begin no line of a text."""
    lines = F.transform(F.split(col(body), "\n"), strip)
    return F.filter(col(markers), lambda m: ~F.exists(lines, lambda x: F.startswith(x, m)))


def paragraphs(c: Column | str) -> Column:
    """Pieces between <br/> marks, stripped, none of them empty."""
    return F.filter(F.transform(F.split(col(c), "<br/>", -1), strip), lambda p: p != "")


def sections(c: Column | str) -> Column:
    """array<struct<name, body>>: what stands under each heading in 【 】; text before the first has the name ''."""
    header = "【[^】]*】"
    names = F.transform(F.regexp_extract_all(col(c), F.lit("【([^】]*)】"), F.lit(1)), lambda n: F.regexp_replace(n, r"(?U)\s+", ""))
    bodies = F.split(col(c), header, -1)
    all_names = F.concat(F.array(F.lit("")), names)
    zipped = F.zip_with(all_names, bodies, lambda n, b: F.struct(n.alias("name"), b.alias("body")))
    starts = F.substring(col(c), 1, 1) == "【"
    return F.when(F.size(names) == 0, zipped).when(starts & (F.element_at(bodies, 1) == ""), F.slice(zipped, 2, F.size(bodies))).otherwise(zipped)


def marker(p: Column | str) -> Column:
    """struct<level, label> of the marker that a paragraph opens with, or null: digit, hangul or paren."""
    p = col(p)
    digit = r"(?U)^(\d{1,2})\.(?!\d)(?!\s*\d{1,2}\.)"
    hangul = r"^([가-힣])\."
    paren = r"(?U)^\((\d+)\)"
    return (
        F.when(p.rlike(digit), F.struct(F.lit("digit").alias("level"), F.regexp_extract(p, digit, 1).alias("label")))
        .when(p.rlike(hangul), F.struct(F.lit("hangul").alias("level"), F.regexp_extract(p, hangul, 1).alias("label")))
        .when(p.rlike(paren), F.struct(F.lit("paren").alias("level"), F.concat(F.lit("("), F.regexp_extract(p, paren, 1), F.lit(")")).alias("label")))
    )


def locator(*parts: Column) -> Column:
    """Parts that are neither null nor empty, joined by ' > '."""
    return F.array_join(F.filter(F.array(*parts), lambda p: p.isNotNull() & (p != "")), " > ")


def issue_text(c: Column | str) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(col(c), "<br/>", " "), r"(?U)\s+", " "))


def issues(c: Column | str) -> Column:
    """map<int, string> of a field's numbered issues.

    `[1][2] text` gives the text to both; what a number gets more than once is joined by '; '; a field
    without numbers is issue 1; text before the first number is left out; an empty field has none.
    """
    field = strip(F.coalesce(col(c), F.lit("")))
    numbers = F.transform(F.regexp_extract_all(field, F.lit(r"(?U)\[(\d+)\]\s*"), F.lit(1)), lambda n: n.cast("int"))
    texts = F.transform(F.slice(F.split(field, r"(?U)\[\d+\]\s*", -1), 2, F.greatest(F.size(numbers), F.lit(1))), lambda t: t)
    rows = F.zip_with(numbers, texts, lambda n, t: F.struct(n.alias("n"), t.alias("t")))
    # From the last to the first, a number without text takes the text after it.
    none = F.struct(F.lit("").alias("text"), F.array().cast("array<struct<n:int,t:string>>").alias("out"))

    def back(acc: Column, row: Column) -> Column:
        text = F.when(strip(row["t"]) == "", acc["text"]).otherwise(row["t"])
        return F.struct(text.alias("text"), F.concat(F.array(F.struct(row["n"].alias("n"), text.alias("t"))), acc["out"]).alias("out"))

    shared = F.aggregate(F.reverse(rows), none, back)["out"]
    cleaned = F.filter(
        F.transform(shared, lambda r: F.struct(r["n"].alias("n"), F.regexp_replace(F.regexp_replace(issue_text(r["t"]), "[/ ]+$", ""), r"(?U)\s+$", "").alias("t"))), lambda r: r["t"] != ""
    )
    keys = F.array_distinct(F.transform(cleaned, lambda r: r["n"]))
    values = F.transform(keys, lambda k: F.array_join(F.transform(F.filter(cleaned, lambda r: r["n"] == k), lambda r: r["t"]), "; "))
    single = F.create_map(F.lit(1), issue_text(field))
    return F.when(field == "", F.map_from_arrays(F.array().cast("array<int>"), F.array().cast("array<string>"))).when(F.size(numbers) == 0, single).otherwise(F.map_from_arrays(keys, values))


def table_spans(c: Column | str, chars: str = BOX_LINES) -> Column:
    """array<struct<a, b>>: code point ranges of runs of lines that hold one of `chars`."""
    lines = F.split(col(c), "\n", -1)
    none = F.struct(F.lit(0).alias("at"), F.lit(-1).alias("open"), F.array().cast("array<struct<a:int,b:int>>").alias("out"))

    def step(acc: Column, line: Column) -> Column:
        boxed = line.rlike(f"[{chars}]")
        closes = ~boxed & (acc["open"] >= 0)
        return F.struct(
            (acc["at"] + F.length(line) + 1).alias("at"),
            F.when(boxed & (acc["open"] < 0), acc["at"]).when(closes, F.lit(-1)).otherwise(acc["open"]).alias("open"),
            F.when(closes, F.concat(acc["out"], F.array(F.struct(acc["open"].alias("a"), (acc["at"] - 1).alias("b"))))).otherwise(acc["out"]).alias("out"),
        )

    return F.aggregate(
        lines, none, step, lambda acc: F.when(acc["open"] >= 0, F.concat(acc["out"], F.array(F.struct(acc["open"].alias("a"), (acc["at"] - 1).alias("b"))))).otherwise(acc["out"])
    )


def pack_lines(c: Column | str, target: int = TARGET_CHARS) -> Column:
    """Whole lines put together into pieces of at most `target` characters; a longer line is a piece of its own."""
    none = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"))

    def step(acc: Column, line: Column) -> Column:
        full = acc["open"].isNotNull() & (F.length(acc["open"]) + 1 + F.length(line) > target)
        return F.struct(
            F.when(full, F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"]).alias("done"),
            F.when(full | acc["open"].isNull(), line).otherwise(F.concat(acc["open"], F.lit("\n"), line)).alias("open"),
        )

    return F.aggregate(F.split(col(c), "\n", -1), none, step, lambda acc: F.concat(acc["done"], F.array(acc["open"])))


def citation_list(c: Column | str) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(col(c), F.lit("")), "; ", -1), strip), lambda x: x != "")


def excerpt(c: Column | str, most: int = EXCERPT_CHARS) -> Column:
    return F.when(F.length(col(c)) > most, F.concat(F.substring(col(c), 1, most - 3), F.lit("..."))).otherwise(col(c))


def bigrams(c: Column) -> Column:
    n = F.length(c)
    return F.when(n < 2, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(c, i, F.lit(2)))))


def bigram_overlap(question: Column | str, source: Column | str) -> Column:
    """Share of the question's distinct character pairs that the source has; 0 for a question of fewer than two characters."""
    q = bigrams(col(question))
    return F.when(F.size(q) == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(q, bigrams(col(source)))) / F.size(q))


def clipped_case(body: Column | str, whole: int = 12000, head: int = 8000, tail: int = 4000, mark: str = "\n...\n") -> Column:
    """A long text's beginning and end around a mark."""
    return F.when(F.length(col(body)) > whole, F.concat(F.substring(col(body), 1, head), F.lit(mark), F.right(col(body), F.lit(tail)))).otherwise(col(body))


def token_cost(tokens_in: Column | str, tokens_out: Column | str, usd_in: float, usd_out: float) -> Column:
    """US dollars, prices being for a million tokens, to six digits."""
    return F.round((col(tokens_in) * usd_in + col(tokens_out) * usd_out) / 1e6, 6)
