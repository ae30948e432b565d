"""Readers and writers: JSON lines, JSON arrays, XML responses, artifact stores."""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions import text as tx


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store Spark reads it from."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, missing_ok: bool = True, empty_ok: bool = True) -> DataFrame:
    """JSON lines; a missing file has no rows if that is allowed, and an empty one raises if that isn't."""
    if not exists(spark, path):
        if not missing_ok:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if not empty_ok and rows.isEmpty():
        raise ValueError(f"no rows in {path}")
    return rows


def read_questions(spark: SparkSession, path: str, expected: int | None = 55) -> DataFrame:
    """An evaluation set, one JSON array; another number of rows than expected raises."""
    schema = "id int, question string, domain string, expected_status string, source_chunk_id string, relevant_chunk_ids array<string>, notes string"
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    if expected is not None and (n := rows.count()) != expected:
        raise ValueError(f"{n} questions; {expected} are expected")
    return rows


def described_files(spark: SparkSession, paths: list[str], kind: str) -> DataFrame:
    """(path, kind, sha256, byteSize) of files, hashed by the executors."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select("path", F.lit(kind).alias("kind"), F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("sha256"), F.col("length").alias("byteSize"))


def write_jsonl(rows: DataFrame, path: str, order: list[str] | None = None, keep_nulls: bool = True) -> None:
    """JSON lines of all columns. With an order, the files are numbered in it."""
    options = {"ignoreNullFields": "false" if keep_nulls else "true"}
    text = F.to_json(F.struct(*rows.columns), options).alias("value")
    if order:
        # Ordered in parallel; files are numbered in that order, so no single task writes all.
        rows.orderBy(*order).select(text).write.mode("overwrite").text(path)
    else:
        rows.select(text).write.mode("overwrite").text(path)


def write_by_label(rows: DataFrame, path: str, label: str = "domain_label") -> None:
    rows.write.mode("overwrite").partitionBy(label).json(path)


# XML responses that were fetched and kept, one a row.


# The fields of a law's header and where they are, the fields of its units, and the kind of unit that is an article.
HEADER = {"법령명": "법령명_한글", "법령구분": "법종구분", "소관부처": "소관부처", "공포일자": "공포일자", "시행일자": "시행일자", "법령ID": "법령ID"}
ARTICLE_FIELDS = ["조문번호", "조문가지번호", "조문제목", "조문시행일자"]
APPENDIX_FIELDS = ["별표번호", "별표가지번호", "별표구분", "별표제목", "별표시행일자"]
ARTICLE_KIND = "조문"


def _units(fields: list[str], parse):
    """A column function: of each XML response the law's header and its units, as an array of structs. A response that can't be read raises."""
    names = [*HEADER, *fields, "content"]
    schema = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in names]))

    @F.pandas_udf(schema)
    def read(xml: pd.Series) -> pd.Series:
        out = []
        for text in xml:
            if text is None:
                out.append(None)
                continue
            try:
                root = ET.fromstring(text)
            except ET.ParseError as e:
                raise ValueError(f"a law's response is no XML: {text[:80]!r}") from e
            info = root.find("기본정보")
            header = {n: ((info.findtext(tag) or "").strip() if info is not None else "") for n, tag in HEADER.items()}
            out.append([header | unit for unit in parse(root, fields)])
        return pd.Series(out)

    return read


def _fields(unit, names: list[str]) -> dict:
    return {n: (unit.findtext(n) or "").strip() for n in names}


def _articles(root, fields: list[str]) -> list[dict]:
    found = []
    for unit in root.iter("조문단위"):
        if (unit.findtext("조문여부") or "").strip() == ARTICLE_KIND:
            parts = [(unit.findtext("조문내용") or "").strip(), *("".join(p.itertext()).strip() for p in unit.findall("항"))]
            if content := "\n".join(p for p in parts if p):
                found.append(_fields(unit, fields) | {"content": content})
    if not found:
        raise ValueError("a law's response has no article")
    return found


def _appendices(root, fields: list[str]) -> list[dict]:
    parts = lambda unit: ["".join(c.itertext()) for c in unit.findall("별표내용")]
    return [_fields(u, fields) | {"content": "\n".join(p for p in parts(u) if p.strip())} for u in root.iter("별표단위")]


def law_articles(responses: DataFrame, xml: str = "xml") -> DataFrame:
    """responses with one row for each article that has text: the law's header, number, branch, title, date and content, which is all text of its paragraphs.

    Units that aren't articles are left out; a response that is no XML, or has no article, raises.
    """
    own = [c for c in responses.columns if c != xml]
    return responses.select(*own, F.lit("law_article").alias("doc_type"), F.inline(_units(ARTICLE_FIELDS, _articles)(F.col(xml))))


def law_appendices(responses: DataFrame, xml: str = "xml") -> DataFrame:
    """responses with one row for each appendix unit: the law's header, its fields, content, contentCleaned, locator, and a reason (form, empty, deleted) where it is dropped."""
    from quillspark.operators import cleaning

    own = [c for c in responses.columns if c != xml]
    rows = responses.select(*own, F.lit("law_appendix").alias("doc_type"), F.inline(_units(APPENDIX_FIELDS, _appendices)(F.col(xml))))
    rows = rows.withColumn("contentCleaned", F.when(tx.strip("content") == "", "").otherwise(cleaning.clean_instrument("content")["text"]))
    reason = F.when(~tx.appendix_unit("별표구분"), "form").when(tx.strip("content") == "", "empty").when(tx.deleted_appendix("content"), "deleted")
    return rows.withColumn("locator", tx.appendix_locator("별표번호", "별표가지번호")).withColumn("reason", reason)


def moment(value: Column) -> Column:
    """An ISO timestamp to whole seconds, UTC where it names no zone; null for null, an error for what is none."""
    zoned = F.when(value.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), value).otherwise(F.concat(value, F.lit("Z")))
    return F.date_trunc("second", zoned.cast("timestamp"))


def to_review(found: DataFrame, raw: DataFrame, reviewed: DataFrame, key: str = "serial") -> DataFrame:
    """The raw rows of the serials found that were not reviewed yet; a serial without a raw row raises."""
    pending = found.select(key).distinct().join(reviewed.select(key), key, "left_anti")
    missing = [r[0] for r in pending.join(raw.select(key), key, "left_anti").limit(20).collect()]
    if missing:
        raise KeyError(f"no raw rows for {missing}")
    return raw.join(pending, key, "left_semi")


def resolve_law(found: DataFrame, name: str, kind: str, strict: bool = True, partition: str = "query") -> DataFrame:
    """Of each query's results (법령명, 법령구분, pos) the one with name and kind, else with the name, else, if not strict, the first."""
    rank = F.when((F.col("법령명") == name) & (F.col("법령구분") == kind), 0).when(F.col("법령명") == name, 1).otherwise(2)
    best = found.withColumn("~rank", rank).filter(F.col("~rank") < (2 if strict else 3))
    return best.withColumn("~n", F.row_number().over(Window.partitionBy(partition).orderBy("~rank", "pos"))).filter("`~n` = 1").drop("~rank", "~n")


# Resuming and publishing.


def unseen(found: DataFrame, seen: DataFrame, key: str, order: str) -> DataFrame:
    """Rows whose key isn't among the seen, one for each key, the earliest."""
    first = found.groupBy(key).agg(F.min_by(F.struct(*(c for c in found.columns if c != key)), order).alias("r"))
    return first.select(key, "r.*").join(seen.select(key).distinct(), key, "left_anti").select(*found.columns)


def first_publisher(found: DataFrame, key: str = "serial", publisher: str = "publisher", order: str = "pos") -> DataFrame:
    """(key, publisher): the earliest that isn't empty."""
    return found.filter(tx.strip(F.coalesce(F.col(publisher), F.lit(""))) != "").groupBy(key).agg(F.min_by(publisher, order).alias(publisher))


def hydrated(rows: DataFrame, publishers: DataFrame, key: str, publisher: str) -> DataFrame:
    """rows with empty publishers filled by lookup, of several of a key the least; one that stays empty raises."""
    known = publishers.filter(tx.strip(F.coalesce(F.col(publisher), F.lit(""))) != "").groupBy(F.col(key).alias("~k")).agg(F.min(publisher).alias("~p"))
    out = rows.join(known, F.col(key) == F.col("~k"), "left").withColumn(publisher, F.coalesce(F.nullif(F.col(publisher), F.lit("")), F.col("~p"))).drop("~k", "~p")
    left = [r[0] for r in out.filter(F.col(publisher).isNull()).select(key).limit(20).collect()]
    if left:
        raise ValueError(f"no publisher for {left}")
    return out


def new_artifacts(incoming: DataFrame, stored: DataFrame, kind: str = "precedent") -> DataFrame:
    """incoming (content) with paths by hash, those not stored (path, content); a stored path with other content raises."""
    from quillspark.sources.artifacts import artifact_path

    rows = incoming.withColumn("path", artifact_path(F.col("content"), kind)).dropDuplicates(["path"])
    broken = [r[0] for r in stored.filter(F.col("path") != artifact_path(F.col("content"), kind)).select("path").limit(20).collect()]
    if broken:
        raise ValueError(f"stored artifacts whose content is another: {broken}")
    return rows.join(stored.select("path"), "path", "left_anti")


def replace_folder(spark: SparkSession, staging: str, path: str) -> None:
    """Puts a finished folder in a path's place. The old one stays beside it until then, and comes back if that fails."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    new, final, old = hadoop(staging), hadoop(path), hadoop(f"{path}.previous")
    fs = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(final):
        fs.delete(old, True)
        if not fs.rename(final, old):
            raise OSError(f"{path} can't be moved away")
    if not fs.rename(new, final):
        if fs.exists(old):
            fs.rename(old, final)
        raise OSError(f"{staging} can't be moved to {path}")
    fs.delete(old, True)


def recovered(spark: SparkSession, path: str) -> str:
    """The path, after what an interrupted replacement left beside it is back in its place."""
    if not exists(spark, path) and exists(spark, f"{path}.previous"):
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        final = hadoop(path)
        final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(hadoop(f"{path}.previous"), final)
    return path


def publish(rows: DataFrame, path: str, complete: bool = True) -> None:
    """Writes beside the path and moves the result there; an incomplete result raises and leaves what is there."""
    if not complete:
        raise ValueError("an incomplete collection is not published")
    rows.write.mode("overwrite").json(f"{path}.staging")
    replace_folder(rows.sparkSession, f"{path}.staging", path)


def ordered_markdown(blocks: DataFrame, document: str, position: str, content: str) -> DataFrame:
    """(document, markdown): the blocks of each document in order."""
    return blocks.groupBy(document).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(position, content))), lambda b: b[content]), "").alias("markdown"))


def page_ranges(pages: Column, size: int = 20) -> Column:
    """array<struct<first, last>> of page ranges of a document; none where there are no pages."""
    ranges = F.transform(F.sequence(F.lit(1), F.greatest(pages, F.lit(1)), F.lit(size)), lambda a: F.struct(a.alias("first"), F.least(a + size - 1, pages).alias("last")))
    return F.filter(ranges, lambda r: r["first"] <= r["last"])
