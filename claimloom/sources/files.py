"""Readers and writers: reviews (docx, md, txt), source texts, CSV, JSON lines, Parquet, file inventories."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.operators.reports import last_of

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx_paragraphs(content: bytes) -> list[tuple[str, int | None, str]]:
    """(style, heading level, text) of each body paragraph: level by style name, style id or outline level."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
        styles: dict[str, tuple[str, str | None]] = {}
        if "word/styles.xml" in z.namelist():
            for s in ElementTree.fromstring(z.read("word/styles.xml")).iter(f"{_W}style"):
                name, outline = s.find(f"{_W}name"), s.find(f"{_W}pPr/{_W}outlineLvl")
                styles[s.get(f"{_W}styleId", "")] = (name.get(f"{_W}val", "") if name is not None else "", outline.get(f"{_W}val") if outline is not None else None)
    out = []
    for p in body.findall(f"{_W}p") if body is not None else []:
        ref, own = p.find(f"{_W}pPr/{_W}pStyle"), p.find(f"{_W}pPr/{_W}outlineLvl")
        style_id = ref.get(f"{_W}val", "") if ref is not None else ""
        name, outline = styles.get(style_id, (style_id, None))
        m = re.match(r"(?i)heading\s*(\d+)", name) or re.match(r"(?i)heading\s*(\d+)", style_id)
        outline = own.get(f"{_W}val") if own is not None else outline
        level = int(m.group(1)) if m else int(outline) + 1 if outline and outline.isdigit() and int(outline) < 9 else None
        text = "".join("\t" if t.tag == f"{_W}tab" else "\n" if t.tag in (f"{_W}br", f"{_W}cr") else t.text or "" for t in p.iter() if t.tag in (f"{_W}t", f"{_W}tab", f"{_W}br", f"{_W}cr"))
        out.append((name, level, text))
    return out


def docx_bytes(paragraphs: list[tuple[int | None, str]]) -> bytes:
    """A document of (heading level or None, text) paragraphs; headings carry the usual style names."""
    clean = lambda t: re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]", "", t)  # noqa: E731  not allowed in XML
    root = ElementTree.Element(f"{_W}document")
    body = ElementTree.SubElement(root, f"{_W}body")
    for level, text in paragraphs:
        p = ElementTree.SubElement(body, f"{_W}p")
        if level:
            ElementTree.SubElement(ElementTree.SubElement(p, f"{_W}pPr"), f"{_W}pStyle").set(f"{_W}val", f"Heading{level}")
        t = ElementTree.SubElement(ElementTree.SubElement(p, f"{_W}r"), f"{_W}t")
        t.text = clean(text)
        t.set("{http://www.w3.org/XML/1998/namespace}space", "preserve")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("word/document.xml", ElementTree.tostring(root, encoding="utf-8", xml_declaration=True))
    return out.getvalue()


def _binary(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)


def read_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """review_id, path, text, error of the .docx, .md and .txt files of a folder; undecodable bytes are dropped, a broken file is a row
    with its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                name = path.rsplit("/", 1)[-1]
                try:
                    text = "\n".join(t for _, _, t in docx_paragraphs(content)) if name.lower().endswith(".docx") else content.decode("utf-8", "ignore")
                    rows.append((name.rsplit(".", 1)[0], path, text, None))
                except Exception as e:  # noqa: BLE001
                    rows.append((name.rsplit(".", 1)[0], path, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["review_id", "path", "text", "error"])

    files = _binary(spark, folder, "*").filter(F.lower("path").rlike(r"\.(docx|md|txt)$"))
    return files.select("path", "content").mapInPandas(run, "review_id string, path string, text string, error string")


def read_docx_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    """review_id, para_no, style, level, text."""
    return parse_docx(_binary(spark, folder, "*.docx").select("path", "content"))


def parse_docx(files: DataFrame) -> DataFrame:
    """files(path, content) -> review_id, para_no, style, level, text; a broken file gives no row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    rows += [(path.rsplit("/", 1)[-1].rsplit(".", 1)[0], n, *p) for n, p in enumerate(docx_paragraphs(content))]
                except (KeyError, zipfile.BadZipFile, ElementTree.ParseError):
                    continue
            out = pd.DataFrame(rows, columns=["review_id", "para_no", "style", "level", "text"])
            yield out.astype({"level": "Int32"})

    return files.mapInPandas(run, "review_id string, para_no int, style string, level int, text string")


def research_questions(paragraphs: DataFrame) -> DataFrame:
    """review_id, research_question: the first heading of level 1."""
    first = paragraphs.filter("level = 1").withColumn("t", F.trim(F.regexp_replace("text", r"\s+", " "))).filter("t <> ''")
    return first.groupBy("review_id").agg(F.min_by("t", "para_no").alias("research_question"))


def docx_sections(paragraphs: DataFrame) -> DataFrame:
    """review_id, sec_no, level, title, body: headings 1 to 4 start sections; deeper ones are body; no heading, no section."""
    from pyspark.sql import Window

    p = paragraphs.withColumn("t", F.trim(F.regexp_replace("text", r"\s+", " "))).filter("t <> ''")
    head = F.col("level").between(1, 4)
    w = Window.partitionBy("review_id").orderBy("para_no").rowsBetween(Window.unboundedPreceding, 0)
    p = p.withColumn("sec_no", F.sum(F.when(head, 1).otherwise(0)).over(w)).filter("sec_no > 0")
    body = F.transform(F.filter(F.array_sort(F.collect_list(F.struct("para_no", head.alias("h"), "t"))), lambda x: ~F.coalesce(x["h"], F.lit(False))), lambda x: x["t"])
    return p.groupBy("review_id", "sec_no").agg(F.max(F.when(head, F.col("level"))).alias("level"), F.max(F.when(head, F.col("t"))).alias("title"), F.array_join(body, " ").alias("body"))


def pdf_pages(content: bytes) -> list[str]:
    """The text of each page, by a PDF library if the workers have one."""
    from pypdf import PdfReader

    return [p.extract_text() or "" for p in PdfReader(io.BytesIO(content)).pages]


def read_pdf_texts(spark: SparkSession, folder: str, pages_of: Callable[[bytes], list[str]] = pdf_pages) -> DataFrame:
    """stem, text with page markers, error; a file that the parser cannot read, or all where it is missing, are rows with the error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    pages = [p.strip() for p in pages_of(content)]
                    text, error = "\n".join(f"<<<PAGE={k}>>>\n{t}" for k, t in enumerate(pages, 1)), None
                except Exception as e:  # noqa: BLE001
                    text, error = None, f"{type(e).__name__}: {e}"
                rows.append((path.rsplit("/", 1)[-1].rsplit(".", 1)[0], text, error))
            yield pd.DataFrame(rows, columns=["stem", "text", "error"])

    return _binary(spark, folder, "*.pdf").select("path", "content").mapInPandas(run, "stem string, text string, error string")


def convert_pdfs(spark: SparkSession, folder: str, out: str, pages_of: Callable[[bytes], list[str]] = pdf_pages) -> DataFrame:
    """The texts of a folder's PDF files as a table at out (stem, text), and the rows that failed. Each file is read once."""
    read_pdf_texts(spark, folder, pages_of).write.mode("overwrite").parquet(f"{out}.all")
    done = spark.read.parquet(f"{out}.all")
    done.filter("error IS NULL").select("stem", "text").write.mode("overwrite").parquet(out)
    return done.filter("error IS NOT NULL").select("stem", "error")


def read_source_texts(spark: SparkSession, folder: str) -> DataFrame:
    df = spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt").withColumn("path", F.col("_metadata.file_path"))
    return df.select(F.regexp_replace(F.url_decode(F.element_at(F.split("path", "/"), -1)), r"\.txt$", "").alias("stem"), F.col("value").alias("text"))


def list_files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """path of each file; the contents are not read."""
    return _binary(spark, folder, pattern).select("path")


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Strings as they stand, by name, a byte-order mark off; never inferred. Columns the file lacks are null."""
    raw = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE").csv(path)
    raw = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    fields = [f.strip().split(" ", 1) for f in schema.split(", ")]
    return raw.select(*[(F.expr(f"try_cast(`{n}` AS {t})") if n in raw.columns else F.lit(None).cast(t)).alias(n) for n, t in fields])


def write_csv(df: DataFrame, path: str, last: list[str] | None = None, mode: str = "overwrite") -> None:
    """Nulls as empty text; `last` names columns to be put at the end."""
    cols = [c for c in df.columns if c not in (last or [])] + [c for c in last or [] if c in df.columns]
    df.select(*cols).write.mode(mode).options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Types taken from the values, in a first pass over them."""
    return spark.read.options(header=True, multiLine=True, quote='"', escape='"', inferSchema=True).csv(path)


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def read_jsonl_keyed(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """One row for each key, the last in the order of files and lines; lines without the key are left out."""
    raw = spark.read.text(path).select("value", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at")).alias("at"))
    rows = raw.select("at", F.from_json("value", schema).alias("r")).select("at", "r.*").filter(F.coalesce(F.col(key), F.lit("")) != "")
    return last_of(rows, [key], ["at"]).drop("at")


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_best(spark: SparkSession, parquet: str | None, csv: str | list[str], schema: str) -> DataFrame:
    """Parquet if it is there, else the first CSV that is, else an error that names them."""
    csvs = [csv] if isinstance(csv, str) else csv
    probes = [lambda: spark.read.parquet(parquet)] if parquet else []
    for probe in (*probes, *[lambda c=c: read_csv(spark, c, schema) for c in csvs]):
        try:
            return probe()
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
    raise FileNotFoundError(f"none of {', '.join(filter(None, [parquet, *csvs]))}")


def rewrite_with_backup(df: DataFrame, path: str, stamp: str) -> str:
    """Replace the table at path, which df may read, and keep the old one beside it; gives the backup's path. The new table is written
    in full before anything is moved."""
    spark = df.sparkSession
    fresh, old = f"{path}.new-{stamp}", f"{path}.bak-{stamp}"
    df.write.mode("errorifexists").parquet(fresh)
    jvm = spark._jvm.org.apache.hadoop.fs
    move = lambda a, b: jvm.FileSystem.get(jvm.Path(a).toUri(), spark._jsc.hadoopConfiguration()).rename(jvm.Path(a), jvm.Path(b))
    if not (move(path, old) and move(fresh, path)):
        raise OSError(f"could not replace {path}; the new table is at {fresh}")
    return old


def write_all(df: DataFrame, root: str, stamp: str) -> None:
    """Parquet as the canonical copy, CSV beside it, and a history by run."""
    df.write.mode("overwrite").parquet(f"{root}/parquet")
    saved = df.sparkSession.read.parquet(f"{root}/parquet")  # computed once; the copies read what was written
    write_csv(saved, f"{root}/csv")
    saved.write.mode("overwrite").parquet(f"{root}/history/run_ts={stamp}")
