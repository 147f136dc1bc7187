"""Text extraction from bytes: plain text, HTML and DOCX with the standard library, PDF through a plug-in."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamline.functions.text import strip
from loamline.operators.guard import FilterConfig, apply_filter

#: Folder below the root, and the file name patterns read from it.
LAYOUT = {"pdf": ("*.pdf",), "html": ("*.html", "*.htm"), "text": ("*.txt", "*.text", "*.docx", "*.doc")}
KINDS = {"pdf": "pdf", "html": "html", "htm": "html", "txt": "text", "text": "text", "docx": "docx", "doc": "docx"}
_BLOCKS = frozenset("address article aside blockquote br dd div dl dt figcaption footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split())
_BOILERPLATE = frozenset("nav header footer aside form button noscript template svg".split())


class _Text(HTMLParser):
    """Collects text outside script and style, and (main only) outside page furniture."""

    def __init__(self, main: bool):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skip: list[str] = []
        self.silent = {"script", "style"} | (_BOILERPLATE if main else set())
        self.main = main

    def handle_starttag(self, tag, attrs):
        if tag in self.silent:
            self.skip.append(tag)
        elif self.main and tag in _BLOCKS:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in self.skip:
            while self.skip and self.skip.pop() != tag:
                pass
        elif self.main and tag in _BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def raw_html_text(html: str | None, main: bool = False) -> str | None:
    if html is None:
        return None
    parser = _Text(main)
    parser.feed(html)
    parser.close()
    return "".join(parser.out)


@F.pandas_udf(T.StringType())
def _all_text(html: pd.Series) -> pd.Series:
    return html.map(raw_html_text)


@F.pandas_udf(T.StringType())
def _main_text(html: pd.Series) -> pd.Series:
    return html.map(lambda h: raw_html_text(h, True))


def tidy_lines(c: Column) -> Column:
    """Lines stripped and split at double spaces, empty parts dropped, joined by line ends."""
    lines = F.transform(F.split(c, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"), strip)
    parts = F.transform(F.flatten(F.transform(lines, lambda x: F.split(x, "  "))), strip)
    return F.array_join(F.filter(parts, lambda x: x != ""), "\n")


def html_text(html: Column) -> Column:
    """All text outside script and style, tidied."""
    return tidy_lines(_all_text(html))


def html_main_text(html: Column) -> Column:
    """Text outside navigation, headers, footers, forms and the like, a line a block; null if nothing is left. A heuristic of our own."""
    out = tidy_lines(_main_text(html))
    return F.when(out != "", out)


def docx_text(content: bytes) -> str | None:
    """Paragraphs of a DOCX body joined by empty lines (tables are left out); null if it can't be read."""
    ns = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{ns}body")
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return None
    if body is None:
        return None
    pieces = {f"{ns}t": lambda e: e.text or "", f"{ns}tab": lambda e: "\t", f"{ns}br": lambda e: "\n"}
    return "\n\n".join("".join(pieces[e.tag](e) for e in p.iter() if e.tag in pieces) for p in body.findall(f"{ns}p"))


def decode_text(content: bytes, encoding: str = "utf-8") -> str:
    """Bytes as text; bytes that are not of the encoding are left out."""
    return content.decode(encoding, "ignore")


#: Extractors by kind, bytes → text or None. Register one for pdf where a library for it is installed on the executors.
EXTRACTORS: dict[str, Callable[[bytes], str | None]] = {"text": decode_text, "docx": docx_text, "html": lambda b: raw_html_text(decode_text(b))}


def register(kind: str, extractor: Callable[[bytes], str | None]) -> None:
    EXTRACTORS[kind] = extractor


def file_kind(path: Column) -> Column:
    suffix = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    out = F.lit("unknown")
    for end, kind in KINDS.items():
        out = F.when(suffix == end, kind).otherwise(out)
    return out


def scan_files(spark: SparkSession, root: str) -> DataFrame:
    """path, modificationTime, length, content of the layout's files (not deeper) below root; patterns mind upper and lower case."""
    out = None
    for folder, patterns in LAYOUT.items():
        for pattern in patterns:
            part = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "false")
            try:
                found = part.load(f"{root.rstrip('/')}/{folder}")
            except Exception as e:  # a folder that is not there holds no files
                if "PATH_NOT_FOUND" not in str(e):
                    raise
                continue
            out = found if out is None else out.unionByName(found)
    if out is None:
        raise FileNotFoundError(f"none of {', '.join(LAYOUT)} is below {root}")
    return out


def scan_file(spark: SparkSession, path: str) -> DataFrame:
    """The row of a single file."""
    return spark.read.format("binaryFile").load(path)


def extract_files(files: DataFrame, extracted: Column | None = None, guard: FilterConfig | None = None) -> DataFrame:
    """source_path, filename, file_type, text, success, text_length and extraction_timestamp of each file.

    Kinds without an extractor and files that can't be read have a null text and success false. The key is the whole
    path, so equal names in different folders stay apart. With a guard active at the extraction stage, texts are filtered: a
    rejected file has a null text and success false, and filter_action, patterns_detected and filter_confidence are added.
    """
    extractors = dict(EXTRACTORS)

    @F.pandas_udf("string")
    def run(kind: pd.Series, content: pd.Series) -> pd.Series:
        def one(k, b):
            try:
                return extractors[k](b) if k in extractors and b is not None else None
            except Exception:  # a broken file is a row with success false
                return None

        return pd.Series([one(k, b) for k, b in zip(kind, content)], dtype=object)

    out = files.select(F.col("path").alias("source_path"), F.element_at(F.split("path", "/"), -1).alias("filename"), file_kind(F.col("path")).alias("file_type"), "content")
    out = out.withColumn("text", run("file_type", "content")).drop("content")
    out = out.withColumn("text", F.when(F.col("file_type") == "html", tidy_lines(F.col("text"))).otherwise(F.col("text")))
    found: list[str] = []
    if guard is not None and guard.active("extraction"):
        out, found = apply_filter(out, guard, "extraction"), ["filter_action", "patterns_detected", "filter_confidence"]
    return out.select(
        "source_path", "filename", "file_type", "text", F.col("text").isNotNull().alias("success"), F.coalesce(F.length("text"), F.lit(0)).alias("text_length"),
        (extracted if extracted is not None else F.lit(None).cast("timestamp")).alias("extraction_timestamp"), *found,
    )
