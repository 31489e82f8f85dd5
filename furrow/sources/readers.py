"""Documents to pages: a cascade of readers, refusal when none can open a file.

Files are listed and split by Spark's binaryFile source; a small function per
file tries the registered readers in order and returns pages or the reasons.
A path that does not exist is an error raised by Spark, not a refusal.
"""

from __future__ import annotations

import html
import io
import os
import posixpath
import re
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from urllib.parse import unquote
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import tidy

PAGE_SCHEMA = (
    "path string, document string, extractor string, status string, reason string, "
    "pages array<struct<page:int,text:string,has_image:boolean>>"
)

# A reader takes (name, content) and returns one (text, has_image) per page, or
# raises with the reason it cannot.
Reader = Callable[[str, bytes], list[tuple[str, bool]]]


class Unreadable(ValueError):
    pass


def read_mupdf(name: str, content: bytes) -> list[tuple[str, bool]]:
    try:
        import pymupdf
    except ImportError:
        raise Unreadable("pymupdf is not installed") from None
    suffix = Path(name).suffix.lstrip(".") or None
    with pymupdf.open(stream=content, filetype=suffix) as doc:
        return [(page.get_text(), bool(page.get_images())) for page in doc]


def read_pdfplumber(name: str, content: bytes) -> list[tuple[str, bool]]:
    try:
        import pdfplumber
    except ImportError:
        raise Unreadable("pdfplumber is not installed") from None
    with pdfplumber.open(io.BytesIO(content)) as doc:
        return [(page.extract_text() or "", bool(page.images)) for page in doc.pages]


def read_plain(name: str, content: bytes) -> list[tuple[str, bool]]:
    """Text files; a form feed begins a page."""
    if Path(name).suffix.lower() not in (".txt", ".text", ".md"):
        raise Unreadable("not a text file")
    return [(part, False) for part in content.decode("utf-8").split("\f")]


_DROPPED = re.compile(r"(?is)<(script|style|head)\b.*?</\1\s*>|<!--.*?-->")
_BREAKS = re.compile(r"(?i)<\s*(?:br|/p|/div|/li|/tr|/td|/h[1-6]|/title)\b[^>]*>")
_TAGS = re.compile(r"<[^>]*>")


def markup_text(body: str) -> str:
    body = _BREAKS.sub("\n", _DROPPED.sub(" ", body))
    return html.unescape(_TAGS.sub("", body))


def spine(book: zipfile.ZipFile) -> list[str]:
    """Names of a book's pages in reading order: the package's spine. Without a readable package, by name with
    numbers as numbers."""
    try:
        container = ElementTree.fromstring(book.read("META-INF/container.xml"))
        package = next(e.get("full-path") for e in container.iter() if e.tag.endswith("rootfile"))
        tree = ElementTree.fromstring(book.read(package))
        items = {e.get("id"): e.get("href") for e in tree.iter() if e.tag.endswith("}item")}
        order = [items[e.get("idref")] for e in tree.iter() if e.tag.endswith("}itemref")]
        return [posixpath.normpath(posixpath.join(posixpath.dirname(package), unquote(h))) for h in order]
    except (KeyError, StopIteration, ElementTree.ParseError):
        pages = [n for n in book.namelist() if n.lower().endswith((".xhtml", ".html", ".htm"))]
        return sorted(pages, key=lambda n: [int(p) if p.isdigit() else p for p in re.split(r"(\d+)", n)])


def read_markup(name: str, content: bytes) -> list[tuple[str, bool]]:
    """HTML, and EPUB and DOCX as archives of it."""
    suffix = Path(name).suffix.lower()
    if suffix in (".html", ".htm", ".xhtml"):
        body = content.decode("utf-8")
        return [(markup_text(body), "<img" in body.lower())]
    if suffix == ".docx":
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            body = z.read("word/document.xml").decode("utf-8")
            image = any(n.startswith("word/media/") for n in z.namelist())
        body = re.sub(r"<w:tab\b[^>]*/?>", " ", body)
        body = re.sub(r"<w:(?:br|cr)\b[^>]*/?>|</w:p>", "\n", body)
        return [(html.unescape(_TAGS.sub("", body)), image)]
    if suffix == ".epub":
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            bodies = [z.read(n).decode("utf-8") for n in spine(z)]
        return [(markup_text(b), "<img" in b.lower()) for b in bodies]
    raise Unreadable("no markup reader for this format")


# Tried in this order. Replace or extend it to add a format.
READERS: tuple[tuple[str, Reader], ...] = (
    ("pymupdf", read_mupdf),
    ("pdfplumber", read_pdfplumber),
    ("plain", read_plain),
    ("markup", read_markup),
)


def open_document(name: str, content: bytes, readers=READERS):
    """(extractor, pages, reason); pages is None when every reader gave up."""
    problems = []
    for label, reader in readers:
        try:
            return label, reader(name, content), None
        except Exception as exc:  # readers raise whatever their library does
            problems.append(f"{label}: {exc}")
    return None, None, "could not be opened (" + "; ".join(problems) + ")"


def document_column(root: str) -> Column:
    """A file's name below `root`, so that files of one name in two folders are two documents; the whole path of a
    file from elsewhere."""
    folder = (plain(root) if _SCHEME.match(root) else os.path.abspath(root)).rstrip("/") + "/"
    path = F.regexp_replace("path", _SCHEME.pattern, "/")
    return F.when(path.startswith(folder), F.substring(path, len(folder) + 1, 1 << 30)).otherwise(path)


_SCHEME = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*:/+")


def plain(path: str) -> str:
    return _SCHEME.sub("/", path)


def root_of(path: str | list[str]) -> str:
    """The folder that documents are named below: a folder itself, else what all files have in common."""
    if isinstance(path, str):
        return path if not Path(path).suffix else os.path.dirname(path)
    parents = [root_of(p) for p in path]
    return os.path.commonpath([plain(p) if _SCHEME.match(p) else os.path.abspath(p) for p in parents])


def read_documents(spark: SparkSession, path: str | list[str], pattern: str | None = None,
                   readers=READERS, root: str | None = None) -> DataFrame:
    """One row per file with its pages; refused files keep their reason. Documents are named below `root`."""
    source = spark.read.format("binaryFile")
    if pattern:
        source = source.option("pathGlobFilter", pattern)
    files = source.load(path).select("path", document_column(root or root_of(path)).alias("document"), "content")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for where, name, content in zip(batch["path"], batch["document"], batch["content"]):
                label, pages, reason = open_document(where.rsplit("/", 1)[-1], content, readers)
                listed = [
                    {"page": i + 1, "text": text, "has_image": image}
                    for i, (text, image) in enumerate(pages or [])
                ]
                rows.append((where, name, label, "refused" if pages is None else "ok", reason, listed))
            yield pd.DataFrame(rows, columns=["path", "document", "extractor", "status", "reason", "pages"])

    return files.mapInPandas(extract, PAGE_SCHEMA)


def pages_of(documents: DataFrame) -> DataFrame:
    """Tidied pages of the files that could be opened."""
    return (
        documents.where(F.col("status") == "ok")
        .select("document", F.explode("pages").alias("p"))
        .select("document", "p.page", tidy("p.text").alias("text"), F.lit(False).alias("ocr"), "p.has_image")
    )


def refusals_of(documents: DataFrame) -> DataFrame:
    return documents.where(F.col("status") == "refused").select("document", "status", "reason")


def text_pages(spark: SparkSession, path: str) -> DataFrame:
    """Plain text files without leaving the JVM; a form feed begins a page."""
    raw = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("document"))
    return raw.select("document", F.posexplode(F.split("value", "\f")).alias("_i", "body")).select(
        "document", (F.col("_i") + 1).alias("page"), tidy("body").alias("text"),
        F.lit(False).alias("ocr"), F.lit(False).alias("has_image"))


def resolve_paths(names: list[str], data_dir: str, default: list[str]) -> list[str]:
    """Each name as given if it exists, else inside the data folder."""
    return [n if Path(n).exists() else str(Path(data_dir) / n) for n in (names or default)]
