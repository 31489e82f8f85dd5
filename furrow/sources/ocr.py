"""Optional recovery of text from page images, behind a small engine interface."""

from __future__ import annotations

import importlib.util
import io
import shutil
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lexicon import Lexicon
from ..operators.pages import accept_recovered, is_picture
from ..settings import Settings

# An engine takes (file content, page number, settings) and returns the text.
Engine = Callable[[bytes, int, Settings], str]

PAGES_PER_TASK = 8


def ocr_available() -> tuple[bool, str]:
    """Whether pages can be recovered here; if not, the part that is missing."""
    if importlib.util.find_spec("pytesseract") is None:
        return False, "missing part: Python package pytesseract"
    if shutil.which("tesseract") is None:
        return False, "missing part: program tesseract"
    return True, ""


def tesseract_engine(content: bytes, page: int, settings: Settings) -> str:
    import pymupdf
    import pytesseract
    from PIL import Image

    with pymupdf.open(stream=content, filetype="pdf") as doc:
        picture = doc[page - 1].get_pixmap(dpi=settings.ocr_dpi).tobytes("png")
    return pytesseract.image_to_string(Image.open(io.BytesIO(picture)), lang=settings.ocr_langs)


def recover(pages: DataFrame, files: DataFrame, engine: Engine, settings: Settings) -> DataFrame:
    """Add `recovered` and `error` to pages; only image pages of PDF files are
    attempted. A page that cannot be processed is an error, not a rejection.

    `files` is (document, content). A page takes seconds, so a file's image pages
    are cut into small groups that run apart; the content travels once per group.
    """
    groups = pages.where(
        is_picture("text", "has_image", settings) & F.lower("document").endswith(".pdf")
    ).groupBy("document", F.floor(F.col("page") / PAGES_PER_TASK).alias("_group")).agg(
        F.collect_list("page").alias("_pages"))
    work = groups.join(files.select("document", "content"), "document").repartition("document", "_group")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for document, numbers, content in zip(batch["document"], batch["_pages"], batch["content"]):
                for page in numbers:
                    text = error = None
                    try:
                        text = engine(bytes(content), int(page), settings)
                    except Exception as exc:
                        error = f"{type(exc).__name__}: {exc}"
                    out.append((document, int(page), text, error))
            yield pd.DataFrame(out, columns=["document", "page", "recovered", "error"])

    read = work.mapInPandas(run, "document string, page int, recovered string, error string")
    return pages.join(read, ["document", "page"], "left")


def augment(pages: DataFrame, files: DataFrame, engine: Engine, lexicon: Lexicon, settings: Settings) -> DataFrame:
    """Pages with accepted recovered text below their own, and the readings the
    report needs. Without an engine the caller keeps the pages as they are."""
    return accept_recovered(recover(pages, files, engine, settings), lexicon, settings)
