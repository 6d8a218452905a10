"""Zipped XML text documents: reading, defragmenting, metadata."""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docframe.session import ship_package

BODY, CORE, APP = "word/document.xml", "docProps/core.xml", "docProps/app.xml"
_RUN = re.compile(r"(?s)<w:r(?: [^>]*)?>.*?</w:r>")
_TEXT = re.compile(r"<w:t(?: [^>]*)?>([^<]*)</w:t>")


def defragment(xml: str) -> str:
    """The texts of one run put into its first text element."""

    def one(match: re.Match) -> str:
        run = match[0]
        texts = _TEXT.findall(run)
        if len(texts) < 2:
            return run
        left = iter(['<w:t xml:space="preserve">' + "".join(texts) + "</w:t>"])
        return _TEXT.sub(lambda _: next(left, ""), run)

    return _RUN.sub(one, xml)


def unzip(files: DataFrame, with_defragment: bool = True) -> DataFrame:
    """path, xml, core, app, error of rows (path, content): a file that is no such document has an error and no XML."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        names = set(z.namelist())
                        if BODY not in names:
                            raise ValueError(f"{BODY} is missing")
                        part = lambda n: z.read(n).decode("utf-8", "replace") if n in names else None  # noqa: B023, E731
                        xml = part(BODY)
                        rows.append((path, defragment(xml) if with_defragment else xml, part(CORE), part(APP), None))
                except (zipfile.BadZipFile, ValueError, OSError, TypeError, zlib.error, RuntimeError) as e:
                    rows.append((path, None, None, None, str(e) or type(e).__name__))
            yield pd.DataFrame(rows, columns=["path", "xml", "core", "app", "error"])

    ship_package(files.sparkSession)
    return files.select("path", "content").mapInPandas(run, "path string, xml string, core string, app string, error string")


def read(spark: SparkSession, path: str, with_defragment: bool = True) -> DataFrame:
    """All documents below a path, by any file system that Spark reads."""
    return unzip(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.docx").load(path), with_defragment)


def accepted(paths: DataFrame, column: str = "path") -> DataFrame:
    return paths.filter(F.lower(column).rlike(r"\.docx?$"))


def metadata(documents: DataFrame) -> DataFrame:
    """title, author, created, pages, words, paragraphs of read documents; words and paragraphs fall back to counts of the text
    where the file has none or 0."""
    from docframe.functions.text import count_words
    from docframe.functions.xml import xml_text

    core = lambda tag: F.nullif(F.regexp_extract("core", rf"<{tag}[^>]*>([^<]*)</{tag}>", 1), F.lit(""))
    app = lambda tag: F.nullif(F.regexp_extract("app", rf"<{tag}>(\d+)</{tag}>", 1).try_cast("int"), F.lit(0))
    return documents.select(
        "path", core("dc:title").alias("title"), core("dc:creator").alias("author"), core("dcterms:created").alias("created"), core("dcterms:modified").alias("modified"),
        app("Pages").alias("pages"), F.coalesce(app("Words"), count_words(xml_text(F.col("xml"), " "))).alias("words"),
        F.coalesce(app("Paragraphs"), F.regexp_count("xml", F.lit(r"<w:p\b"))).alias("paragraphs"),
    )
