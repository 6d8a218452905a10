"""Writing documents: the body replaced in the original package."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.session import ship_package
from docframe.sources.docx import BODY


def replace_body(content: bytes, xml: str) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(content)) as old, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as new:
        for item in old.infolist():
            new.writestr(item.filename, xml.encode() if item.filename == BODY else old.read(item.filename))
    return out.getvalue()


def rezip(documents: DataFrame) -> DataFrame:
    """path, content, error of rows (path, content, xml); rows without XML keep their content. A file that cannot be read has no
    content, and its error says why."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for path, content, xml in zip(f["path"], f["content"], f["xml"], strict=True):
                try:
                    rows.append((path, replace_body(content, xml) if isinstance(xml, str) else content, None))
                except (zipfile.BadZipFile, ValueError, OSError, TypeError, zlib.error, RuntimeError) as e:
                    rows.append((path, None, str(e) or type(e).__name__))
            yield pd.DataFrame(rows, columns=["path", "content", "error"])

    ship_package(documents.sparkSession)
    return documents.select("path", "content", "xml").mapInPandas(run, "path string, content binary, error string")


def output_name(path: Column, suffix: str = "_FILLED") -> Column:
    name = F.regexp_extract(path, r"([^/]+?)(?:\.docx?)?$", 1)
    return F.concat(name, F.lit(f"{suffix}.docx"))


def join_paragraphs(xml: Column, old: Column, new: Column) -> Column:
    """A document's XML with its paragraphs replaced: old and new are arrays in document order. The gaps between paragraphs stay,
    so no offset has to be kept up to date."""
    state = F.struct(F.lit("").alias("done"), xml.alias("rest"), F.lit(0).alias("i"))

    def step(acc: Column, piece: Column) -> Column:
        at = F.position(piece, acc["rest"])
        head = F.substring(acc["rest"], F.lit(1), at - 1)
        tail = F.substring(acc["rest"], at + F.length(piece), F.length(acc["rest"]))
        return F.struct(F.concat(acc["done"], head, F.get(new, acc["i"])).alias("done"), tail.alias("rest"), (acc["i"] + 1).alias("i"))

    return F.aggregate(old, state, step, lambda acc: F.concat(acc["done"], acc["rest"]))
