"""Positioned page text: items of a page reader become boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def from_items(items: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Boxes of text items (doc_id, page, nth, text, transform array<double>, width, height): x and y are the transform's shift,
    blanks go, boxes are numbered on their page."""
    kept = items.filter(F.trim("text") != "")
    if max_pages is not None:
        kept = kept.filter(F.col("page") <= max_pages)
    w = Window.partitionBy("doc_id", "page").orderBy("nth")
    return kept.select("doc_id", "page", (F.row_number().over(w) - 1).alias("index"), "text", F.get("transform", F.lit(4)).alias("x"), F.get("transform", F.lit(5)).alias("y"), "width", "height")


def page_info(pages: DataFrame) -> DataFrame:
    """Number and sizes of the pages of each document: pages has doc_id, page, width, height."""
    sizes = F.transform(F.array_sort(F.collect_list(F.struct("page", "width", "height"))), lambda p: F.struct(p["width"].alias("width"), p["height"].alias("height")))
    return pages.groupBy("doc_id").agg(F.count("*").alias("pages"), sizes.alias("sizes"))
