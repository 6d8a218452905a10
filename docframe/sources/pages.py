"""HTML pages and JSON records as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def html_elements(pages: DataFrame, tag: str, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """One row an element of a kind: id, index, text without markup."""
    found = F.regexp_extract_all(html, F.lit(rf"(?s)<{tag}(?: [^>]*)?>(.*?)</{tag}>"), F.lit(1))
    return pages.select(id_col, F.posexplode(found).alias("index", "raw")).select(id_col, "index", F.trim(F.regexp_replace("raw", "<[^>]+>", "")).alias("text"))


def read_json(spark: SparkSession, path: str, field: str | None = None) -> DataFrame:
    """JSON records, or the objects of one of their fields; a record that is no object has an error."""
    rows = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("json"))
    part = F.get_json_object("json", f"$.{field}") if field else F.col("json")
    sound = F.coalesce(F.ltrim(part).startswith("{") & F.try_parse_json(part).isNotNull(), F.lit(False))
    return rows.select("path", F.when(sound, part).alias("json"), F.when(~sound, "not an object").alias("error"))
