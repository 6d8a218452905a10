"""Documents as a stream: the row-local operators run unchanged over files that arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docframe.operators.fill import fill
from docframe.sources.docx import unzip


def read_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """New documents below a path, unzipped as they come."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("pathGlobFilter", "*.docx").option("maxFilesPerTrigger", max_files).load(path)
    return unzip(files)


def fill_stream(rows: DataFrame, template: str, tags: str, **options: object) -> DataFrame:
    """A stream of templates and tag maps, filled. Filling keeps no state."""
    return fill(rows, template, tags, **options)
