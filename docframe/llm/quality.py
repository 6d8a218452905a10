"""Operator 3, quality rules: cross-document line frequency, after rules on the single document.

Lines are normalised (lower case, outer white space off) and hashed; per host (the source column) the distinct documents of
each line are counted, lines above the limit are removed, and a document left with less than a given share of its
characters is rejected. Exact copies are one document here: texts are told apart by the hash of the whole text, so a text with
many copies does not make its own lines look like boilerplate; texts that differ anywhere, near copies too, count each. The
limit of a host is the larger of a fixed count and a share of its documents, so it works alike at every size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docframe.llm.common import arrow_map, column, packed

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
MIN_WORDS, MAX_REPEAT_PCT = 50, 50
MIN_DOCS, DOC_SHARE, MIN_LEFT = 20, 0.001, 0.5


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice, the first occurrence included."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) == n:
        return 0
    base = np.int64(len(number))
    _, pair = np.unique(ids[:-2] * base + ids[1:-1], return_inverse=True)
    _, window, counts = np.unique(pair * base + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[window] > 1
    if not twice.any():
        return 0
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one whole text; zeros for null."""
    text = text or ""
    words = text.encode().split()
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    return len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dup, repeat_words(words)


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = np.array([base_counts(t.as_py()) for t in column(batch, "text")], np.int64).reshape(-1, 5)
        yield pa.RecordBatch.from_arrays([column(batch, "_id"), column(batch, "_row"), *(pa.array(counts[:, i]) for i in range(5))], names=["_id", "_row", *_COUNTS])


def common_lines(lines: DataFrame, hosts: DataFrame, min_docs: int, share: float) -> DataFrame:
    """(host, h, n_docs) of the lines in more distinct documents of a host than its limit; `row` is the hash of a line's whole text.
    lines: host, h, row; hosts: host, host_docs, its distinct texts. No lines or no hosts give no rows; other columns are ignored."""
    found = lines.select("host", "h", "row").distinct().groupBy("host", "h").agg(F.count("*").alias("n_docs")).filter(F.col("n_docs") > min_docs)
    return found.join(hosts, "host").filter(F.col("n_docs") > F.greatest(F.lit(min_docs), share * F.col("host_docs"))).select("host", "h", "n_docs")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_docs: int = MIN_DOCS, share: float = DOC_SHARE, min_left: float = MIN_LEFT) -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    removed_chars, n_removed_lines, removed (hashes of the lines to remove), row_hash (hash of host and text).

    Null texts have no words and fail the base rule; a null host is a host of its own. Rows are told apart by id, which may be
    null, and row_hash: every row has the verdict of its own lines, repeated rows the same one. Ties do not occur; an empty table
    gives no rows.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("row", F.xxhash64("host", "text"))
    counts = arrow_map(base.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "text"), _base, "_id long, _row long, " + ", ".join(f"{c} long" for c in _COUNTS))
    trimmed = F.transform(F.split(F.lower("text"), "\n"), lambda x: F.btrim(x, F.lit(" \t\r\x0b\x0c")))
    parsed = base.select("doc_id", "host", "row", F.posexplode(F.filter(trimmed, lambda x: x != "")).alias("pos", "line"))
    lines = parsed.select("doc_id", "host", "row", "pos", F.xxhash64("line").alias("h"), F.length("line").alias("chars"))
    hosts = base.groupBy("host").agg(F.count_distinct("row").alias("host_docs"))  # the same texts that a line's documents are counted by
    common = common_lines(lines, hosts, min_docs, share).select(F.col("host").alias("ch"), F.col("h").alias("cl"))
    removed = (
        lines.join(common, (F.col("host") == F.col("ch")) & (F.col("h") == F.col("cl")), "left_semi")
        .groupBy(F.col("doc_id").alias("rid"), F.col("row").alias("rrow"))
        .agg(F.collect_set(F.struct("pos", "h", "chars")).alias("gone"))  # the lines of one row, however often it is repeated
        .select(
            "rid", "rrow", F.aggregate("gone", F.lit(0).cast("long"), lambda n, x: n + x["chars"]).alias("removed_chars"),
            F.size("gone").cast("long").alias("n_removed_lines"), F.array_distinct(F.transform("gone", lambda x: x["h"])).alias("removed"),
        )
    )
    joined = counts.join(removed, F.col("_id").eqNullSafe(F.col("rid")) & (F.col("_row") == F.col("rrow")), "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    gone = F.coalesce("removed_chars", F.lit(0))
    # Characters of words stand for the document's mass: outer white space counts for neither side.
    depleted = (F.col("word_chars") > 0) & (gone > 0) & (gone > (1 - min_left) * (F.col("word_chars") + F.col("n_words")))
    return joined.select(
        F.col("_id").alias("doc_id"), *_COUNTS, failed.alias("base_failed"), (~failed & ~depleted).alias("kept"),
        gone.alias("removed_chars"), F.coalesce("n_removed_lines", F.lit(0)).alias("n_removed_lines"), F.coalesce("removed", F.array().cast("array<long>")).alias("removed"), F.col("_row").alias("row_hash"),
    )


def apply_quality(docs: DataFrame, verdicts: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", chars_col: str = "n_chars") -> DataFrame:
    """The documents that stay, without the lines above the limits; all other columns as they were, but for chars_col, which
    follows the text if docs has it. verdicts: quality of docs. Rows meet their verdict by id, null or not, and the hash of host
    and text, so repeated rows share one; a null text that stays is empty. An empty table gives no rows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    mine = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(host_col).cast("string"), F.lit("")), text).alias("row"), packed(docs).alias("d"))
    v = verdicts.filter("kept").select(F.col("doc_id").alias("vid"), F.col("row_hash").alias("vrow"), F.col("removed").alias("gone")).dropDuplicates(["vid", "vrow"])
    joined = mine.join(v, (F.col("row") == F.col("vrow")) & F.col("id").eqNullSafe(F.col("vid")))
    whole = F.coalesce(F.col("d").getField(text_col), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: ~F.array_contains(F.col("gone"), F.xxhash64(F.btrim(F.lower(x), F.lit(" \t\r\x0b\x0c")))))
    left = F.when(F.size("gone") > 0, F.array_join(lines, "\n")).otherwise(whole)
    clean = joined.select("d", left.alias("left"))
    kinds = dict(docs.dtypes)
    made = {text_col: F.col("left"), chars_col: F.length("left").cast(kinds.get(chars_col, "long"))}
    return clean.select(*[made.get(c, F.col("d").getField(c)).alias(c) for c in docs.columns])
