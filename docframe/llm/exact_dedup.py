"""Operator 1, exact dedup by content sort.

Sampled splitters range-partition the normalised bytes, an external sort places equal texts side by side, and full
comparisons of neighbours find the groups. The range key is a bounded prefix of the bytes, then a hash of the whole text,
then the id: splitters stay small however long the texts are, and a group of copies that holds a third of all rows is
dealt out over many partitions. Groups that cross a partition's edge are put together from at most two runs a partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.llm.common import arrow_map, column, keep_rows, materialize, text_or_empty

PREFIX_CHARS = 48
_SCHEMA = "doc_id long, keep_id long, group_size long, first boolean, text_sha256 string, part int, edge boolean, edge_text string"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours in one sorted partition. Only the ids of the open run are kept from batch to batch."""
    part = TaskContext.get().partitionId()
    open_text: str | None = None
    open_sha = ""
    open_ids: list[pa.Array] = []
    first_run = True

    def rows(ids: pa.Array, starts: np.ndarray, sha: pa.Array, edge_text: str | None) -> pa.RecordBatch:
        n = len(ids)
        sizes = np.diff(np.append(starts, n))
        head = np.zeros(n, bool)
        head[starts] = True
        keep = ids.take(pa.array(np.repeat(starts, sizes)))
        texts = pa.nulls(n, pa.string()) if edge_text is None else pa.array([edge_text] + [None] * (n - 1), pa.string())
        return pa.RecordBatch.from_arrays(
            [ids, keep, pa.array(np.repeat(sizes, sizes)), pa.array(head), sha, pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, edge_text is not None)), texts],
            names=["doc_id", "keep_id", "group_size", "first", "text_sha256", "part", "edge", "edge_text"],
        )

    def close(edge: bool) -> pa.RecordBatch:
        ids = pa.concat_arrays(open_ids)
        return rows(ids, np.array([0]), pa.array([open_sha] * len(ids), pa.string()), open_text if edge else None)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ids, text, sha = column(batch, "doc_id"), column(batch, "text"), column(batch, "sha")
        new = np.ones(n, bool)
        if n > 1:
            new[1:] = ~np.asarray(pc.equal(text[1:], text[:-1]))
        new[0] = open_text is None or text[0].as_py() != open_text
        starts = np.flatnonzero(new)
        cut = int(starts[0]) if len(starts) else n
        if cut:
            open_ids.append(ids[:cut])
        if not len(starts):
            continue
        if open_ids:
            yield close(first_run)
            first_run = False
        last = int(starts[-1])
        inner = starts[:-1] - cut
        if len(inner):
            a, b = cut, last
            if first_run:
                end = int(starts[1])
                yield rows(ids[a:end], np.array([0]), sha[a:end], text[a].as_py())
                first_run = False
                a, inner = end, starts[1:-1] - end
            if len(inner):
                yield rows(ids[a:b], inner, sha[a:b], None)
        open_ids, open_text, open_sha = [ids[last:]], text[last].as_py(), sha[last].as_py()
    if open_ids:
        yield close(True)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", normalise: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    keep: "smallest" or "largest" id stays. normalise: a string column over docs, by default the text as it is; null counts
    as empty. Exactly one row of a group stays: of repeated rows with one id the first in order, and rows with a null id stay
    only if the whole group has none. An empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(normalise, F.lit("")) if normalise is not None else text_or_empty(text_col)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    by_id = F.col("doc_id").desc_nulls_last() if keep == "largest" else F.col("doc_id").asc_nulls_last()
    keyed = base.withColumns({"p": F.substring("text", 1, PREFIX_CHARS), "h": F.xxhash64("text")})
    dealt = keyed.repartitionByRange(F.col("p"), F.col("h"), by_id).sortWithinPartitions(F.col("p"), F.col("h"), F.col("text"), by_id)
    runs = materialize(arrow_map(dealt.select("doc_id", "text", F.sha2("text", 256).alias("sha")), _runs, _SCHEMA), "exact")
    # At most two runs a partition meet here, so their number is bounded by the number of partitions.
    edges = (
        runs.filter("edge_text is not null")
        .groupBy("edge_text", F.col("text_sha256").alias("edge_sha"))
        .agg(F.min_by("keep_id", "part").alias("edge_keep"), F.sum("group_size").alias("edge_size"), F.min("part").alias("edge_part"))
        .drop("edge_text")
    )
    joined = runs.join(F.broadcast(edges), F.when(F.col("edge"), F.col("text_sha256")) == F.col("edge_sha"), "left")
    return joined.select(
        "doc_id",
        F.when(F.col("edge"), F.col("edge_keep")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(F.col("edge"), F.col("edge_size")).otherwise(F.col("group_size")).alias("group_size"),
        (F.col("first") & (~F.col("edge") | (F.col("part") == F.col("edge_part")))).alias("kept"),
        "text_sha256",
    )


def keep_first(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Column | None = None) -> DataFrame:
    """The documents that stay, one for each group, all columns as they were. groups: exact_dedup of docs with the same parameters."""
    text = F.coalesce(normalise, F.lit("")) if normalise is not None else text_or_empty(text_col)
    return keep_rows(docs, [F.col(id_col).cast("long"), F.sha2(text, 256)], groups.filter("kept").select("doc_id", "text_sha256"))
