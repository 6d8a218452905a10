"""Operator 9, harmonic packing of token sequences.

A document's ids, closed by one end id, are cut into pieces. Piece lengths are partitioned into reciprocal-capacity classes:
class k holds lengths above capacity / (k + 1) and up to capacity / k, and a bin of class k takes exactly k pieces. Bins
are filled by counting alone: a piece's number in its class, divided by k, is its bin, so workers fill bins independently
and only the counts per task and class meet. Whole capacities are cut off first; a rest that would leave its bin less than
full by more than SLACK gives up one piece of exactly capacity / (k + 1), which fits its class without loss, and the rest of
that is classed anew. One bin of each class can stay short of pieces; those pieces, fewer than the classes can hold and so
bounded by the capacity alone, share sequences by best fit.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docframe.llm.bpe import codec, ship
from docframe.llm.common import arrow_map, column, materialize

CAPACITY, END_ID, SLACK = 4096, 2, 0.04


def cut(length: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[int]:
    """Lengths of a document's pieces, in order; their sum is the document's length."""
    pieces = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        if k * rest >= (1 - slack) * capacity:
            pieces.append(rest)
            break
        pieces.append(min(rest, capacity // (k + 1)))
        rest -= pieces[-1]
    return pieces


def _pieces(path: str, file: str, capacity: int, slack: float, end_id: int, with_ids: bool):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, file)
        part = TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        seen: dict[int, int] = {}
        for batch in batches:
            cols: list[list] = [[] for _ in range(8)]
            source, take = column(batch, "doc_id"), []
            for i, raw in enumerate(c.encode_many(column(batch, "text").to_pylist())):
                raw += end
                total, at = len(raw) // 4, 0
                for piece, n in enumerate(cut(total, capacity, slack)):
                    k = capacity // n
                    body = raw[4 * at : 4 * (at + n)]
                    rank = seen[k] = seen.get(k, -1) + 1
                    for col, v in zip(cols, (at, n, zlib.crc32(body), total, k, rank, part, np.frombuffer(body, "<u4").tolist() if with_ids else None), strict=True):
                        col.append(v)
                    take.append(i)
                    at += n
            types = [pa.int64()] * 4 + [pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int32())]
            arrays = [source.take(pa.array(take, pa.int64()))] + [pa.array(x, t) for x, t in zip(cols, types, strict=True)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "k", "rank", "part", "ids"]
            yield pa.RecordBatch.from_arrays(arrays[: len(arrays) - (not with_ids)], names=names[: len(names) - (not with_ids)])

    return run


_COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, k int, rank long, part int"


def lay_out_rest(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(sequence, offset) of the pieces of unfilled bins: longest first, each into the fullest sequence that has room."""
    room: list[tuple[int, int]] = []
    out = [(0, 0)] * len(lengths)
    made = 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        at = bisect.bisect_left(room, (n, -1))
        if at == len(room):
            left, seq = capacity, made
            made += 1
        else:
            left, seq = room.pop(at)
        out[i] = (seq, capacity - left)
        if left > n:
            bisect.insort(room, (left - n, seq))
    return out


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, slack: float = SLACK, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, with with_ids also ids.

    Null and empty texts are documents of the end id alone. Repeated rows are packed once each; null ids stay null. An empty
    table gives no rows. Sequences are numbered from 0 without gaps, pieces lie in them without gaps.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = _COLUMNS + ", ids array<int>" * with_ids
    pieces = materialize(arrow_map(base, _pieces(path, ship(spark, path), capacity, slack, end_id, with_ids), schema, f"bpe {path}"), "pieces")
    # Sizes of each task's classes, then of the classes: offsets of the numbers, and the class's first sequence.
    sizes = pieces.groupBy("part", "k").agg(F.count("*").alias("n"))
    before = sizes.select("part", "k", (F.sum("n").over(Window.partitionBy("k").orderBy("part")) - F.col("n")).alias("before"))
    # One row per class: at most as many as the capacity, whatever the input.
    classes = sizes.groupBy("k").agg(F.sum("n").alias("n")).withColumn("bins", F.floor(F.col("n") / F.col("k")).cast("long"))
    first = classes.withColumn("first", F.sum("bins").over(Window.orderBy("k")) - F.col("bins"))
    numbered = pieces.join(before, ["part", "k"]).join(F.broadcast(first), "k").withColumn("i", F.col("rank") + F.col("before"))
    extra = ["ids"] if with_ids else []
    shown = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    full = numbered.filter(F.col("i") < F.col("bins") * F.col("k")).select(
        *shown, (F.col("first") + F.floor(F.col("i") / F.col("k"))).cast("long").alias("sequence_id"), (F.col("i") % F.col("k")).alias("slot"), *extra
    )
    w = Window.partitionBy("sequence_id").orderBy("slot")
    packed = full.withColumn("offset", (F.sum("length").over(w) - F.col("length")).cast("long")).select(*shown, "sequence_id", "offset", *extra)
    bins = classes.agg(F.coalesce(F.sum("bins"), F.lit(0))).first()[0]
    # Fewer than k pieces of each class k up to the capacity: a number that the capacity bounds. Only their lengths reach the driver.
    left = numbered.filter(F.col("i") >= F.col("bins") * F.col("k"))
    rest = left.select("k", "i", "length").orderBy("k", "i").collect()
    if not rest:
        return packed
    where = lay_out_rest([r["length"] for r in rest], capacity)
    places = spark.createDataFrame([(r["k"], r["i"], bins + seq, offset) for r, (seq, offset) in zip(rest, where, strict=True)], left.select("k", "i").schema.add("sequence_id", "long").add("offset", "long"))
    placed = left.join(F.broadcast(places), ["k", "i"]).select(*shown, "sequence_id", "offset", *extra)
    return packed.unionByName(placed)
