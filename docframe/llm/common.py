"""Shared plumbing of the operators: shared folder, written cuts of the lineage, Arrow maps, gapless numbers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import reduce
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docframe.session import materialize, ship_package

__all__ = ["arrow_map", "column", "documents", "gapless", "held", "keep_rows", "materialize", "packed", "text_or_empty"]

#: Rows and bytes of one Arrow batch: whole texts can be long, so the bytes cut batches of texts, the rows those of numbers.
BATCH_ROWS, BATCH_BYTES = 16384, 8 << 20


T = TypeVar("T")
_HELD: dict[str, object] = {}


def held(name: str, make: Callable[[], T]) -> T:
    """A table that a worker keeps from task to task, until a task of another operator runs in it."""
    if name not in _HELD:
        _HELD[name] = make()
    return _HELD[name]


def _release(keeps: str | None) -> None:
    """Let go of what other operators have left in this worker, and give freed memory back to the system."""
    for name in [n for n in _HELD if n != keeps]:
        del _HELD[name]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType, keeps: str | None = None) -> DataFrame:
    """mapInArrow with bounded batches, the package shipped to the executors. keeps: the name of the table that fn has held.

    The session's limits of a batch are lowered to these bounds, for a plan reads them when it runs; lower ones stay."""
    spark = df.sparkSession
    ship_package(spark)
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(f"spark.sql.execution.arrow.{name}").removesuffix("b").removesuffix("B")
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _release(keeps)
        yield from fn(batches)
        _release(keeps)

    return df.mapInArrow(run, schema)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def gapless(df: DataFrame, key: str, order: str, out: str, buckets: int | None = None) -> DataFrame:
    """Number the rows of each key from 0 without gaps and without one task per key.

    Rows are split into hash buckets of the order column; numbers within (key, bucket) come from a window, and the
    buckets' sizes, a small table, give the offsets. Equal order values (repeated rows) get different numbers.
    """
    spark = df.sparkSession
    n = buckets or max(8, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    salted = df.withColumn("_b", F.pmod(F.xxhash64(F.col(order)), F.lit(n)).cast("int"))
    sizes = salted.groupBy(key, "_b").count()
    w = Window.partitionBy(key).orderBy("_b")
    offsets = sizes.select(key, "_b", (F.sum("count").over(w) - F.col("count")).alias("_o"))
    inner = salted.withColumn("_r", F.row_number().over(Window.partitionBy(key, "_b").orderBy(order)) - 1)
    joined = inner.join(offsets.withColumnRenamed(key, "_k"), (F.col(key).eqNullSafe(F.col("_k"))) & (inner["_b"] == offsets["_b"]), "left")
    return joined.select(*[inner[c] for c in df.columns], (F.col("_r") + F.col("_o")).cast("long").alias(out))


def packed(docs: DataFrame) -> Column:
    """All columns of docs in one struct, so that their names clash with none; select("name.*") unpacks it."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns])


def keep_rows(docs: DataFrame, keys: list[Column], kept: DataFrame) -> DataFrame:
    """The rows of docs whose keys stand in a row of kept (nulls are equal), one row for each, all columns as they were."""
    names = [f"k{i}" for i in range(len(keys))]
    hashed = lambda cols: F.xxhash64(*cols, *[c.isNull() for c in cols])
    mine = docs.select(hashed(keys).alias("h"), *[c.alias(n) for c, n in zip(keys, names, strict=True)], packed(docs).alias("d"))
    stays = kept.toDF(*[f"o{n}" for n in names])
    stays = stays.withColumn("oh", hashed([F.col(c) for c in stays.columns]))
    # The hash alone is the key of the join, the rest its condition, so the window finds its rows where the join put them.
    alike = lambda a, b: F.coalesce(a == b, a.isNull() & b.isNull())
    same = reduce(lambda a, b: a & b, [alike(F.col(n), F.col(f"o{n}")) for n in names], F.col("h") == F.col("oh"))
    one = mine.join(stays, same, "left_semi").withColumn("nth", F.row_number().over(Window.partitionBy("h", *names).orderBy("h")))
    return one.filter("nth = 1").select("d.*")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
