"""Operator 8, resharding by minimum-cost flow.

The old shards are cut into blocks of documents by a hash of id and text. From the old shards' sizes and the new shards'
capacities a transport problem is solved: a byte that stays costs nothing, a byte that moves costs one, so the flow of least
cost moves the fewest bytes. The flow is then carried out in whole blocks, largest first, and only the shards that lose or
gain blocks are rewritten. The law is `bytes`: the new shards' sizes are near equal, to within about a block.

The driver sees block sizes alone: old shards times BLOCKS rows, whatever the input.
"""

from __future__ import annotations

import bisect
import uuid
import zlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docframe.llm.common import packed, text_or_empty
from docframe.session import shared_dir

SHARDS, BLOCKS = 8, 512


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Flow from each source to each sink of least total cost; sum(supply) must not exceed sum(capacity).

    Successive shortest paths over the residual graph, found by relaxing its arcs until nothing changes.
    """
    n, m = len(supply), len(capacity)
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    while any(left):
        inf = 1 << 62
        to_src = [0 if left[i] else inf for i in range(n)]
        to_sink, via_src, via_sink = [inf] * m, [-1] * n, [-1] * m
        changed = True
        while changed:
            changed = False
            for i in range(n):
                for j in range(m):
                    if to_src[i] < inf and to_src[i] + cost[i][j] < to_sink[j]:
                        to_sink[j], via_sink[j], changed = to_src[i] + cost[i][j], i, True
                    if flow[i][j] and to_sink[j] < inf and to_sink[j] - cost[i][j] < to_src[i]:
                        to_src[i], via_src[i], changed = to_sink[j] - cost[i][j], j, True
        best = min((j for j in range(m) if room[j]), key=lambda j: to_sink[j])
        path, j = [], best
        while True:
            i = via_sink[j]
            path.append((i, j, 1))
            if via_src[i] < 0:
                break
            j = via_src[i]
            path.append((i, j, -1))
        amount = min([left[i], room[best], *(flow[a][b] for a, b, sign in path if sign < 0)])
        for a, b, sign in path:
            flow[a][b] += sign * amount
        left[i] -= amount
        room[best] -= amount
    return flow


def plan(sizes: dict[tuple[int, int], int], shards: int) -> dict[tuple[int, int], int]:
    """New shard of each (old shard, block): the least-cost flow between shards, carried out in whole blocks."""
    total = sum(sizes.values())
    capacity = [total // shards + (j < total % shards) for j in range(shards)]
    olds = sorted({s for s, _ in sizes})
    supply = [sum(v for (s, _), v in sizes.items() if s == old) for old in olds]
    flow = min_cost_flow(supply, capacity, [[int(old != j) for j in range(shards)] for old in olds])
    placed: dict[tuple[int, int], int] = {}
    load = [0] * shards
    rest: list[tuple[int, int]] = []
    for i, old in enumerate(olds):
        blocks = sorted((v, b) for (s, b), v in sizes.items() if s == old)
        # The largest flow takes its blocks first; each takes the largest block that still fits it.
        for j in sorted(range(shards), key=lambda j: (-flow[i][j], j)):
            need = flow[i][j]
            while need:
                at = bisect.bisect_right(blocks, (need, 1 << 62)) - 1
                if at < 0:
                    break
                v, b = blocks.pop(at)
                placed[old, b] = j
                load[j] += v
                need -= v
        rest += [(v, old, b) for v, b in blocks]
    for v, old, b in sorted(rest, key=lambda x: (-x[0], x[1:])):
        j = min(range(shards), key=lambda j: (load[j] - capacity[j], j != old, j))
        placed[old, b] = j
        load[j] += v
    return placed


def crc32_of(text: Column) -> Column:
    return F.crc32(text.cast("binary"))


def _placed(docs: DataFrame, old_shard: Column, shards: int, blocks: int, id_col: str, text_col: str) -> DataFrame:
    """Rows with their new shard: d (all columns of docs), _key, _size, _old, _shard. Blocks are cut by a hash of id and text, so rows
    without an id spread like any others; a block of many equal rows is one that cannot be cut."""
    text, doc = text_or_empty(text_col), F.col(id_col).cast("long")
    base = docs.select(
        packed(docs).alias("d"), F.xxhash64(doc, doc.isNull(), text).alias("_key"), (F.octet_length(text) + 1).cast("long").alias("_size"), F.coalesce(old_shard.cast("int"), F.lit(0)).alias("_old")
    ).withColumn("_block", F.pmod("_key", F.lit(blocks)).cast("int"))
    sizes = {(r["_old"], r["_block"]): r["s"] for r in base.groupBy("_old", "_block").agg(F.sum("_size").alias("s")).collect()}
    moves = sorted((*key, to) for key, to in plan(sizes, shards).items())
    # old shards x blocks rows: bounded by the parameters.
    table = docs.sparkSession.createDataFrame(moves, "_old int, _block int, _shard int")
    return base.join(F.broadcast(table), ["_old", "_block"])


def _deleted(spark: SparkSession, path: str) -> None:
    """Delete a folder of the store that path names, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def rewrite(docs: DataFrame, old_shard: Column, path: str, shards: int = SHARDS, blocks: int = BLOCKS, id_col: str = "doc_id", text_col: str = "text") -> list[int]:
    """Bring the shard files below path, one folder a shard (_shard=0, ...), to the new plan, and give the numbers of those rewritten.

    Only shards that rows enter or leave are written; the files of the others hold as they are, and the folder of a shard that is
    left without rows goes. Files have all columns of docs as they were, and _slot, the row's number in its shard. Every row of
    docs lies in one shard, whether its id is null or stands in other rows too. An empty table writes nothing. A column of docs
    named _shard or _slot is an error, for the files have their own.
    """
    if {"_shard", "_slot"} & set(docs.columns):
        raise ValueError("columns named _shard or _slot would be overwritten")
    numbered, affected, filled = _numbered(docs, old_shard, shards, blocks, id_col, text_col)
    if affected:
        _write(numbered.filter(F.col("_shard").isin(affected)).select("d.*", "_slot", "_shard"), path)
    for shard in affected:
        if shard not in filled:
            _deleted(docs.sparkSession, f"{path.rstrip('/')}/_shard={shard}")
    return affected


def _numbered(docs: DataFrame, old_shard: Column, shards: int, blocks: int, id_col: str, text_col: str) -> tuple[DataFrame, list[int], set[int]]:
    """(rows with their slots, the shards that rows enter or leave, the shards that have rows)."""
    placed = _placed(docs, old_shard, shards, blocks, id_col, text_col)
    # At most a row for each pair of shards.
    flows = [(r["_old"], r["_shard"]) for r in placed.select("_old", "_shard").distinct().collect()]
    affected = sorted({s for old, new in flows if old != new for s in (old, new)})
    # Rows move once: they are numbered within (shard, bucket) where one exchange puts them, and the buckets' offsets, shards x buckets
    # rows whatever the input, are sent to every task.
    n = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    dealt = placed.select("d", "_old", "_shard", "_key", F.pmod(F.xxhash64("_key"), F.lit(n)).cast("int").alias("_bucket"))
    sizes = dealt.groupBy(F.col("_shard").alias("_s"), F.col("_bucket").alias("_b")).agg(F.count("*").alias("_c"))
    before = sizes.select("_s", "_b", (F.sum("_c").over(Window.partitionBy("_s").orderBy("_b")) - F.col("_c")).alias("_before"))
    inner = dealt.withColumn("_i", F.row_number().over(Window.partitionBy("_shard", "_bucket").orderBy("_key")) - 1)
    numbered = inner.join(F.broadcast(before), (F.col("_shard") == F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    return numbered.select("d", "_old", "_shard", (F.col("_i") + F.col("_before")).cast("long").alias("_slot")), affected, {new for _, new in flows}


def _write(rows: DataFrame, path: str) -> None:
    """Write rows below path, a folder a shard, in place of what the folders of their shards hold."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_shard").parquet(path)


def reshard(docs: DataFrame, old_shard: Column, shards: int = SHARDS, blocks: int = BLOCKS, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard, old_shard, moved.

    old_shard: an int column over docs that says where a row lies now (null counts as shard 0). The shards that rows enter or leave
    are written below path, by default a new folder of the shared one, and their rows come from those files. Size is the UTF-8
    bytes of the text plus 1. Null texts count as empty; rows without an id, and repeated rows, are rows like any others. Slots
    number a shard's rows from 0 in the order of hashes of id and text. An empty table gives no rows; other columns, of whatever names, are written too.
    """
    spark = docs.sparkSession
    numbered, affected, _ = _numbered(docs, old_shard, shards, blocks, id_col, text_col)
    mine = F.col("_shard").isin(affected) if affected else F.lit(False)
    figures = lambda rows: rows.select(
        F.col("d").getField(id_col).cast("long").alias("doc_id"), F.col("d").getField(text_col).alias("text"), F.col("_shard").alias("shard"), F.col("_slot").alias("slot"), F.col("_old").alias("old_shard")
    )
    rows = figures(numbered.filter(~mine))
    if affected:
        path = path or f"{shared_dir(spark)}/docframe/shards-{uuid.uuid4().hex}"
        moved = numbered.filter(mine).select("d", "_old", "_slot", "_shard")
        _write(moved, path)
        rows = rows.unionByName(figures(spark.read.schema(moved.schema).parquet(path)))
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), crc32_of(text).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard", (F.col("shard") != F.col("old_shard")).alias("moved"),
    )


def crc(text: str | None) -> int:
    return zlib.crc32((text or "").encode())
