"""Operator 12, a Merkle manifest of a dataset by superblock reduction.

Rows become leaves, numbered within their source in the order of their ids. A superblock is a run of FANOUT**LEVELS nodes of a
source: one applyInPandas call collapses it by LEVELS levels to one node. The nodes of the superblocks are reduced in the same way
until each source has one node, its subroot; the subroots, in the order of the sources, are reduced likewise to the root. A
proof is the lower one, inside the leaf's superblock, followed by the upper ones, which all leaves of a superblock share: so upper
proofs are kept once for each superblock, and lower ones are made again from its leaves when they are asked for.

Numbers come from a range sort by (source, id): a source of any size lies in many partitions, and offsets are sums over the
partitions' counts. A superblock holds 4096 leaves, whatever the size of its source.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docframe.llm.common import materialize
from docframe.session import ship_package

FANOUT, LEVELS = 16, 3
_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def collapse(nodes: list[str], levels: int, whole: bool, fanout: int = FANOUT) -> list[list[str]]:
    """The nodes of each level, the given ones first: `levels` levels higher or, for a whole tree, until one node is left."""
    out = [nodes]
    while (len(out[-1]) > 1) if whole else (len(out) <= levels):
        last = out[-1]
        out.append([digest(*last[i : i + fanout]) for i in range(0, len(last), fanout)])
    return out


def siblings(levels: list[list[str]], at: int, fanout: int = FANOUT) -> list[tuple[str, str]]:
    """Of the node at a place of the lowest level: the digests to its left and to its right in its run, level by level."""
    path = []
    for nodes in levels[:-1]:
        start = at - at % fanout
        path.append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + fanout])))
        at //= fanout
    return path


def fold(node: str, path: list[tuple[str, str]]) -> str:
    """The root that a node and its siblings give."""
    for left, right in path:
        node = digest(left, node, right)
    return node


def leaf(columns: list[Column]) -> Column:
    """Digest of a row: of each column `-` for null, else the bytes of its text, a colon and the text."""
    part = lambda c: F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")))
    return F.sha2(F.concat(*[part(c) for c in columns]), 256)


def ranked(rows: DataFrame, key: str, order: list[str], tag: str) -> DataFrame:
    """rows with `at`, the number of a row within its key from 0, and `n`, the key's rows. No key needs a task of its own: rows are
    sorted by range, numbered within (key, partition), and moved by the counts of the partitions before. Rows that are equal in
    `order` are told apart by where they were read."""
    dealt = rows.withColumn("_nth", F.monotonically_increasing_id()).repartitionByRange(key, *order, "_nth")
    written = materialize(dealt.withColumn("_part", F.spark_partition_id()), tag)
    sizes = written.groupBy(F.col(key).alias("_key"), F.col("_part").alias("_p")).agg(F.count("*").alias("_c"))
    by_key = Window.partitionBy("_key")
    before = F.sum("_c").over(by_key.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_c")
    sizes = sizes.select("_key", "_p", before.alias("_before"), F.sum("_c").over(by_key).alias("n"))
    inner = F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order, "_nth")) - 1
    joined = written.withColumn("_i", inner).join(sizes, (F.col(key) == F.col("_key")) & (F.col("_part") == F.col("_p")))
    return joined.select(*rows.columns, (F.col("_before") + F.col("_i")).cast("long").alias("at"), F.col("n").cast("long").alias("n"))


def _reduce(nodes: DataFrame, tag: str, fanout: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """(paths, tops) of nodes (key, at, n, node): paths has key, at and the path of each node to its key's last node; tops has key, node."""
    span, rounds = fanout**levels, []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:

        def superblock(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("at")
            n = int(rows["n"].iloc[0])
            tree = collapse(rows["node"].tolist(), levels, n <= span, fanout)
            paths = [[{"left": a, "right": b} for a, b in siblings(tree, i, fanout)] for i in range(len(rows))]
            return pd.DataFrame({"key": rows["key"], "at": rows["at"], "block": rows["at"] // span, "n": -(-n // span), "path": paths, "top": tree[-1][0]})

        done = nodes.groupBy("key", F.floor(F.col("at") / span).alias("b")).applyInPandas(superblock, f"key string, at long, block long, n long, path {_PATH}, top string")
        done = materialize(done, f"{tag}-{len(rounds)}")
        rounds.append(done)
        nodes = done.filter(F.col("at") % span == 0).select("key", F.col("block").alias("at"), "n", F.col("top").alias("node"))
        most = -(-most // span)
        if most <= 1:
            break
    paths = rounds[-1].select("key", "at", "path")
    for below in reversed(rounds[:-1]):
        upper = paths.select(F.col("key").alias("uk"), F.col("at").alias("ua"), F.col("path").alias("up"))
        paths = below.join(upper, (F.col("key") == F.col("uk")) & (F.col("block") == F.col("ua"))).select("key", "at", F.concat("path", "up").alias("path"))
    return paths, nodes.select("key", "node")


def manifest(docs: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "source", changed: list[Column] | None = None, changes: Column | None = None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """One row per input row: doc_id, source, at (its number within the source), leaf, subroot, root, proof_sha256, folded_root, verified.

    columns are those that a leaf is made of. Where `changes` holds, folded_root comes from the leaf of the `changed` columns and the
    siblings as they were, elsewhere from the leaf itself; verified says whether it is the root. Leaves ascend by id, null ids
    first, equal ids by leaf; repeated rows are leaves of their own. A null source is the first of the sources and differs from an
    empty one; an empty or null text is a leaf like any other. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    span = fanout**levels
    source = F.col(group_col).cast("string")
    # The key sorts as the sources do, null first: bytes of UTF-8.
    key = F.when(source.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), source))
    other = F.when(F.coalesce(changes, F.lit(False)), leaf(changed)) if changes is not None else F.lit(None).cast("string")
    leaves = docs.select(key.alias("key"), F.col(id_col).cast("long").alias("doc_id"), leaf([F.col(c) for c in columns]).alias("leaf"), other.alias("changed"))
    numbered = ranked(leaves, "key", ["doc_id", "leaf"], "merkle-leaves")

    def superblock(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        n, nodes = int(rows["n"].iloc[0]), rows["leaf"].tolist()
        ids = [None if pd.isna(i) else i for i in rows["doc_id"]]
        top = collapse(nodes, levels, n <= span, fanout)[-1][0]
        changed = [None if pd.isna(c) else c for c in rows["changed"]]
        return pd.DataFrame({"key": [rows["key"].iloc[0]], "block": [int(rows["at"].iloc[0]) // span], "n": [n], "ids": [ids], "leaves": [nodes], "changed": [changed], "top": [top]})

    held = "key string, block long, n long, ids array<string>, leaves array<string>, changed array<string>, top string"
    # Ids pass through pandas as text: it would turn whole numbers with nulls among them into floats.
    blocks = numbered.withColumn("doc_id", F.col("doc_id").cast("string")).groupBy("key", F.floor(F.col("at") / span).alias("b")).applyInPandas(superblock, held)
    blocks = materialize(blocks, "merkle-blocks")
    nodes = blocks.select("key", F.col("block").alias("at"), F.ceil(F.col("n") / span).alias("n"), F.col("top").alias("node"))
    paths, tops = _reduce(nodes, "merkle-source", fanout, levels)
    tops = materialize(tops, "merkle-subroots")
    over = ranked(tops.select(F.lit("").alias("all"), "key", "node"), "all", ["key"], "merkle-sources")
    over = materialize(over, "merkle-order")
    top_paths, root = _reduce(over.select(F.col("all").alias("key"), "at", "n", "node"), "merkle-root", fanout, levels)
    subroots = over.join(root.select(F.col("key").alias("_all"), F.col("node").alias("root")), F.col("all") == F.col("_all"))
    top_paths = subroots.select(F.col("key").alias("sk"), F.col("at").alias("sa"), F.col("node").alias("subroot"), "root").join(top_paths.select("at", F.col("path").alias("top_path")), F.col("sa") == F.col("at")).drop("at")
    upper = paths.select(F.col("key").alias("pk"), F.col("at").alias("pa"), "path").join(top_paths, F.col("pk") == F.col("sk"))
    joined = blocks.join(upper, (F.col("key") == F.col("pk")) & (F.col("block") == F.col("pa")))
    rows = joined.select("key", "block", "n", "ids", "leaves", "changed", F.concat("path", "top_path").alias("path"), "subroot", "root")

    def proofs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                tree = collapse(list(r.leaves), levels, r.n <= span, fanout)
                upper = [(p["left"], p["right"]) for p in r.path]
                tail = "".join(a + b for a, b in upper)
                proof, folded = [], []
                for i, (node, other) in enumerate(zip(r.leaves, r.changed, strict=True)):
                    lower = siblings(tree, i, fanout)
                    proof.append(digest(*(a + b for a, b in lower), tail))
                    folded.append(fold(node if other is None else other, lower + upper))
                at = range(int(r.block) * span, int(r.block) * span + len(proof))
                yield pd.DataFrame({"doc_id": list(r.ids), "key": r.key, "at": at, "leaf": list(r.leaves), "subroot": r.subroot, "root": r.root, "proof_sha256": proof, "folded_root": folded})

    out = rows.mapInPandas(proofs, "doc_id string, key string, at long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    name = F.when(F.col("key") != "0", F.substring("key", 2, 1 << 30))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), name.alias("source"), "at", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


#: What a leaf of documents is made of.
DOCUMENT = ["doc_id", "source", "lang", "n_chars", "text"]


def tampering_check(docs: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """manifest of documents in which the text of every row whose crc32 of the id 5 divides has its A-Z in small letters. Rows without
    an id are not tampered with."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = [lower if c == "text" else F.col(c) for c in DOCUMENT]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest(docs, DOCUMENT, changed=changed, changes=hit, fanout=fanout, levels=levels)
