"""Operator 2, SimHash near-dedup with a byte-position inverted index and count filtering.

A fingerprint has 8 bytes, so two fingerprints that differ in at most 4 bits share at least 4 bytes at equal positions: that
is the guaranteed minimum of the count filter. Posting lists of single bytes hold 1/256 of all documents each, and the tally
over them is quadratic; so the index joins bytes: its keys are (three positions, their three bytes) for the 20 triples of a
covering system in which every set of 4 positions holds a triple. A pair that reaches the minimum therefore meets in a list.
In each list the shared positional bytes of a pair are tallied, pairs below 4 are dropped, and the rest is verified by
the bits that differ. Lists are over distinct fingerprints, so copies meet once; a list gives star links, never its pairs,
and a list above TILE entries is cut into tiles whose pairs of tiles are separate tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.llm.common import arrow_map, column, keep_rows, materialize, text_or_empty

SHINGLE, SEED, MAX_BITS, TILE = 4, 42, 4, 8192
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a whole text: words and shingles as in op2's contract, 0 for a text without words."""
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if n >= shingle:
        starts, ends = starts[: n - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, len(starts), _BLOCK):
        block = zip(starts[i : i + _BLOCK].tolist(), ends[i : i + _BLOCK].tolist(), strict=True)
        h = np.array([digest(joined[a:b], seed) for a, b in block], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(bits.view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = np.array([fingerprint(t.as_py()) for t in column(batch, "text")], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), column(batch, "text_hash"), pa.array(fps)], names=["doc_id", "text_hash", "fp"])


def covering_triples() -> list[tuple[int, int, int]]:
    """20 triples of 0..7 such that any 4 positions hold one: split the positions in three parts; take the triples inside a
    part, and those with two positions in a part and one in the next."""
    part = {p: p % 3 for p in range(8)}
    taken = []
    for t in combinations(range(8), 3):
        parts = sorted(part[p] for p in t)
        same = len(set(parts)) == 1
        two = len(set(parts)) == 2 and (next(x for x in set(parts) if parts.count(x) == 2) + 1) % 3 == next(x for x in set(parts) if parts.count(x) == 1)
        if same or two:
            taken.append(t)
    return taken


def _posting_keys(fp: Column) -> Column:
    byte = [F.shiftrightunsigned(fp, 8 * p).bitwiseAND(F.lit(255)) for p in range(8)]
    keys = []
    for i, (a, b, c) in enumerate(covering_triples()):
        keys.append(F.lit(i << 24).cast("long").bitwiseOR(F.shiftleft(byte[a], 16)).bitwiseOR(F.shiftleft(byte[b], 8)).bitwiseOR(byte[c]))
    return F.array(*keys)


def _close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Count filter, then verification, of pairs of fingerprints."""
    x = a ^ b
    shared = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    ok = shared >= 8 - MAX_BITS
    ok[ok] = np.bitwise_count(x[ok]) <= MAX_BITS
    return ok


def _stars(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links from the first member of each component of one list to the others: a search that compares each member it
    reaches with the members not reached yet."""
    left, out = np.unique(fps), []
    while len(left) > 1:
        root, left = left[0], left[1:]
        frontier, members = [root], []
        while frontier and len(left):
            near = _close(np.full(len(left), frontier.pop(), np.uint64), left)
            if near.any():
                new = left[near]
                members.append(new)
                frontier += list(new)
                left = left[~near]
        if members:
            m = np.concatenate(members)
            out.append((np.full(len(m), root, np.uint64), m))
    return out


_SMALL = 32


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Star links of each posting list; the rows come sorted by list, and the last list of a batch waits for the next."""
    names = ("key", "t1", "t2")
    rest: list[np.ndarray] | None = None

    def solve(cols: list[np.ndarray]) -> pa.RecordBatch:
        fps = cols[3].view(np.uint64)
        n = len(fps)
        new = np.ones(n, bool)
        if n > 1:
            new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, n))
        group = np.repeat(np.arange(len(starts)), sizes)
        small = np.repeat(sizes <= _SMALL, sizes)
        found = []
        for lag in range(1, min(_SMALL, int(sizes.max(initial=1)))):
            i = np.flatnonzero((group[lag:] == group[:-lag]) & small[lag:])
            if len(i):
                i = i[_close(fps[i], fps[i + lag])]
                found.append((fps[i], fps[i + lag]))
        for s, size in zip(starts[sizes > _SMALL], sizes[sizes > _SMALL], strict=True):
            found += _stars(fps[s : s + size])
        a = np.concatenate([x for x, _ in found] or [np.zeros(0, np.uint64)]).view(np.int64)
        b = np.concatenate([x for _, x in found] or [np.zeros(0, np.uint64)]).view(np.int64)
        differ = a != b
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[differ]), pa.array(np.maximum(a, b)[differ])], names=["a", "b"])

    for batch in batches:
        cols = [column(batch, c).to_numpy() for c in (*names, "fp")]
        if rest is not None:
            cols = [np.concatenate(p) for p in zip(rest, cols, strict=True)]
        if not len(cols[0]):
            continue
        last = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1])
        cut = int(np.argmax(last))
        rest = [c[cut:] for c in cols]
        if cut:
            yield solve([c[:cut] for c in cols])
    if rest is not None:
        yield solve(rest)


def fingerprint_links(fps: DataFrame, tile: int = TILE) -> DataFrame:
    """(a, b), a < b: links that span the near pairs among the distinct values of fps.fp."""
    keys = fps.select("fp").distinct().select(F.explode(_posting_keys(F.col("fp"))).alias("key"), "fp")
    heavy = keys.groupBy("key").count().filter(F.col("count") > tile).select(F.col("key").alias("hk"), F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
    tiled = keys.join(heavy, F.col("key") == F.col("hk"), "left").withColumn("t", F.when(F.col("tiles").isNotNull(), F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")))
    mates = F.when(F.col("t").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("tiles") - 1))
    spread = tiled.select("key", "t", F.explode(mates).alias("m"), "fp")
    t = F.coalesce(F.col("t"), F.lit(0))
    lists = spread.select("key", F.least(t, F.col("m")).alias("t1"), F.greatest(t, F.col("m")).alias("t2"), "fp")
    dealt = lists.repartition("key", "t1", "t2").sortWithinPartitions("key", "t1", "t2")
    return arrow_map(dealt, _links, "a long, b long").distinct()


def connected(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label): the smallest node of each component, by alternating large-star and small-star steps until all links are stars.

    Each round is written to the shared folder. Only nodes with a link have a row. Where links are left that are no stars when
    the rounds run out, an error is raised: labels of unfinished components would be wrong.
    """
    nodes = materialize(links.filter("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), "links")
    for _ in range(max_rounds):
        both = nodes.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(nodes.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        # The least neighbours are written: so the joins read plain exchanges, whose hot nodes adaptive execution can split.
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).select(F.col("u").alias("mu"), "m"), "least")
        large = materialize(both.join(least, F.col("u") == F.col("mu")).filter("v > u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).filter("lo <> hi").distinct(), "large")
        small_least = large.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("mu"), "m")
        small = large.join(small_least, F.col("hi") == F.col("mu"))
        small = small.select(F.col("m").alias("lo"), F.col("lo").alias("hi")).union(small.select(F.col("m").alias("lo"), F.col("hi"))).filter("lo <> hi").distinct()
        nodes = materialize(small, "stars")
        # Stars: no node hangs on two others, and none that hangs on another has nodes of its own.
        roles = nodes.select(F.col("hi").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(nodes.select(F.col("lo").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
        if roles.groupBy("node").agg(F.sum("hangs").alias("up"), F.max("holds").alias("down")).filter("up > 1 or (up > 0 and down > 0)").isEmpty():
            break
    else:
        raise RuntimeError(f"components have not settled after {max_rounds} rounds")
    return nodes.select(F.col("hi").alias("node"), F.col("lo").alias("label")).union(nodes.select(F.col("lo").alias("node"), F.col("lo").alias("label")).distinct())


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id, component (the fingerprint, of those linked, that
    names the component), text_hash.

    Null and empty texts have fingerprint zero and link like any other. component_id is the smallest id reachable over links
    of at most MAX_BITS differing bits; null ids are ignored for it, and a component of none but null ids has null. Repeated rows
    stay. An empty table gives no rows; other columns are ignored.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_or_empty(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    prints = materialize(arrow_map(base, _fingerprints, "doc_id long, text_hash long, fp long"), "prints")
    labels = connected(fingerprint_links(prints, tile))
    per_fp = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = per_fp.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    named = materialize(named, "named")
    # Written, so that a label or fingerprint of very many rows can be split in the joins.
    per_label = materialize(named.groupBy(F.col("label").alias("l2")).agg(F.min("least").alias("component_id")), "labels")
    per_fp = named.join(per_label, F.col("label") == F.col("l2")).select(F.col("fp").alias("f2"), "component_id", "label")
    digits = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return prints.join(per_fp, F.col("fp") == F.col("f2"), "left").select("doc_id", digits("fp").alias("fingerprint"), "component_id", digits("label").alias("component"), "text_hash")


def keep_one(docs: DataFrame, components: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Exactly one row of each component, all columns as they were: that of the smallest id; where a component has no ids, one of
    its rows, by the hash of its text. Of repeated rows one stays. components: simhash_components of docs."""
    first = components.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first"))
    kept = first.select("first.doc_id", "first.text_hash")
    return keep_rows(docs, [F.col(id_col).cast("long"), F.xxhash64(text_or_empty(text_col))], kept)


def hamming(a: int, b: int) -> int:
    return (a ^ b).bit_count()


def brute_components(prints: dict[int, int]) -> dict[int, int]:
    """component_id by comparing all pairs; for tests."""
    ids = sorted(prints)
    label = {i: i for i in ids}

    def top(i: int) -> int:
        while label[i] != i:
            i = label[i]
        return i

    reduce(lambda _, p: label.__setitem__(max(top(p[0]), top(p[1])), min(top(p[0]), top(p[1]))) if hamming(prints[p[0]], prints[p[1]]) <= MAX_BITS else None, combinations(ids, 2), None)
    return {i: top(i) for i in ids}
