"""Operator 11, ranked lexical search over a two-level quantised index.

Level two of the index holds, for each posting of a query term, the term's occurrences, from which its impact

    g = (1000000000 * tf) div (1000 * tf + 12 * m)        m = 75 + (25 * n * N) div L

follows exactly; level one holds the impact as one byte, rounded upwards in steps of STEP. Documents lie in chunks, and a
chunk's postings are grouped by term with the largest byte of each term beside them. A score is the sum of weight * impact, so the
bytes give an upper bound and, one step lower, a lower bound of every score. Search has two passes over the chunks: the first
keeps the TOP largest lower bounds of each item, whose last is the item's threshold; the second scores exactly, in integers,
every document whose upper bound reaches it. Chunks whose largest bytes cannot reach a threshold are passed over.

The items are the stated query set: they are taken in blocks of bounded size, each held against all documents. A task holds one
chunk, and gives TOP rows an item at most; document ids and terms never reach the driver.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docframe.llm.common import arrow_map, column, materialize

TOP = 20
#: Impacts lie below a million; a byte counts steps of this size.
STEP = -(-1_000_000 // 255)
#: Most documents and postings of a chunk, and bytes of item texts that are searched for at once.
CHUNK_DOCS, CHUNK_POSTINGS, BLOCK_BYTES = 4096, 1 << 20, 4 << 20

#: ASCII letters and digits stand for themselves, capitals for small letters, other ASCII for a gap; all other bytes belong to terms.
_FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text with repeats, A-Z in small letters."""
    return (text or b"").translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 75 + (25 * n.astype(np.int64) * n_docs) // max(n_terms, 1)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


_FORWARD = "doc_id long, n long, terms array<int>, tfs array<int>"


def _forward(vocabulary: dict[bytes, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each document's length and its query terms with their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = vocabulary.get
        for batch in batches:
            lengths, starts, ids, tfs = [], [0], [], []
            for text in column(batch, "text"):
                words = terms(text.as_py())
                lengths.append(len(words))
                found = np.array([i for i in map(find, words) if i is not None], np.int32)
                term, tf = np.unique(found, return_counts=True)
                ids.append(term)
                tfs.append(tf)
                starts.append(starts[-1] + len(term))
            lists = [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *x]).astype(np.int32))) for x in (ids, tfs)]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(lengths, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])

    return run


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each query term in one task."""
    counts: Counter[int] = Counter()
    for batch in batches:
        term, n = np.unique(column(batch, "terms").flatten().to_numpy(zero_copy_only=False), return_counts=True)
        counts.update(dict(zip(term.tolist(), n.tolist(), strict=True)))
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], names=["term", "df"])


_INDEX = "docs array<long>, lengths array<long>, terms array<int>, starts array<int>, tops binary, slots array<int>, impacts binary, tfs array<int>"


def _chunked(n_docs: int, n_terms: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The forward rows as chunks, inverted: postings by term, with both levels of the index."""

    def chunk(docs: list, n: np.ndarray, term: np.ndarray, slot: np.ndarray, tf: np.ndarray) -> pa.RecordBatch:
        by = np.lexsort((slot, term))
        term, slot, tf = term[by], slot[by], tf[by]
        q = (-(-impact(tf, length_factor(n, n_docs, n_terms)[slot]) // STEP)).astype(np.uint8)
        names, starts = np.unique(term, return_index=True)
        tops = np.maximum.reduceat(q, starts) if len(starts) else q
        one = lambda a, kind: pa.array([a], pa.list_(kind))
        data = [one(docs, pa.int64()), one(n, pa.int64()), one(names, pa.int32()), one(np.append(starts, len(term)), pa.int32()), pa.array([tops.tobytes()]), one(slot, pa.int32()), pa.array([q.tobytes()]), one(tf, pa.int32())]
        return pa.RecordBatch.from_arrays(data, names=[c.split()[0] for c in _INDEX.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n = column(batch, "doc_id").to_pylist(), column(batch, "n").to_numpy(zero_copy_only=False)
            lists, tfs = column(batch, "terms"), column(batch, "tfs").flatten().to_numpy(zero_copy_only=False)
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat, a = lists.flatten().to_numpy(zero_copy_only=False), 0
            while a < len(ids):
                b = min(a + CHUNK_DOCS, max(a + 1, int(np.searchsorted(offsets, offsets[a] + CHUNK_POSTINGS, "right")) - 1), len(ids))
                s, e = offsets[a], offsets[b]
                yield chunk(ids[a:b], n[a:b], flat[s:e], np.repeat(np.arange(b - a), np.diff(offsets[a : b + 1])), tfs[s:e])
                a = b

    return run


class Item(NamedTuple):
    """A query: its terms, ascending, and their weights times repeats."""

    item_id: object
    terms: np.ndarray
    weights: np.ndarray


class _Chunk:
    """One row of the index, with the bounds and scores of an item's documents."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        numbers = lambda name: column(batch, name)[i].values.to_numpy(zero_copy_only=False)
        self.docs, self.n, self.terms, self.starts = column(batch, "docs")[i].as_py(), numbers("lengths"), numbers("terms"), numbers("starts")
        self.slots, self.tfs = numbers("slots"), numbers("tfs")
        self.tops, self.impacts = (np.frombuffer(column(batch, c)[i].as_py(), np.uint8) for c in ("tops", "impacts"))

    def meets(self, item: Item) -> list[tuple[int, int]]:
        """(place of the term in this chunk, weight) of the item's terms that the chunk holds."""
        if not len(self.terms):
            return []
        at = np.minimum(np.searchsorted(self.terms, item.terms), len(self.terms) - 1)
        hit = self.terms[at] == item.terms
        return list(zip(at[hit].tolist(), item.weights[hit].tolist(), strict=True))

    def most(self, met: list[tuple[int, int]]) -> int:
        return STEP * sum(w * int(self.tops[t]) for t, w in met)

    def bounds(self, met: list[tuple[int, int]], lower: bool) -> tuple[np.ndarray, np.ndarray]:
        """Upper bounds of all documents and, if asked for, lower ones; zero where no term of weight stands."""
        summed, weights = np.zeros(len(self.docs), np.int64), np.zeros(len(self.docs) if lower else 0, np.int64)
        for t, w in met:
            a, b = self.starts[t], self.starts[t + 1]
            at, q = self.slots[a:b], self.impacts[a:b]
            summed[at] += w * q.astype(np.int64)
            if lower:
                weights[at] += w * (q > 0)
        return STEP * summed, STEP * summed[: len(weights)] - (STEP - 1) * weights

    def scores(self, met: list[tuple[int, int]], slots: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
        """Exact scores of the documents at ascending slots."""
        m, out = length_factor(self.n[slots], n_docs, n_terms), np.zeros(len(slots), np.int64)
        for t, w in met:
            a, b = self.starts[t], self.starts[t + 1]
            at = np.minimum(np.searchsorted(self.slots[a:b], slots), b - a - 1)
            hit = self.slots[a:b][at] == slots
            out[hit] += w * impact(self.tfs[a:b][at[hit]], m[hit])
        return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Chunk]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Chunk(batch, i)


def _lower_bounds(items: list[Item], top: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The largest lower bounds of each item in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[np.ndarray] = [np.zeros(0, np.int64) for _ in items]
        for c in _chunks(batches):
            for i, item in enumerate(items):
                met = c.meets(item)
                if len(best[i]) == top and c.most(met) <= best[i].min():
                    continue
                low = c.bounds(met, lower=True)[1]
                low = np.concatenate([best[i], low[low > 0]])
                best[i] = np.partition(low, len(low) - top)[-top:] if len(low) > top else low
        number = np.repeat(np.arange(len(items)), [len(b) for b in best])
        yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *best]))], names=["item", "low"])

    return run


def _rescored(items: list[Item], least: list[int], n_docs: int, n_terms: int, top: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Exact scores of the documents whose upper bound reaches the item's threshold; of one task's the highest, which hold all of its
    documents that can be among the item's highest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, bool, int]]] = [[] for _ in items]  # score, has an id, minus the id: larger ones rank first
        for c in _chunks(batches):
            for i, item in enumerate(items):
                met = c.meets(item)
                if c.most(met) < least[i]:
                    continue
                reach = np.flatnonzero(c.bounds(met, lower=False)[0] >= least[i])
                scores = c.scores(met, reach, n_docs, n_terms)
                if len(best[i]) == top:
                    keep = scores >= min(best[i])[0]
                    reach, scores = reach[keep], scores[keep]
                found = [(s, c.docs[at] is not None, -(c.docs[at] or 0)) for at, s in zip(reach.tolist(), scores.tolist(), strict=True)]
                best[i] = heapq.nlargest(top, best[i] + found)
        rows = [(i, -d if has else None, s) for i, found in enumerate(best) for s, has, d in found]
        cols = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], names=["item", "doc_id", "score"])

    return run


def _search_block(docs: DataFrame, block: list[tuple[object, bytes]], top: int) -> DataFrame:
    """item, doc_id, score, rank of one block of items, by their number in the block."""
    counted = [Counter(terms(text)) for _, text in block]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counted)))}
    forward = materialize(arrow_map(docs, _forward(vocabulary), _FORWARD), "search-terms")
    total = forward.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    # At most one row for each term of the block.
    held = arrow_map(forward.select("terms"), _term_counts, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = {r["term"]: r["df"] for r in held.collect()}
    index = materialize(arrow_map(forward, _chunked(total["docs"], total["terms"]), _INDEX), "search-index")
    items = []
    for (name, _), counts in zip(block, counted, strict=True):
        own = {vocabulary[t]: n * weight(total["docs"], df.get(vocabulary[t], 0)) for t, n in counts.items()}
        own = {t: w for t, w in sorted(own.items()) if w > 0}
        items.append(Item(name, np.array(list(own), np.int32), np.array(list(own.values()), np.int64)))
    lows = arrow_map(index, _lower_bounds(items, top), "item int, low long")
    last = lows.withColumn("nth", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("low")))).filter(F.col("nth") <= top)
    reached = {r["item"]: r["low"] for r in last.filter(F.col("nth") == top).select("item", "low").collect()}
    scored = arrow_map(index, _rescored(items, [max(1, reached.get(i, 1)) for i in range(len(items))], total["docs"], total["terms"], top), "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", query_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: of each item the `top` documents with the highest scores above 0, equal scores by ascending id.

    A null or empty text has no terms: such a document is never found, and such an item has no rows. Repeated rows, of documents
    or items, count each; null ids come last among equal scores. A table without rows gives no rows; other columns are ignored.
    Items are taken in blocks of at most block_bytes of text (a longer one alone), of which all but a single one are written.
    """
    kind = items.schema[item_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    found, block, size = [], [], 0

    def named(block: list[tuple[object, bytes]]) -> DataFrame:
        spark = docs.sparkSession
        # One row for each item of the block.
        names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(block)], f"no int, item_id {kind}")
        return _search_block(texts, block, top).join(F.broadcast(names), F.col("item") == F.col("no")).select("item_id", "rank", "doc_id", "score")

    for row in items.select(F.col(item_col).alias("item_id"), F.col(query_col).cast("binary").alias("text")).toLocalIterator():
        text = bytes(row["text"] or b"")
        if block and size + len(text) > block_bytes:
            found.append(materialize(named(block), "search-block"))
            block, size = [], 0
        block.append((row["item_id"], text))
        size += len(text)
    last = named(block)
    return reduce(DataFrame.unionByName, found, last) if found else last
