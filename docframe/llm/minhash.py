"""Operator 13, MinHash near-dedup with an LSH forest.

A document is its set of 4-word shingles; documents with equal sets are one class. The classes lie in TREES sorted orders of their
signatures, each of which starts at other hash functions. Classes whose common prefix in an order is long are neighbours there:
a run of classes that agree in the first DEPTHS[0] values of an order is taken whole where it has at most TILE members, and is
cut by the next value, again and again, where it is denser; so every region has its own depth. A run that is too dense at the last
depth is not cut off but taken in tiles, each pair of tiles a task. At a similarity of 0.8 a pair meets in a tree of depth d with
probability 0.8**d: of 32 trees none holds it with 1e-10 at depth 3 and 6e-5 at the last depth, 6.

Members of a region are compared by 128 bytes of their signatures, and those that agree in LEAST_AGREE or more (five standard
deviations below the mean of a pair at the threshold) are linked loosely. Loose components are small; in each, the whole sets
are intersected, and links that reach the threshold exactly make the components of the result. A loose component that is too large for
a task is taken in tiles as well. No step gives all pairs of a group: searches give links from the first member they reach.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docframe.llm.common import arrow_map, column, held, materialize, text_or_empty
from docframe.llm.simhash import connected

SHINGLE, PERCENT = 4, 80
HASHES, TREES, DEPTHS = 128, 32, (3, 4, 5, 6)
LEAST_AGREE = 78
#: Most members of a region or of a tile, and most shingles of a tile of whole sets.
TILE, SET_TILE, SET_SHINGLES = 4096, 2048, 1 << 20
_SMALL, _BLOCK, _MOST_WORDS = 32, 4096, 1 << 20

_RANDOM = np.random.default_rng(20240229)
_XOR = _RANDOM.integers(0, 1 << 64, HASHES, np.uint64)
_ODD = _RANDOM.integers(0, 1 << 64, HASHES, np.uint64) | np.uint64(1)
_PLACES = _RANDOM.integers(0, 1 << 64, SHINGLE, np.uint64) | np.uint64(1)


class _Words(dict):
    """64-bit hashes of words, each computed once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MOST_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str | None, words: dict[bytes, int] | None = None) -> np.ndarray:
    """The distinct shingles of a whole text as ascending 64-bit hashes; a text with fewer words is one shingle, none gives none."""
    split = (text or "").encode().lower().split()
    n = len(split)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map((_Words() if words is None else words).__getitem__, split), np.uint64, n)
    if n < SHINGLE:
        return _mixed(np.array([n], np.uint64) + (h * _PLACES[:n]).sum(dtype=np.uint64))
    m = n - SHINGLE + 1
    return np.unique(_mixed(sum((h[i : m + i] * p for i, p in enumerate(_PLACES)), np.zeros(m, np.uint64))))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set, its high 32 bits."""
    least = np.full(HASHES, ~np.uint64(0), np.uint64)
    for i in range(0, len(shingles), _BLOCK):
        np.minimum(least, ((shingles[None, i : i + _BLOCK] ^ _XOR[:, None]) * _ODD[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = held("shingle words", _Words)
    for batch in batches:
        sizes, names, values, low = [], [], [], []
        for text in column(batch, "text"):
            s = shingle_set(text.as_py(), words)
            sizes.append(len(s))
            names.append(xxhash.xxh3_128_digest(s.tobytes()))
            value = signature(s) if len(s) else None
            values.append(None if value is None else value.view(np.int32))
            low.append(None if value is None else (value & np.uint32(255)).astype(np.uint8).tobytes())
        cols = [column(batch, "doc_id"), column(batch, "text_hash"), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(values, pa.list_(pa.int32())), pa.array(low, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "text_hash", "n_shingles", "rep", "sig", "low"])


_SKETCH = "doc_id long, text_hash long, n_shingles long, rep binary, sig array<int>, low binary"


def _grouped(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], solve: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """solve over whole groups of rows that come sorted by their keys: the last group of a batch waits for the next."""
    rest: list[pa.RecordBatch] = []

    def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if len(parts) > 1 else parts[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [column(batch, k).to_numpy(zero_copy_only=False) for k in keys]
        same = np.logical_and.reduce([c == c[-1] for c in cols])
        cut = int(np.argmax(same))  # where the last group begins
        if rest and not (cut == 0 and all(column(rest[0], k)[0].as_py() == column(batch, k)[0].as_py() for k in keys)):
            whole = joined([*rest, batch.slice(0, cut)] if cut else rest)
            yield solve(whole)
            rest = []
        elif cut:
            yield solve(batch.slice(0, cut))
        rest.append(batch.slice(cut))
    if rest:
        yield solve(joined(rest))


def _starts(batch: pa.RecordBatch, keys: tuple[str, ...]) -> np.ndarray:
    """First rows of the groups, and the number of rows."""
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for k in keys:
        c = column(batch, k).to_numpy(zero_copy_only=False)
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), batch.num_rows)


def _search(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Links (first member, member) that span the components of 0..n-1. near: which of the given ones are close to one."""
    left, out = np.arange(n), []
    while len(left) > 1:
        root, left = int(left[0]), left[1:]
        frontier = [root]
        while frontier and len(left):
            close = near(frontier.pop(), left)
            new = left[close].tolist()
            out += [(root, i) for i in new]
            frontier += new
            left = left[~close]
    return out


_REGION = ("region", "t1", "t2")


def _loose(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Links within regions between signatures that agree often enough."""
    sig = np.frombuffer(b"".join(column(batch, "low").to_pylist()), np.uint8).reshape(-1, HASHES)
    starts = _starts(batch, _REGION)
    sizes = np.diff(starts)
    group, small = np.repeat(np.arange(len(sizes)), sizes), np.repeat(sizes <= _SMALL, sizes)
    a, b = [], []
    for lag in range(1, min(_SMALL, int(sizes.max()))):
        i = np.flatnonzero((group[lag:] == group[:-lag]) & small[lag:])
        if len(i):
            i = i[(sig[i] == sig[i + lag]).sum(axis=1) >= LEAST_AGREE]
            a += i.tolist()
            b += (i + lag).tolist()
    for s, size in zip(starts[:-1][sizes > _SMALL].tolist(), sizes[sizes > _SMALL].tolist(), strict=True):
        own = sig[s : s + size]
        found = _search(size, lambda i, left, own=own: (own[left] == own[i]).sum(axis=1) >= LEAST_AGREE)
        a += [s + i for i, _ in found]
        b += [s + j for _, j in found]
    return _pairs(column(batch, "rep"), a, b)


def _pairs(reps: pa.Array, a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([reps.take(pa.array(a, pa.int64())), reps.take(pa.array(b, pa.int64()))], names=["a", "b"])


def exact_links(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that span the components of sets under 100 * intersection >= percent * union, by the whole sets."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    size = np.array([len(sets[i]) for i in order], np.int64)
    flat = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)[1]
    ends = np.cumsum(size)
    starts = ends - size
    marked = np.zeros(int(flat.max(initial=-1)) + 1, bool)

    def near(i: int, left: np.ndarray) -> np.ndarray:
        # Sets are in the order of their sizes: those that can reach the threshold lie side by side.
        lo, hi = np.searchsorted(size, -(-percent * size[i] // 100)), np.searchsorted(size, 100 * size[i] // percent, "right")
        own = flat[starts[i] : ends[i]]
        marked[own] = True
        common = np.add.reduceat(marked[flat[starts[lo] : ends[hi - 1]]], starts[lo:hi] - starts[lo], dtype=np.int64)
        marked[own] = False
        close = np.zeros(len(size), bool)
        close[lo:hi] = 100 * common >= percent * (size[i] + size[lo:hi] - common)
        return close[left]

    return [(int(order[i]), int(order[j])) for i, j in _search(len(sets), near)]


_GROUP = ("label", "t1", "t2")


def _confirmed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Exact links within loose components; a class that comes twice counts once."""
    starts, reps, whole = _starts(batch, _GROUP), column(batch, "rep"), column(batch, "shingles")
    a, b = [], []
    for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        first = {reps[i].as_py(): i for i in range(e - 1, s - 1, -1)}
        rows = sorted(first.values())
        if len(rows) > 1:
            found = exact_links([np.frombuffer(whole[i].as_py(), np.uint64) for i in rows])
            a += [rows[i] for i, _ in found]
            b += [rows[j] for _, j in found]
    return _pairs(reps, a, b)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = held("shingle words", _Words)
    for batch in batches:
        sets = [shingle_set(t.as_py(), words).tobytes() for t in column(batch, "text")]
        yield pa.RecordBatch.from_arrays([*(column(batch, c) for c in ("rep", "label", "tiles")), pa.array(sets, pa.binary())], names=["rep", "label", "tiles", "shingles"])


def _tiled(rows: DataFrame, tiles: Column, keys: list[str], kept: list[str]) -> DataFrame:
    """Rows with t1 and t2: one copy for each pair of tiles that a row takes part in, dealt out and sorted by keys and pair."""
    t = F.pmod(F.xxhash64("rep"), tiles).cast("int")
    mates = rows.withColumn("_t", t).withColumn("_m", F.explode(F.sequence(F.lit(0), tiles.cast("int") - 1)))
    spread = mates.select(*keys, F.least("_t", "_m").alias("t1"), F.greatest("_t", "_m").alias("t2"), *kept)
    return spread.repartition(*keys, "t1", "t2").sortWithinPartitions(*keys, "t1", "t2")


def loose_links(reps: DataFrame, tile: int = TILE) -> DataFrame:
    """(a, b): links between the classes (rep, sig, low) that are neighbours in an order and whose signatures agree often enough."""
    def prefix(depth: int) -> Column:
        """Of the order that starts at the fourth value of a tree's number: its first values and its number, as one hash."""
        values = [F.get(F.col("sig"), F.pmod(F.lit(HASHES // TREES) * F.col("tree") + i, F.lit(HASHES))) for i in range(depth)]
        return F.xxhash64("tree", F.lit(depth), *values)

    rows = reps.select("rep", "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    rows = rows.select("rep", *[prefix(d).alias(f"p{d}") for d in DEPTHS])
    dense: list[DataFrame] = []
    todo = rows
    for d in DEPTHS:
        sizes = todo.groupBy(f"p{d}").count().filter(F.col("count") > tile)
        found = materialize(sizes.select(F.col(f"p{d}").alias(f"h{d}"), F.ceil(F.col("count") / tile).cast("int").alias(f"tiles{d}")), f"dense-{d}")
        if found.isEmpty():
            break
        dense.append(found)
        todo = todo.join(found, F.col(f"p{d}") == F.col(f"h{d}"), "left_semi")
    region, tiles = F.col(f"p{DEPTHS[len(dense)]}") if len(dense) < len(DEPTHS) else F.col(f"p{DEPTHS[-1]}"), F.lit(1)
    if len(dense) == len(DEPTHS):
        tiles = F.coalesce(f"tiles{DEPTHS[-1]}", F.lit(1))
    for d, found in zip(DEPTHS, dense, strict=False):
        rows = rows.join(found, F.col(f"p{d}") == F.col(f"h{d}"), "left")
    for d, _ in list(zip(DEPTHS, dense, strict=False))[::-1]:
        region = F.when(F.col(f"h{d}").isNull(), F.col(f"p{d}")).otherwise(region)
    placed = rows.select("rep", region.alias("region"), tiles.alias("tiles"))
    shared = placed.withColumn("_n", F.count("*").over(Window.partitionBy("region"))) if len(dense) < len(DEPTHS) else _shared(placed)
    shared = materialize(shared.filter("_n > 1").select("rep", "region", "tiles"), "regions")
    held_by = reps.select(F.col("rep").alias("_r"), "low")
    joined = shared.join(held_by, F.col("rep") == F.col("_r"))
    dealt = _tiled(joined.select("rep", "region", "tiles", "low"), F.col("tiles"), ["region"], ["rep", "low"])
    return arrow_map(dealt, lambda batches: _grouped(batches, _REGION, _loose), "a binary, b binary").distinct()


def _shared(placed: DataFrame) -> DataFrame:
    """Rows with the number of their region's members, where regions may be of any size."""
    sizes = placed.groupBy(F.col("region").alias("_g")).agg(F.count("*").alias("_n"))
    return placed.join(sizes.filter("_n > 1"), F.col("region") == F.col("_g"))


def minhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE, set_tile: int = SET_TILE, set_shingles: int = SET_SHINGLES) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    component_id is the smallest id reachable over links of similarity PERCENT or more, the row's own included; documents with equal sets
    are linked. Null texts and texts without words have no shingles and link with nothing, not with each other either. Null ids
    are passed over for component_id, which is null where a component has no other; kept says whether the two ids are equal, nulls too.
    Repeated rows stay. An empty table gives no rows; other columns are ignored.
    """
    text = F.col(text_col)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_or_empty(text_col)).alias("text_hash"), text.alias("text"))
    sketches = materialize(arrow_map(base, _sketches, _SKETCH, keeps="shingle words"), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    # Signatures of a class are equal, so any will do.
    reps = sketches.filter("n_shingles > 0").groupBy("rep").agg(first.alias("first"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), F.first("low").alias("low"))
    reps = materialize(reps, "classes")
    loose = connected(loose_links(reps, tile))
    members = materialize(loose.join(reps.select("rep", "first", "n_shingles"), F.col("node") == F.col("rep")).select("rep", "label", "first", "n_shingles"), "loose")
    most = members.groupBy(F.col("label").alias("_l")).agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    tiles = F.ceil(F.greatest(F.col("n") / set_tile, F.col("s") / set_shingles)).cast("int")
    wanted = members.join(most.select("_l", tiles.alias("tiles")), F.col("label") == F.col("_l"))
    wanted = wanted.select("rep", "label", "tiles", F.col("first.doc_id").alias("wid"), F.col("first.text_hash").alias("wh"))
    spot = lambda i, h: F.xxhash64(i, h, i.isNull())
    wanted = wanted.withColumn("ws", spot(F.col("wid"), F.col("wh")))
    mine = base.withColumn("spot", spot(F.col("doc_id"), F.col("text_hash")))
    found = mine.join(wanted, (F.col("spot") == F.col("ws")) & F.col("doc_id").eqNullSafe(F.col("wid")) & (F.col("text_hash") == F.col("wh")))
    # Of repeated rows one is enough.
    one = found.withColumn("nth", F.row_number().over(Window.partitionBy("spot", "doc_id", "text_hash").orderBy("spot"))).filter("nth = 1").select("rep", "label", "tiles", "text")
    sets = arrow_map(one, _sets, "rep binary, label binary, tiles int, shingles binary", keeps="shingle words")
    dealt = _tiled(sets, F.col("tiles"), ["label"], ["rep", "shingles"])
    links = arrow_map(dealt, lambda batches: _grouped(batches, _GROUP, _confirmed), "a binary, b binary")
    labels = connected(links)
    named = reps.select("rep", F.col("first.doc_id").alias("least")).join(labels, F.col("rep") == F.col("node"), "left").select("rep", "least", F.coalesce("label", "rep").alias("label"))
    named = materialize(named, "named-classes")
    # Written, so that a label or class of very many rows can be split in the joins.
    per_label = materialize(named.groupBy(F.col("label").alias("l2")).agg(F.min("least").alias("component_id")), "class-labels")
    per_rep = materialize(named.join(per_label, F.col("label") == F.col("l2")).select(F.col("rep").alias("r2"), "component_id"), "class-components")
    joined = sketches.select("doc_id", "n_shingles", "rep").join(per_rep, (F.col("rep") == F.col("r2")) & (F.col("n_shingles") > 0), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def brute_components(sets: dict[int, set], percent: int = PERCENT) -> dict[int, int]:
    """component_id by comparing all pairs of sets; for tests."""
    label = {i: i for i in sets}

    def top(i: int) -> int:
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, i in enumerate(ids):
        for j in ids[:n]:
            common = len(sets[i] & sets[j])
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = top(i), top(j)
                label[max(a, b)] = min(a, b)
    return {i: top(i) for i in sets}
