"""Operator 7, suffix-array dedup with hash-compared suffixes.

Every byte covered by a string of WINDOW bytes that also starts elsewhere is removed. The suffixes of all texts do not fit one
array, so they are dealt out by content first, sorted where they meet, and only those that can repeat are sorted:

1. Prefix polynomial hashes of a text give the hash of each GRAM of bytes; a window's anchor is its gram with the smallest
   hash, the leftmost of equals. Equal windows have equal anchors at equal places, and windows that follow each other mostly
   share theirs: an anchor row stands for a stretch of window starts, with a hash of 128 bits of all the bytes that they span.
2. Rows meet by anchor, those of a batch combined before. Stretches of one anchor with the same 128 bits are copies: that hash
   stands for the comparison of their bytes, and it is independent of the anchor's. One representative of copies goes on; an
   anchor with one stretch needs no sort.
3. The representatives' bytes are fetched, and the suffixes at their window starts are sorted by mergesort, in many runs at
   once: two suffixes compare by binary search for their longest common extension over prefix polynomial hashes, so in
   logarithmic time. Suffixes with a common extension of a whole window fall together in the merge; each such claim is
   verified by comparing the bytes, so a colliding hash can add nothing. An anchor with more than HOT window starts is dealt
   out: equal windows of a batch are compared there, one of them goes on, and the windows' hashes say which part of the anchor
   they go to, so that its parts are sorted in different tasks.
4. Repeated window starts return to their documents, where the covered bytes are cut out.

Texts move twice at most, and only those of documents concerned. A task holds the suffixes of about HOT window starts at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docframe.llm.common import arrow_map, column, held, materialize

WINDOW, GRAM = 200, 80
#: Window starts that a worker looks at in one go; suffixes that it sorts in one go, and bytes that they come from.
_BLOCK, _SORT, _SORT_BYTES = 1 << 18, 1 << 17, 2 << 20
#: Window starts of an anchor beyond which it is dealt out, and of the parts that it is dealt out in.
HOT, PART = 1 << 15, 1 << 11
_POWERS = "powers"
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


class PrefixHashes:
    """Polynomial hashes of all prefixes of a byte string, modulo 2**64."""

    def __init__(self, data: np.ndarray):
        self.data, n = data, len(data)
        powers = held(_POWERS, dict)
        if len(powers.get(1, ())) <= n:
            with np.errstate(over="ignore"):
                powers[1] = np.cumprod(np.concatenate([np.ones(1, _U), np.full(n + (n >> 2), _BASE, _U)]))
                powers[-1] = np.cumprod(np.concatenate([np.ones(1, _U), np.full(n + (n >> 2), pow(_BASE, -1, 1 << 64), _U)]))
        self._inverse = powers[-1]
        self.prefix = np.zeros(n + 1, _U)
        np.cumsum((data.astype(_U) + _U(1)) * powers[1][:n], out=self.prefix[1:])

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """Hashes of substrings; equal strings have equal hashes wherever they start."""
        return (self.prefix[start + length] - self.prefix[start]) * self._inverse[start]

    def windows(self, length: int) -> np.ndarray:
        n = len(self.data) - length + 1
        return (self.prefix[length : length + n] - self.prefix[:n]) * self._inverse[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of width neighbours: running minima from both ends of blocks of that width."""
    n = len(values) - width + 1
    padded = np.concatenate([values, np.full(-len(values) % width, np.iinfo(np.uint64).max, _U)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: bytes, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Anchor hash, both halves of the hash of the bytes spanned, first window start and number of window starts of each stretch."""
    found: list[tuple[np.ndarray, ...]] = []
    n = len(data) - window + 1
    width = window - gram + 1
    view = memoryview(data)
    for base in range(0, max(n, 0), _BLOCK):
        starts = min(_BLOCK, n - base)
        part = np.frombuffer(view[base : base + starts + window - 1], np.uint8)
        grams = _mix(PrefixHashes(part).windows(gram))
        least = _window_minima(grams, width)
        # The leftmost gram with the window's minimum: the next place at or after the start where it stands.
        new = np.ones(starts, bool)
        new[1:] = least[1:] != least[:-1]
        new[1:] |= grams[: starts - 1] == least[: starts - 1]  # the window before began at its anchor
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, starts))
        span = first + count + window - 1
        low = memoryview(part)
        spans = np.frombuffer(b"".join([xxhash.xxh3_128_digest(low[a:b]) for a, b in zip(first.tolist(), span.tolist(), strict=True)]), _U).reshape(-1, 2)
        found.append((least[first], spans[:, 0], spans[:, 1], first + base, count))
    if not found:
        return *[np.zeros(0, _U)] * 3, np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


#: What a row is after step 2: a repeated stretch, a lone one among others of its anchor, the representative of copies.
_KIND_DONE, _KIND_SINGLE, _KIND_COPY = 0, 1, 2
#: What a row stands for before it: a decided place, one stretch, several equal ones whose places are decided.
_DECIDED, _ALONE, _SEVERAL = 0, 1, 2


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols: list[list[np.ndarray]] = [[] for _ in range(6)]
        for i, t in zip(column(batch, "row").to_pylist(), column(batch, "text"), strict=True):
            k, c, d, s, n = anchors((t.as_py() or "").encode())
            for col, v in zip(cols, (k.view(np.int64), c.view(np.int64), d.view(np.int64), np.full(len(k), i), s, n), strict=True):
                col.append(v)
        k, c, d, i, s, n = (np.concatenate(x or [np.zeros(0, np.int64)]) for x in cols)
        # Stretches that repeat within the batch are decided already: their places go on as decided, with keys that spread them,
        # and one representative meets the other batches. So an anchor that is hot here is one row there.
        order = np.lexsort((d, c, k))
        first = np.ones(len(k), bool)
        first[1:] = (k[order[1:]] != k[order[:-1]]) | (c[order[1:]] != c[order[:-1]]) | (d[order[1:]] != d[order[:-1]])
        group = np.cumsum(first) - 1
        size = np.bincount(group) if len(k) else np.zeros(0, np.int64)
        lone, many = order[size[group] == 1], order[size[group] > 1]
        heads = order[first & (size[group] > 1)]
        spread = _mix((i[many] * 0x5851F42D4C957F2D + s[many]).view(_U)).view(np.int64)
        take = np.concatenate([lone, heads, many])
        weight = np.repeat(np.array([_ALONE, _SEVERAL, _DECIDED], np.int32), [len(lone), len(heads), len(many)])
        keys = np.concatenate([k[lone], k[heads], spread])
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(c[take]), pa.array(d[take]), pa.array(i[take]), pa.array(s[take]), pa.array(n[take].astype(np.int32)), pa.array(weight)], names=["k", "c", "d", "row", "s", "n", "w"])

def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor and bytes: copies are done; where an anchor has several stretches, one representative of each goes
    on. A row is decided by its neighbours: between batches only the last row is kept, and the first representative of
    its anchor, which goes on once another stretch turns up. So an anchor may have any number of rows."""
    carry: list[np.ndarray] | None = None
    same_before = (False, False)  # whether the row before the carried one has its anchor, its bytes
    several_before = False
    pending: tuple[int, int, int, int] | None = None

    def solve(cols: list[np.ndarray], final: bool) -> pa.RecordBatch:
        nonlocal carry, same_before, several_before, pending
        k, c, d, row, s, n, w = cols
        size = len(k)
        same_k, same_c = np.zeros(size, bool), np.zeros(size + 1, bool)
        same_k[1:] = k[1:] == k[:-1]
        same_c[1:-1] = same_k[1:] & (c[1:] == c[:-1]) & (d[1:] == d[:-1])
        same_k[0], same_c[0] = same_before
        group = np.cumsum(~same_k)
        group -= group[0]
        several = np.bincount(group, weights=same_k & ~same_c[:-1]) > 0
        several[0] |= same_k[0] and several_before
        copy, head, many = same_c[:-1] | same_c[1:] | (w == _SEVERAL), ~same_c[:-1], several[group]
        decided = np.arange(size) < (size if final else size - 1)
        done, single = np.flatnonzero(decided & copy & (w == _ALONE)), np.flatnonzero(decided & ~copy & many)
        shown = np.flatnonzero(decided & copy & head & many)
        i = np.concatenate([done, single, shown])
        kind = np.repeat(np.array([_KIND_DONE, _KIND_SINGLE, _KIND_COPY], np.int32), [len(done), len(single), len(shown)])
        out = [k[i], row[i], s[i], n[i], kind]
        if pending is not None and same_k[0] and several[0]:
            out = [np.append(x, np.array(v, x.dtype)) for x, v in zip(out, (*pending, _KIND_COPY), strict=True)]
            pending = None
        if group[-1] > 0 or not same_k[0]:
            pending = None
        if not several[-1]:
            at = np.flatnonzero((group == group[-1]) & head & copy & decided)
            if len(at):
                pending = (int(k[at[0]]), int(row[at[0]]), int(s[at[0]]), int(n[at[0]]))
        same_before, several_before = (bool(same_k[-1]), bool(same_c[-2])), bool(several[-1])
        carry = [x[-1:] for x in cols]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["k", "row", "s", "n", "kind"])

    for batch in batches:
        cols = [column(batch, x).to_numpy() for x in ("k", "c", "d", "row", "s", "n", "w")]
        open_ = cols[6] != _DECIDED
        if not open_.all():
            k, _, _, row, s, n, _ = (x[~open_] for x in cols)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (k, row, s, n, np.full(len(k), _KIND_DONE, np.int32))], names=["k", "row", "s", "n", "kind"])
            cols = [x[open_] for x in cols]
        if carry is not None:
            cols = [np.concatenate(p) for p in zip(carry, cols, strict=True)]
        if len(cols[0]) > 1 or (carry is None and len(cols[0])):
            yield solve(cols, False)
    if carry is not None:
        yield solve(carry, True)


def repeated_in_parts(data: np.ndarray, at: np.ndarray, window: int = WINDOW, most: int = _SORT) -> np.ndarray:
    """repeated_suffixes of any number of suffixes, about `most` at a time: equal ones share their first bytes, so parts dealt by
    these hold all that can be equal."""
    parts = -(-len(at) // most)
    if parts < 2:
        return repeated_suffixes(data, at, window)
    hashes = PrefixHashes(data)
    part = (_mix(hashes.of(at, 24)) % _U(parts)).astype(np.int32)
    found = np.zeros(len(at), bool)
    for p in range(parts):
        mine = np.flatnonzero(part == p)
        found[mine] = repeated_suffixes(data, at[mine], window, hashes)
    return found


def repeated_suffixes(data: np.ndarray, at: np.ndarray, window: int = WINDOW, hashes: PrefixHashes | None = None) -> np.ndarray:
    """Which of the suffixes data[at:] share their first window bytes with another of them.

    A bottom-up mergesort of all runs at once. Suffixes are dealt into runs by their first 8 bytes; in each round the later run
    of a pair finds its places in the earlier one by binary search, comparing suffixes by hash. Equal suffixes fall together.
    """
    total = len(at)
    repeated = np.zeros(total, bool)
    if total < 2:
        return repeated
    hashes = hashes or PrefixHashes(data)
    rows = sliding_window_view(data, window)
    whole = hashes.of(at, window)
    prefix = np.ascontiguousarray(rows[:, :8])[at].view(">u8").ravel().astype(_U)
    order = np.argsort(prefix, kind="stable")
    run = np.cumsum(np.concatenate([[0], prefix[order][1:] != prefix[order][:-1]]))

    def extension(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extension of suffixes that differ within the window."""
        low, high = np.full(len(a), 8), np.full(len(a), window - 1)
        x, y = at[a], at[b]
        while True:
            open_ = low < high
            if not open_.any():
                return low
            mid = (low + high + 1) >> 1
            same = hashes.of(x, mid) == hashes.of(y, mid)
            low, high = np.where(same & open_, mid, low), np.where(same | ~open_, high, mid - 1)

    def compare(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0, 1 as suffix a sorts before, with or after b; equality holds for the bytes."""
        out = np.zeros(len(a), np.int8)
        equal = whole[a] == whole[b]
        i = np.flatnonzero(equal)
        for j in range(0, len(i), 1 << 14):
            part = i[j : j + (1 << 14)]
            equal[part] = (rows[at[a[part]]] == rows[at[b[part]]]).all(axis=1)
        i = np.flatnonzero(~equal)
        if len(i):
            x, y = a[i], b[i]
            e = extension(x, y)
            collided = np.flatnonzero(whole[x] == whole[y])
            if len(collided):
                e[collided] = (rows[at[x[collided]]] != rows[at[y[collided]]]).argmax(axis=1)
            out[i] = np.where(data[at[x] + e] < data[at[y] + e], -1, 1)
        return out

    sub = np.arange(total)  # sorted runs so far: at first each suffix is one
    while True:
        # Pair up the sorted runs of each run of equal first bytes.
        new = np.ones(len(order), bool)
        new[1:] = sub[1:] != sub[:-1]
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(order))
        of_run = run[starts]
        nth = np.arange(len(starts)) - np.searchsorted(of_run, of_run)
        odd = np.flatnonzero(nth % 2 == 1)
        if not len(odd):
            return repeated
        later = np.repeat(odd, ends[odd] - starts[odd])
        sizes = ends[odd] - starts[odd]
        b = np.repeat(starts[odd] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(later))
        low, high = starts[later - 1].copy(), ends[later - 1].copy()
        hit = np.zeros(len(b), bool)
        while True:
            i = np.flatnonzero((low < high) & ~hit)
            if not len(i):
                break
            mid = (low[i] + high[i]) >> 1
            c = compare(order[mid], order[b[i]])
            hit[i] = c == 0
            low[i] = np.where(c < 0, mid + 1, np.where(c == 0, mid, low[i]))
            high[i] = np.where(c > 0, mid, high[i])
        repeated[order[b[hit]]] = True
        repeated[order[low[hit]]] = True
        key = 2 * np.arange(len(order), dtype=np.int64) + 1
        key[b] = 2 * low
        stay = np.ones(len(order), bool)
        stay[b[hit]] = False
        label = sub.copy()
        label[b] = sub[starts[later - 1]]
        move = np.argsort(key, kind="stable")
        move = move[stay[move]]
        order, run, sub = order[move], run[move], label[move]


def _runs_of(owner: np.ndarray, inner: np.ndarray, row: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first window start, number of window starts) of runs of neighbours among the window starts inner of stretches."""
    start = np.ones(len(inner), bool)
    start[1:] = (np.diff(inner) != 1) | (np.diff(owner) != 0)
    first = np.flatnonzero(start)
    return row[owner[first]], s[owner[first]] + inner[first], np.diff(np.append(first, len(inner)))


_FETCHED = "k long, part int, row long, s long, n int, kind int, bytes binary, at array<int>"
_FETCHED_NAMES = ("k", "part", "row", "s", "n", "kind", "bytes", "at")


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort the suffixes of whole parts of anchors, as many at once as fit, and give the repeated window starts of single
    stretches. at: the window starts that a row stands for, all where null; of those below zero nothing is said."""
    waiting: list[tuple] = []
    windows = size = 0

    def rows(row: np.ndarray, s: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(s, pa.int64()), pa.array(n.astype(np.int32))], names=["row", "s", "n"])

    def flush(waiting: list[tuple]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(r[6] for r in waiting), np.uint8)
        n = np.array([r[4] if r[7] is None else len(r[7]) for r in waiting], np.int64)
        length = np.array([len(r[6]) for r in waiting], np.int64)
        begin = np.cumsum(n) - n
        owner = np.repeat(np.arange(len(waiting)), n)
        inner = np.arange(n.sum()) - begin[owner]
        told = np.array([r[5] == _KIND_SINGLE for r in waiting])[owner]
        for j, r in enumerate(waiting):
            if r[7] is not None:
                at = np.array(r[7], np.int64)
                inner[begin[j] : begin[j] + n[j]] = np.where(at < 0, -1 - at, at)
                told[begin[j] : begin[j] + n[j]] = at >= 0
        found = np.flatnonzero(repeated_in_parts(data, (np.cumsum(length) - length)[owner] + inner) & told)
        return rows(*_runs_of(owner[found], inner[found], np.array([r[2] for r in waiting], np.int64), np.array([r[3] for r in waiting], np.int64)))

    for batch in batches:
        done = []
        for r in zip(*(column(batch, x).to_pylist() for x in _FETCHED_NAMES), strict=True):
            if r[5] == _KIND_DONE:
                done.append(r[2:5])
                continue
            if (windows >= _SORT or size >= _SORT_BYTES) and r[:2] != waiting[-1][:2]:
                yield flush(waiting)
                waiting, windows, size = [], 0, 0
            waiting.append(r)
            windows += r[4]
            size += len(r[6])
        if done:
            yield rows(*np.array(done, np.int64).T)
    if waiting:
        yield flush(waiting)


def _dealt(hot: list[tuple], parts: list[int]) -> list[tuple]:
    """The window starts of stretches of hot anchors, dealt out to the anchors' parts by the windows' hashes. Windows that repeat
    here, which their bytes confirm, are decided here, and one of them goes on."""
    data = np.frombuffer(b"".join(r[6] for r in hot), np.uint8)
    n, length = np.array([r[4] for r in hot], np.int64), np.array([len(r[6]) for r in hot], np.int64)
    owner = np.repeat(np.arange(len(hot)), n)
    inner = np.arange(n.sum()) - (np.cumsum(n) - n)[owner]
    at = (np.cumsum(length) - length)[owner] + inner
    k = np.array([r[0] for r in hot], np.int64)[owner]
    h = _mix(PrefixHashes(data).of(at, WINDOW))
    order = np.lexsort((h, k))
    first = np.ones(len(order), bool)
    first[1:] = (h[order[1:]] != h[order[:-1]]) | (k[order[1:]] != k[order[:-1]])
    head = order[np.flatnonzero(first)][np.cumsum(first) - 1]  # of each window in order, the first with its hash
    rows = sliding_window_view(data, WINDOW)
    same = np.zeros(len(order), bool)
    later = np.flatnonzero(~first)
    for j in range(0, len(later), 1 << 13):
        i = later[j : j + (1 << 13)]
        same[i] = (rows[at[order[i]]] == rows[at[head[i]]]).all(axis=1)
    copy, decided = np.zeros(len(order), bool), np.zeros(len(order), bool)
    copy[order[same]] = decided[order[same]] = decided[head[same]] = True
    single = np.array([r[5] == _KIND_SINGLE for r in hot])[owner]
    i = np.flatnonzero(decided & single)
    row, s = np.array([r[2] for r in hot], np.int64), np.array([r[3] for r in hot], np.int64)
    spread = (_mix(h[i]) >> _U(1)).astype(np.int64)
    runs = _runs_of(owner[i], inner[i], row, s)
    out = [(key, 0, *x, _KIND_DONE, None, None) for key, *x in zip(spread.tolist(), *(v.tolist() for v in runs), strict=False)]
    part = (h % np.array(parts, _U)[owner]).astype(np.int64)
    i = np.flatnonzero(~copy)
    i = i[np.lexsort((inner[i], part[i], owner[i]))]
    new = np.ones(len(i), bool)
    new[1:] = (np.diff(owner[i]) != 0) | (np.diff(part[i]) != 0)
    told = np.where(single & ~decided, inner, -1 - inner)
    bounds = np.append(np.flatnonzero(new), len(i)).tolist()
    for a, b in zip(bounds, bounds[1:], strict=False):
        r = hot[owner[i[a]]]
        out.append((r[0], int(part[i[a]]), *r[2:7], told[i[a:b]].tolist()))
    return out


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes that the stretches of each text span; those of hot anchors dealt out to their parts."""
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32())]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=[*_FETCHED_NAMES])

    for batch in batches:
        rows, hot, parts, windows = [], [], [], 0
        for row, text, needs in zip(column(batch, "row").to_pylist(), column(batch, "text").to_pylist(), column(batch, "needs").to_pylist(), strict=True):
            data = text.encode()
            for need in needs:
                s, n = need["s"], need["n"]
                found = (need["k"], 0, row, s, n, need["kind"], data[s : s + n + WINDOW - 1], None)
                if need["parts"] < 2:
                    rows.append(found)
                    continue
                hot.append(found)
                parts.append(need["parts"])
                windows += n
                if windows >= _SORT:
                    yield batch_of(_dealt(hot, parts))
                    hot, parts, windows = [], [], 0
        if rows:
            yield batch_of(rows)
        if hot:
            yield batch_of(_dealt(hot, parts))


def spans_of(starts: list[tuple[int, int]], window: int = WINDOW) -> list[tuple[int, int]]:
    """Maximal byte runs [from, to) covered by windows, given as (first start, number of starts)."""
    out: list[list[int]] = []
    for s, n in sorted(starts):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s + n - 1 + window)
        else:
            out.append([s, s + n - 1 + window])
    return [(a, b) for a, b in out]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Figures of the texts that lose bytes, and with a column rest their remaining texts and spans beside it."""
    for batch in batches:
        full = batch.schema.get_field_index("rest") >= 0
        out: list[list] = [[] for _ in range(7)]
        for row, text, starts in zip(column(batch, "row").to_pylist(), column(batch, "text").to_pylist(), column(batch, "starts").to_pylist(), strict=True):
            data = text.encode()
            spans = spans_of([(x["s"], x["n"]) for x in starts or []])
            kept, at = [], 0
            for a, b in spans:
                kept.append(data[at:a])
                at = b
            left = b"".join([*kept, data[at:]])
            values = (row, len(data), len(data) - len(left), len(spans), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore") if full else None, [{"from": a, "to": b} for a, b in spans] if full else None)
            for col, v in zip(out, values, strict=True):
                col.append(v)
        types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))]
        arrays = [pa.array(x, t) for x, t in zip(out, types, strict=True)]
        names = ["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "spans"]
        if full:
            yield pa.RecordBatch.from_arrays([*arrays, column(batch, "rest")], names=[*names, "rest"])
        else:
            yield pa.RecordBatch.from_arrays(arrays[:5], names=names[:5])


def repeated_starts(base: DataFrame, hot: int = HOT) -> DataFrame:
    """(row, s, n): stretches of window starts that repeat; base has row and text."""
    rows = arrow_map(base, _anchor_rows, "k long, c long, d long, row long, s long, n int, w int", _POWERS)
    met = materialize(arrow_map(rows.repartition("k").sortWithinPartitions("k", "c", "d"), _meet, "k long, row long, s long, n int, kind int"), "met")
    going = met.filter(F.col("kind") != _KIND_DONE)
    # At most as many anchors as all window starts hold `hot`; written, so that the join knows their size.
    heavy = materialize(going.groupBy("k").agg(F.sum("n").alias("w")).filter(F.col("w") > hot).select(F.col("k").alias("hk"), F.ceil(F.col("w") / min(hot, PART)).cast("int").alias("parts")), "hot")
    needs = going.join(heavy, F.col("k") == F.col("hk"), "left").groupBy("row").agg(F.collect_set(F.struct("k", "s", "n", "kind", F.coalesce("parts", F.lit(1)).alias("parts"))).alias("needs"))
    fetched = arrow_map(base.join(needs, "row").select("row", "text", "needs"), _fetch, _FETCHED, _POWERS)
    resolved = arrow_map(fetched.repartition("k", "part").sortWithinPartitions("k", "part"), _resolve, "row long, s long, n int", _POWERS)
    return met.filter(F.col("kind") == _KIND_DONE).select("row", "s", "n").union(resolved)


_FIGURES = "row long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row, doc_id, text and the other columns. Ids from 0 up that stand once name their rows; all other rows go by a negative hash
    of id and text, so rows that share an id but not the text are told apart."""
    text, own = F.coalesce(F.col(text_col), F.lit("")), F.col(id_col).cast("long")
    twice = materialize(docs.select(own.alias("twice")).groupBy("twice").count().filter("count > 1 and twice is not null").select("twice"), "twice")
    rest = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns if c != text_col]
    base = docs.select(own.alias("doc_id"), text.alias("text"), F.struct(*rest).alias("rest"))
    joined = base.join(twice, F.col("doc_id") == F.col("twice"), "left")
    hashed = -1 - F.pmod(F.xxhash64(F.col("doc_id"), F.col("doc_id").isNull(), F.col("text")), F.lit(1 << 62))
    row = F.when((F.col("doc_id") >= 0) & F.col("twice").isNull(), F.col("doc_id")).otherwise(hashed)
    return joined.select(row.alias("row"), "doc_id", "text", "rest")


def _starts(named: DataFrame, hot: int) -> DataFrame:
    return repeated_starts(named.select("row", "text"), hot).groupBy("row").agg(F.collect_set(F.struct("s", "n")).alias("starts"))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Null counts as empty; texts shorter than a window lose nothing. Every place of a repeated string loses it, and strings may
    repeat within one text. Repeated rows are places of their own, so copies lose all that a window covers; rows without an
    id, or with one that other rows have, are told apart by their texts. An empty table gives no rows; other columns are ignored.
    """
    named = _named(docs, id_col, text_col).select("row", "doc_id", "text")
    # Only the texts that lose bytes move; the figures of the others come from the scan.
    starts = materialize(_starts(named, hot), "starts")
    cut = arrow_map(named.join(starts, "row").select("row", "text", "starts"), _remove, _FIGURES).dropDuplicates(["row"])  # repeated rows share their row and its figures
    plain = named.select("row", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole_sha"))
    joined = plain.join(cut.drop("n_bytes").withColumnRenamed("row", "cut_row"), F.col("row") == F.col("cut_row"), "left")
    zero = F.lit(0).cast("long")
    return joined.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "whole_sha").alias("kept_sha256"))


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", figures: bool = False) -> DataFrame:
    """docs with the repeated bytes cut from the texts, all other columns as they were; with figures also n_bytes, n_removed,
    n_spans and spans. Where a removed run ends inside a character, the text leaves out that character's rest. Null texts
    become empty."""
    named = _named(docs, id_col, text_col)
    # A type and not its text, for names of columns may hold any sign.
    schema = StructType.fromDDL(_FIGURES + ", kept_text string, spans array<struct<`from`: long, `to`: long>>").add("rest", named.schema["rest"].dataType)
    whole = named.select("row", "text", "rest").join(_starts(named, HOT), "row", "left")
    out = arrow_map(whole, _remove, schema)
    columns = [F.col("kept_text").alias(c) if c == text_col else F.col("rest").getField(c).alias(c) for c in docs.columns]
    return out.select(*columns, *(["n_bytes", "n_removed", "n_spans", "spans"] if figures else []))
