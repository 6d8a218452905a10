"""Operator 10, BPE encoding and decoding with a tokenization automaton.

The merges are compiled in their order. The automaton starts with one state and an arc back to it for every base symbol.
The gadget of merge (u, v) -> w splits off the state that arcs labelled u lead to: its copy has no arc v, and every state
with an arc u whose target had an arc v gets an arc w to v's target. So a state is known by the last label read, and it
lacks the arcs that some gadget took away. Arcs are kept as the gadgets left them: per label the removed arcs with the rank
of their gadget; a copy inherits what its original lacked when it was made, and an arc w exists where its parts' arcs
existed when w's gadget ran. A label string is accepted if and only if it is the encoding of its text, and every text has
one accepted path. Encoding walks that path over a pre-split word by table lookups: a scanner tells which
labels end at a position, and the one whose arc exists after the shorter prefix's path is taken, in time linear in the word.
Many words take each step together. Decoding emits the arcs' labels.

Texts are pre-split at white space, and each different piece is encoded once per worker while a bounded table holds it. The
driver compiles the automaton once and ships its arrays as a file.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import tempfile
import unicodedata
import uuid
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docframe.llm.common import arrow_map, column, held

VOCABULARY = "word_bpe_49k.json"
WORD_END = "</w>"
_SIGNS = frozenset(".,;:!?")
#: Entries of a worker's table of pieces, beyond which only those of the texts at hand stay; characters that are encoded in one
#: go; cells of the table in which words step together.
CACHE_ENTRIES, _CHUNK, _CELLS = 300_000, 1 << 20, 1_000_000
#: What the vocabulary's normaliser takes as white space: the Unicode property White_Space.
_SPACE = regex.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Bytes with those of white space turned into spaces.
_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[9:14] = 32
#: Characters outside these long-settled ranges have classes and cases that differ between Unicode versions: texts with one
#: are normalised, and pieces with one are split into words, by the library itself.
_RARE = re.compile(r"[^\u0000-\u02ff\u0391-\u03a1\u03a3-\u03c9\u0400-\u045f\u2000-\u2027\u202a-\u205e\u20ac\u2190-\u22ff\u3001\u3002\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def byte_letters() -> dict[int, str]:
    """Byte -> printable letter: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    moved = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(moved)) for b in range(256)}


class Automaton:
    """The tokenization automaton of a BPE with word ends. Symbols are byte numbers, and END the word end."""

    END = 256
    _MARK = "\uffff"  # stands for the word end in a label's string: a letter that no byte maps to

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        size = max(vocab.values()) + 1
        self.shift = size.bit_length()
        self.labels = [""] * size
        for token, i in vocab.items():
            self.labels[i] = token
        self._left: dict[int, int] = {}
        self._right: dict[int, int] = {}
        self._rank: dict[int, int] = {}
        self._start_memo({})
        ids: dict[str, int] = {}
        letters = byte_letters()
        for c in letters.values():
            for shown, kept in ((c, c), (c + WORD_END, c + self._MARK)):
                if shown in vocab:
                    ids[kept] = vocab[shown]
        end = lambda s: s[: -len(WORD_END)] + self._MARK if s.endswith(WORD_END) else s
        for rank, (x, y) in enumerate(merges):
            self._gadget(ids, rank, end(x), end(y), vocab[x + y])
        symbols = {c: b for b, c in letters.items()} | {self._MARK: self.END}
        self._compile_scan({tuple(map(symbols.__getitem__, token)): i for token, i in ids.items()})

    def _start_memo(self, removed: dict[int, int]) -> None:
        self.removed = removed  # (label, arc) as one number -> rank of the gadget that took the arc away
        self._after: dict[int, tuple[tuple[int, int], ...]] = {}
        self._before: dict[int, tuple[tuple[int, int], ...]] = {}
        self._slots = np.full(1 << 20, -1, np.int64)
        self._slot_ok = np.zeros(1 << 20, bool)

    def _gadget(self, ids: dict[str, int], rank: int, a: str, b: str, w: int) -> None:
        u, v = ids.get(a), ids.get(b)
        if u is None or v is None or a + b in ids or not self.arc(u, v):
            return  # no state has the arcs, so the gadget adds none
        self.removed[u << self.shift | v] = rank
        ids[a + b] = w
        self._left[w], self._right[w], self._rank[w] = u, v, rank

    def _chain(self, label: int, step: dict[int, int], known: dict[int, tuple[tuple[int, int], ...]]) -> tuple[tuple[int, int], ...]:
        chain = known.get(label)
        if chain is None:
            found, bound, at = [], 1 << 40, label
            while True:
                found.append((at, bound))
                if at not in step:
                    break
                bound, at = self._rank[at], step[at]
            chain = known[label] = tuple(found)
        return chain

    def arc(self, last: int, label: int) -> bool:
        """Whether the state after `last` has an arc `label`."""
        heads = self._chain(label, self._left, self._before)
        for r, until in self._chain(last, self._right, self._after):
            for y, bound in heads:
                gone = self.removed.get(r << self.shift | y)
                if gone is not None and gone < until and gone <= bound:
                    return False
        return True

    def _compile_scan(self, strings: dict[tuple[int, ...], int]) -> None:
        """A scanner over the label strings: a trie with failure links, whose arcs lie in one array (that of a node's symbol at its
        base plus the symbol), and for each node the longest label that ends there and the node of the next shorter one."""
        arcs: list[dict[int, int]] = [{}]
        label, length, levels = [-1], [0], []
        for token, number in sorted(strings.items(), key=lambda x: len(x[0])):
            node = 0
            for depth, c in enumerate(token):
                to = arcs[node].get(c)
                if to is None:
                    to = arcs[node][c] = len(arcs)
                    arcs.append({})
                    label.append(-1)
                    length.append(0)
                    if depth == len(levels):
                        levels.append([])
                    levels[depth].append((to, node, c))
                node = to
            label[node], length[node] = number, len(token)
        self.label, self.length = np.array(label, np.int32), np.array(length, np.int32)
        # Bases by first fit, nodes with many arcs first; the search starts where the last long one ended, and single arcs fill the gaps.
        n = len(arcs)
        taken, free, many = bytearray(4 * n + 1024), 257, True
        self.base = np.zeros(n, np.int32)
        for node in sorted(filter(arcs.__getitem__, range(n)), key=lambda x: -len(arcs[x])):
            least, symbols = min(arcs[node]), [*arcs[node]]
            if many and len(symbols) == 1:
                many, free = False, 257
            at, tries = taken.find(0, free), 0
            while any(taken[at - least + c] for c in symbols):
                at, tries = taken.find(0, at + 1), tries + 1
            if tries > 8 or not many:
                free = at
            self.base[node] = at - least
            for c in symbols:
                taken[at - least + c] = 1
        size = taken.rfind(1) + 258
        self.owner, self.target = np.full(size, -1, np.int32), np.zeros(size, np.int32)
        self.fail, self.shorter = np.zeros(n, np.int32), np.zeros(n, np.int32)
        for level in levels:
            to, parent, symbol = np.array(level, np.int32).T
            self.fail[to] = np.where(parent > 0, self._step(self.fail[parent], symbol), 0)
            self.shorter[to] = np.where(self.label[self.fail[to]] >= 0, self.fail[to], self.shorter[self.fail[to]])
            self.owner[self.base[parent] + symbol], self.target[self.base[parent] + symbol] = parent, to

    def _step(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The next nodes: along the arc, or that of the longest suffix that has one; else the root."""
        out, open_ = np.zeros(len(node), np.int32), np.arange(len(node))
        while len(open_):
            at = self.base[node] + symbol
            ok = self.owner[at] == node
            out[open_[ok]] = self.target[at[ok]]
            on = np.flatnonzero(~ok & (node > 0))
            open_, node, symbol = open_[on], self.fail[node[on]], symbol[on]
        return out

    _ARRAYS = ("label", "length", "shorter", "base", "owner", "target", "fail")

    def save(self, file: str) -> None:
        pairs = np.array([*self.removed.items()], np.int64).reshape(-1, 2)
        merged = np.array([(w, u, self._right[w], self._rank[w]) for w, u in self._left.items()], np.int32).reshape(-1, 4)
        np.savez_compressed(file, pairs=pairs, merged=merged, labels=np.array("\n".join(self.labels).encode()), **{k: getattr(self, k) for k in self._ARRAYS})

    @classmethod
    def load(cls, file: str) -> Automaton:
        """What save wrote."""
        self = cls.__new__(cls)
        with np.load(file) as saved:
            for k in cls._ARRAYS:
                setattr(self, k, saved[k])
            merged, pairs = saved["merged"].T.tolist(), saved["pairs"]
            self.labels = bytes(saved["labels"]).decode().split("\n")
        self.shift = len(self.labels).bit_length()
        self._left, self._right, self._rank = (dict(zip(merged[0], x, strict=True)) for x in merged[1:])
        self._start_memo(dict(zip(*pairs.T.tolist(), strict=True)))
        return self

    def arcs(self, last: np.ndarray, label: np.ndarray) -> np.ndarray:
        """arc() of many pairs, by way of a table of pairs met before."""
        key = last.astype(np.int64) << self.shift | label
        slot = (key * 0x1E3779B97F4A7C15 >> 40) & ((1 << 20) - 1)
        hit = self._slots[slot] == key
        out = self._slot_ok[slot]
        if not hit.all():
            new, back = np.unique(key[~hit], return_inverse=True)
            ok = np.fromiter((self.arc(k >> self.shift, k & ((1 << self.shift) - 1)) for k in new.tolist()), bool, len(new))
            out[~hit] = ok[back]
            self._slots[slot[~hit]], self._slot_ok[slot[~hit]] = key[~hit], out[~hit]
        return out

    def walk(self, word: str) -> list[int]:
        """The labels of the accepted path over a pre-split word."""
        return self.walks([word.encode()])[0].tolist()

    def walks(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The paths of many words, one after the other, and their lengths; all words take each step together, those of like length
        in one go. Each prefix has one accepted path; its last arc follows from those of shorter prefixes, longest candidate first.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        sizes, at = sizes[order], 0
        some = [words[i] for i in order.tolist()]
        flat, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        while at < len(some):
            # As many words as keep the table of their prefixes to some cells.
            most = max(8, 2 * int(sizes[at]))
            to = min(int(np.searchsorted(sizes, most, "right")), at + max(1, _CELLS // most))
            ids, count = self._together(some[at:to], sizes[at:to] + 1)
            flat.append(ids)
            counts.append(count)
            at = to
        count = np.concatenate(counts)
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        return gather(np.concatenate(flat), (np.cumsum(count) - count)[place], count[place]), count[place]

    def _together(self, words: list[bytes], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n: their lengths with the word end, in rising order. No word holds a line feed."""
        symbol = np.frombuffer(b"\n".join(words) + b"\n", np.uint8).astype(np.int32)
        symbol[symbol == 10] = self.END
        start = np.cumsum(n) - n
        size = int(n[-1])
        last = np.full((size + 1, len(words)), -1, np.int32)
        back = np.zeros((size + 1, len(words)), np.int32)
        node = np.zeros(len(words), np.int32)
        for i in range(1, size + 1):
            first = int(np.searchsorted(n, i))  # words before it have ended
            node[first:] = self._step(node[first:], symbol[start[first:] + i - 1])
            cand = np.where(self.label[node[first:]] >= 0, node[first:], self.shorter[node[first:]])
            open_ = np.flatnonzero(cand) + first
            cand = cand[cand > 0]
            while len(open_):
                label, length = self.label[cand], self.length[cand]
                before = last[i - length, open_]
                ok = length == i
                ask = np.flatnonzero(~ok & (before >= 0))
                if len(ask):
                    ok[ask] = self.arcs(before[ask], label[ask])
                done = open_[ok]
                last[i, done], back[i, done] = label[ok], length[ok]
                cand, open_ = self.shorter[cand[~ok]], open_[~ok]
                open_, cand = open_[cand > 0], cand[cand > 0]
        every = np.arange(len(words))
        if (last[n, every] < 0).any():
            raise ValueError("the vocabulary lacks a symbol of a word")
        at, who, steps = n.copy(), every, []
        while len(who):
            steps.append((who, last[at[who], who]))
            at[who] -= back[at[who], who]
            who = who[at[who] > 0]
        count = np.bincount(np.concatenate([w for w, _ in steps]), minlength=len(words))
        end = np.cumsum(count)
        flat = np.zeros(int(end[-1]), np.uint32)
        for k, (w, labels) in enumerate(steps):
            flat[end[w] - 1 - k] = labels
        return flat, count


def gather(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs pool[start : start + size], one after the other."""
    begin = np.cumsum(size) - size
    return pool[np.repeat(start - begin, size) + np.arange(int(size.sum()))]


class Runs:
    """Numbered runs of ids by their piece, in arrays that grow."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.start, self.size, self.pool = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.uint32)
        self.used = 0

    def add(self, names: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        n = len(self.number)
        self.number.update(zip(names, range(n, n + len(names)), strict=True))
        for name, need in (("start", n + len(names)), ("size", n + len(names)), ("pool", self.used + len(ids))):
            old = getattr(self, name)
            if need > len(old):
                setattr(self, name, np.concatenate([old, np.zeros(max(need, len(old) * 3 // 2) - len(old), old.dtype)]))
        self.start[n : n + len(names)] = self.used + np.cumsum(size) - size
        self.size[n : n + len(names)] = size
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[numbers]
        return gather(self.pool, self.start[numbers], size), size


class Codec:
    """Encoder and decoder of a tokenizers file of this kind, as that library encodes without special tokens added."""

    def __init__(self, path: str, automaton: Automaton | None = None):
        spec = json.loads(Path(path).read_text())
        self.path = path
        if automaton is None:
            merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
            automaton = Automaton(spec["model"]["vocab"], merges)
        self.automaton = automaton
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        labels = automaton.labels + [""] * (max(self.special.values(), default=0) + 1 - len(automaton.labels))
        for token, i in self.special.items():
            labels[i] = token
        self.labels = pa.array(labels, pa.large_string())
        self._special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self._split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self._bytes = {ord(c): b for b, c in byte_letters().items()}
        self._runs = Runs()

    @cached_property
    def library(self):  # noqa: ANN202
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _words(self, piece: str) -> list[str]:
        """The words of a piece that is no word itself."""
        # Most are a word and a sign; the pattern parts the others.
        if piece[-1:] in _SIGNS and piece[:-1].isalpha():
            return [piece[:-1], piece[-1]]
        return self._split.findall(piece)

    def _learn(self, pieces: list[str]) -> None:
        """Add pieces to the table, by way of their words."""
        runs = self._runs
        rare = {p for p in pieces if not p.isascii() and _RARE.search(p)}
        if rare:
            parts = {p: [bytes(w.translate(self._bytes), "latin-1") for w, _ in self.library.pre_tokenizer.pre_tokenize_str(p)] for p in rare}
            ids, size = self.automaton.walks([*chain.from_iterable(parts.values())])
            owner = np.repeat(np.arange(len(parts)), [*map(len, parts.values())])
            runs.add([*parts], ids, np.bincount(owner, size, len(parts)).astype(np.int64))
        number = runs.number
        words = {p: None for p in pieces if p.isalpha() and p not in rare}
        parts = {p: self._words(p) for p in pieces if p not in words and p not in rare}
        found = [*chain.from_iterable(parts.values())]
        words.update(dict.fromkeys(found))
        new = [w for w in words if w not in number]
        if new:
            runs.add(new, *self.automaton.walks("\n".join(new).encode("utf-8", "surrogatepass").split(b"\n")))
        made = [p for p in parts if p not in number]  # a piece can be a word of its own
        if made:
            if len(made) < len(parts):
                found = [*chain.from_iterable(map(parts.__getitem__, made))]
            ids, size = runs.of(np.fromiter(map(number.__getitem__, found), np.int64, len(found)))
            owner = np.repeat(np.arange(len(made)), [len(parts[p]) for p in made])
            runs.add(made, ids, np.bincount(owner, size, len(made)).astype(np.int64))

    def _normal(self, text: str) -> str:
        """A text without special tokens, normalised; all white space as the library sees it is a space, and none is left."""
        if text.isascii():
            text = text.lower()
        elif _RARE.search(text):
            text = self.library.normalizer.normalize_str(text)
        else:
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return text if text.isascii() else _WIDE_SPACE.sub(" ", text)

    def _plain(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text: all texts are split at white space together, and each different piece is looked up once."""
        if not texts:
            return
        raw = [t.encode("utf-8", "surrogatepass") for t in map(self._normal, texts)]
        data = _BLANK[np.frombuffer(b" ".join(raw) + b" ", np.uint8)]
        ends = np.flatnonzero(data == 32).astype(np.int32) + 1
        offsets = np.concatenate([np.zeros(1, np.int32), ends])
        # A piece holds the space that ends it, so the pieces fill the buffer; two spaces in a row enclose a piece of no word.
        pieces = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        named = pieces.dictionary
        names = named.buffers()[2].to_pybytes()[: int(np.frombuffer(named.buffers()[1], np.int32)[len(named)])].decode("utf-8", "surrogatepass").split(" ")[:-1]
        runs = self._runs
        if len(runs.number) > CACHE_ENTRIES:
            kept = [x for x in names if x in runs.number]
            old, self._runs = runs, Runs()
            runs = self._runs
            runs.add(kept, *old.of(np.fromiter(map(old.number.__getitem__, kept), np.int64, len(kept))))
        look = runs.number.get
        numbers = np.array([look(x, -1) for x in names], np.int64)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            some = [names[i] for i in new.tolist()]
            self._learn(some)
            numbers[new] = [*map(runs.number.__getitem__, some)]
        ids, size = runs.of(numbers[pieces.indices.to_numpy()])
        stops = np.cumsum(np.fromiter((len(x) + 1 for x in raw), np.int64, len(raw)))
        bounds = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(ends, stops, "right")] * 4
        flat, at = ids.astype("<u4", copy=False).tobytes(), 0
        for to in bounds.tolist():
            yield flat[at:to]
            at = to

    def encode_many(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of whole texts as little-endian unsigned 32-bit numbers; nothing for null.

        Texts are taken a bounded number of characters at a time; longer ones are cut at white space, where no word goes on.
        """
        waiting: list[str] = []
        size = 0
        for text in texts:
            text = text or ""
            special = "<|" in text and self._special is not None and self._special.search(text)
            if special or len(text) > _CHUNK or size + len(text) > _CHUNK:
                yield from self._plain(waiting)
                waiting, size = [], 0
            if special:
                out, at = [], 0
                for m in self._special.finditer(text):
                    out += [*self._long(text[at : m.start()]), np.array([self.special[m[0]]], "<u4").tobytes()]
                    at = m.end()
                yield b"".join([*out, *self._long(text[at:])])
            elif len(text) > _CHUNK:
                yield b"".join(self._long(text))
            else:
                waiting.append(text)
                size += len(text)
        yield from self._plain(waiting)

    def _long(self, text: str) -> Iterator[bytes]:
        at = 0
        while at < len(text):
            space = _SPACE.search(text, at + _CHUNK) if len(text) - at > _CHUNK else None
            to = space.start() if space else len(text)
            yield from self._plain([text[at:to]])
            at = to

    def encode_bytes(self, text: str | None) -> bytes:
        return next(self.encode_many([text]))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode_many(self, raws: list[bytes]) -> pa.Array:
        """Labels joined by a space: the vocabulary file has no decoder, special tokens are kept."""
        ids = np.frombuffer(b"".join(raws), "<u4")
        offsets = np.concatenate([[0], np.cumsum(np.fromiter((len(r) // 4 for r in raws), np.int64, len(raws)))])
        return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets), self.labels.take(pa.array(ids))), pa.scalar(" ", pa.large_string()))

    def decode(self, ids: list[int]) -> str:
        return self.decode_many([np.array(ids, "<u4").tobytes()])[0].as_py()


_SHIPPED: dict[tuple[str, str], str] = {}


def ship(spark: SparkSession, path: str) -> str:
    """Compile the automaton of a file on the driver, once per application, and serve its arrays to the executors: a file's name."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _SHIPPED:
        file = os.path.join(tempfile.mkdtemp(prefix="docframe-"), f"bpe-{uuid.uuid4().hex}.npz")
        Codec(path).automaton.save(file)
        spark.sparkContext.addFile(file)
        _SHIPPED[key] = os.path.basename(file)
    return _SHIPPED[key]


def codec(path: str, file: str | None = None) -> Codec:
    """The codec of a file, which a worker holds; file: what ship gave."""
    return held(f"bpe {path}", lambda: Codec(path, Automaton.load(SparkFiles.get(file)) if file else None))


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded_sha256, with with_ids also ids array<int> and decoded.

    Null and empty texts have no ids and decode to the empty text. Repeated rows and null ids stay as they are.
    """

    file = ship(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, file)
        for batch in batches:
            at = 0
            for raws in _groups(c.encode_many(column(batch, "text").to_pylist())):
                texts = c.decode_many(raws)
                sha = [hashlib.sha256(r).hexdigest() for r in raws]
                cols = [column(batch, "doc_id").slice(at, len(raws)), pa.array([len(r) // 4 for r in raws], pa.int64()), pa.array(sha, pa.string()), pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in texts], pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols += [pa.array([np.frombuffer(r, "<u4").astype(np.int32) for r in raws], pa.list_(pa.int32())), texts.cast(pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names=names)
                at += len(raws)

    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(base, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids, f"bpe {path}")


def _groups(raws: Iterator[bytes], most: int = 4 << 20) -> Iterator[list[bytes]]:
    """Lists of neighbours of about that many bytes."""
    some, size = [], 0
    for raw in raws:
        some.append(raw)
        size += len(raw)
        if size >= most:
            yield some
            some, size = [], 0
    if some:
        yield some
