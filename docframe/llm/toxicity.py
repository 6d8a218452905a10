"""Operator 6, toxicity by gradient-boosted trees over dense features, with isotonic calibration.

From a bounded sample of labelled rows come a lexicon (words and word beginnings that stand in toxic texts far more often
than in others; each row is measured by the terms of other rows), the boosted trees, and, from rows of its own, the calibration. The features are densities of
the lexicon, nearness to second persons, capitals, punctuation and obfuscation rates of the whole text; nothing else goes in.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.llm.common import arrow_map, column, materialize

#: At most so many labelled rows are used, those with the smallest hashed ids.
MAX_LABELLED = 20_000
#: A term stands in so many toxic rows and in such a share of all toxic rows at least, so that there are few terms at every size;
#: and such a share of the rows with it is toxic.
MIN_TOXIC, TERM_SHARE, MIN_SHARE, PREFIXES = 3, 0.002, 0.7, (4, 5, 6, 7)
#: The sample's parts: the last calibrates, the others grow the trees.
PARTS = 4
#: Plain insults, beside what the labels teach.
INSULTS = frozenset("idiot idiots moron morons stupid trash garbage loser losers scum pathetic disgusting clown clowns worthless dumb fool fools imbecile jerk filth vermin".split())
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine deinen euch euer tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros tuyo".split())
_WORD = re.compile(r"[^\W\d_]+")
_OBFUSCATED = re.compile(r"(?<![^\W\d_])[^\W\d_]++[0-9@$*!|+][^\W\d_]+|\b(?:[^\W\d_][.\-_* ]){3,}[^\W\d_]\b", re.U)
_LEET = str.maketrans("013457@$!|+", "oieastasiit")
_STRETCHED = re.compile(r"(\w)\1{2,}")
_NEAR = 5

FEATURES = (
    "log_words", "insults", "terms", "beginnings", "log_hits", "hit_share", "weight", "top_weight", "hit_kinds", "near_second", "second",
    "capitals", "shouted", "exclaims", "questions", "punctuation", "symbols", "digits", "obfuscated", "obfuscated_hits", "stretched", "word_length",
)


class Lexicon:
    """Weights of terms: log odds of standing in a toxic text. A word's weight is that of its own term or best beginning."""

    def __init__(self, terms: dict[str, float]):
        self.words = {t[1:]: w for t, w in terms.items() if t[0] == "="}
        self.starts = {t[1:]: w for t, w in terms.items() if t[0] == "^"}
        self.known: dict[str, tuple[float, bool, bool, bool]] = {}

    def look(self, word: str) -> tuple[float, bool, bool, bool]:
        """Weight, and whether it is an insult, a term, or has a known beginning."""
        found = self.known.get(word)
        if found is None:
            own = self.words.get(word, 0.0)
            size, starts, start = len(word), self.starts, 0.0
            for n in PREFIXES:
                if n > size:
                    break
                start = max(start, starts.get(word[:n], 0.0))
            found = (max(own, start, 1.0 if word in INSULTS else 0.0), word in INSULTS, own > 0, start > 0)
            if len(self.known) > 300_000:
                self.known.clear()
            self.known[word] = found
        return found


def terms_of(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return {"=" + w for w in words if len(w) <= 40} | {"^" + w[:n] for w in words for n in PREFIXES if len(w) >= n}


def _changed(text: str, lower: str) -> int:
    """Letters that lower-casing changes."""
    if len(text) != len(lower):
        return sum(c != c.lower() for c in text)
    return int((np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4") != np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), "<u4")).sum())


def feature_row(text: str | None, lexicon: Lexicon) -> list[float]:
    """FEATURES of a whole text; zeros for a text without words."""
    text = text or ""
    lower = text.lower()
    words = _WORD.findall(lower)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = Counter(words)
    known = lexicon.known
    hits = {w: found for w in counts if (found := known.get(w) or lexicon.look(w))[0] > 0}
    total = sum(counts[w] for w in hits)
    near = 0
    second = sum(c for w, c in counts.items() if w in SECOND_PERSON)
    if hits and second:
        last = -_NEAR - 1
        waiting: list[int] = []
        for i, w in enumerate(words):
            if w in SECOND_PERSON:
                near += sum(i - j <= _NEAR for j in waiting)
                waiting, last = [], i
            elif w in hits:
                if i - last <= _NEAR:
                    near += 1
                else:
                    waiting.append(i)
    size = len(text)
    odd = _OBFUSCATED.findall(text) if re.search(r"[0-9@$*!|+.\-_]", text) else []
    undone = [_WORD.findall(_STRETCHED.sub(r"\1", re.sub(r"[.\-_* ]", "", w.lower()).translate(_LEET))) for w in odd]
    letters = sum(map(len, words))
    upper = _changed(text, lower)
    shouted = len(re.findall(r"\b[^\W\d_a-z]{3,}\b", text)) if upper * 20 > letters else 0
    return [
        math.log1p(n),
        sum(counts[w] for w, f in hits.items() if f[1]) / n,
        sum(counts[w] for w, f in hits.items() if f[2]) / n,
        sum(counts[w] for w, f in hits.items() if f[3]) / n,
        math.log1p(total),
        total / n,
        sum(counts[w] * f[0] for w, f in hits.items()) / n,
        max((f[0] for f in hits.values()), default=0.0),
        float(len(hits)),
        near / n,
        second / n,
        upper / letters,
        shouted / n,
        text.count("!") / n,
        text.count("?") / n,
        sum(map(text.count, ".,;:")) / n,
        sum(map(text.count, "#*$%&|<>@")) / size,
        sum(map(text.count, "0123456789")) / size,
        len(odd) / n,
        sum(lexicon.look(w)[0] > 0 for found in undone for w in found) / n,
        len(_STRETCHED.findall(text)) / n,
        letters / n,
    ]


class Boosted:
    """Logistic gradient boosting of small trees over binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48, least: int = 8, ridge: float = 1.0):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
        b = self._bin(x)
        share = min(max(y.mean() if len(y) else 0.0, 1e-3), 1 - 1e-3)
        self.base = math.log(share / (1 - share))
        raw = np.full(len(y), self.base)
        self.rate, self.trees = rate, []
        if not 0 < y.sum() < len(y):
            return
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-raw))
            tree = self._grow(b, y - p, p * (1 - p), np.arange(len(y)), depth, least, ridge)
            self.trees.append(tree)
            raw += rate * self._apply(tree, b)

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, c, side="right") for e, c in zip(self.edges, x.T, strict=True)]) if x.shape[1] else x

    def _grow(self, b: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int, least: int, ridge: float) -> tuple:
        value = g[rows].sum() / (h[rows].sum() + ridge)
        best = (1e-6, -1, -1)
        if depth and len(rows) >= 2 * least:
            whole = g[rows].sum() ** 2 / (h[rows].sum() + ridge)
            for f in range(b.shape[1]):
                size = len(self.edges[f]) + 1
                if size < 2:
                    continue
                at = b[rows, f]
                gs, hs, ns = (np.cumsum(np.bincount(at, w, size))[:-1] for w in (g[rows], h[rows], None))
                gain = gs**2 / (hs + ridge) + (gs[-1] + g[rows][at == size - 1].sum() - gs) ** 2 / (h[rows].sum() - hs + ridge) - whole
                gain[(ns < least) | (len(rows) - ns < least)] = 0
                k = int(gain.argmax())
                if gain[k] > best[0] + 1e-12:
                    best = (float(gain[k]), f, k)
        if best[1] < 0:
            return (value,)
        left = b[rows, best[1]] <= best[2]
        return (best[1], best[2], self._grow(b, g, h, rows[left], depth - 1, least, ridge), self._grow(b, g, h, rows[~left], depth - 1, least, ridge))

    def _apply(self, tree: tuple, b: np.ndarray) -> np.ndarray:
        if len(tree) == 1:
            return np.full(len(b), tree[0])
        return np.where(b[:, tree[0]] <= tree[1], self._apply(tree[2], b), self._apply(tree[3], b))

    def predict(self, x: np.ndarray) -> np.ndarray:
        b = self._bin(x)
        return 1 / (1 + np.exp(-(self.base + self.rate * sum((self._apply(t, b) for t in self.trees), np.zeros(len(x))))))


def isotonic(p: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising step fit of y over p, by pooling neighbours that break the order; one virtual row of each label at
    the ends keeps scores off 0 and 1."""
    order = np.argsort(p, kind="stable")
    pools: list[list[float]] = []
    for x, v in [(0.0, 0.0), *zip(p[order].tolist(), y[order].astype(float).tolist(), strict=True), (1.0, 1.0)]:
        pools.append([v, 1.0, x, x])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v2, n2, _, b2 = pools.pop()
            v1, n1, a1, _ = pools.pop()
            pools.append([(v1 * n1 + v2 * n2) / (n1 + n2), n1 + n2, a1, b2])
    xs = np.array([x for pool in pools for x in (pool[2], pool[3])])
    ys = np.array([pool[0] for pool in pools for _ in range(2)])
    return xs, ys


def fold(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)).cast("int")


class Model:
    """Lexicon, trees and calibration."""

    def __init__(self, lexicon: dict[str, float], x: np.ndarray, y: np.ndarray, calibrate: np.ndarray):
        self.terms = lexicon
        self.trees = Boosted(x[~calibrate], y[~calibrate])
        cal = calibrate if 0 < y[calibrate].sum() < calibrate.sum() else np.ones(len(y), bool)
        self.knots = isotonic(self.trees.predict(x[cal]), y[cal]) if 0 < y.sum() < len(y) else None

    def score(self, x: np.ndarray) -> np.ndarray:
        p = self.trees.predict(x)
        if self.knots is None:
            return p
        # A small share of the raw score keeps the order within a calibrated step.
        return np.clip(0.999 * np.interp(p, *self.knots) + 0.001 * p, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED) -> Model:
    """Learn from labelled rows whose fold is not 0. A repeated id counts as toxic if any of its labels is, and once, with one of its texts by
    their hashes. Null ids and labels teach nothing, null and empty texts are texts without terms; without labelled rows, or with those of
    one label alone, all scores are the share of toxic rows. Other columns are ignored."""
    known = labels.select(F.col(id_col).cast("long").alias("lid"), F.col("toxic").cast("int").alias("y")).filter("lid is not null and y is not null and y in (0, 1)")
    known = known.groupBy("lid").agg(F.max("y").alias("y")).filter(fold("lid") != 0)
    sample = known.orderBy(F.xxhash64("lid"), "lid").limit(max_labelled)
    # max_labelled rows of two numbers at most.
    texts = docs.select(F.col(id_col).cast("long").alias("lid"), F.col(text_col).alias("text")).join(F.broadcast(sample), "lid")
    # However often an id stands in docs, one row of it reaches the driver.
    texts = texts.groupBy("lid", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    # The sampled texts are written once, so that documents are read once for them.
    texts = materialize(texts.withColumn("part", F.pmod(F.xxhash64(F.col("lid"), F.lit(6)), F.lit(PARTS)).cast("int")), "labelled")
    least = max(MIN_TOXIC, TERM_SHARE * texts.filter("y = 1").count())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}
        for batch in batches:
            for t, y, part in zip(column(batch, "text"), column(batch, "y").to_pylist(), column(batch, "part").to_pylist(), strict=True):
                for term in terms_of(t.as_py() or ""):
                    seen.setdefault(term, [0] * (2 * PARTS))[2 * part + y] += 1
        terms = [*seen]
        for i in range(0, len(terms), 1 << 16):
            some = terms[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), *(pa.array([seen[t][j] for t in some], pa.int64()) for j in range(2 * PARTS))], names=["term", *(f"n{j}" for j in range(2 * PARTS))])

    names = [f"n{j}" for j in range(2 * PARTS)]
    counted = arrow_map(texts.select("text", "y", "part"), count, "term string, " + ", ".join(f"{n} long" for n in names)).groupBy("term").agg(*(F.sum(n).alias(n) for n in names))
    toxic, clean = (sum((F.col(n) for n in names[j::2]), F.lit(0)) for j in (1, 0))
    share = (toxic + 0.1) / (toxic + clean + 1.0)
    chosen = sorted(counted.filter((toxic >= least) & (share >= MIN_SHARE)).collect(), key=lambda r: r["term"])

    def lexicon_without(part: int | None) -> dict[str, float]:
        out = {}
        for r in chosen:
            t, c = (sum(r[f"n{2 * p + y}"] for p in range(PARTS) if p != part) for y in (1, 0))
            if t >= MIN_TOXIC and (t + 0.1) / (t + c + 1.0) >= MIN_SHARE:
                out[r["term"]] = math.log((t + 0.5) / (c + 0.5)) + 0.1
        return out

    # A row is measured by the terms of the other parts, as a new text would be.
    others = [lexicon_without(p) for p in range(PARTS)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexica = [Lexicon(terms) for terms in others]
        for batch in batches:
            rows = [feature_row(t.as_py(), lexica[p]) for t, p in zip(column(batch, "text"), column(batch, "part").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([column(batch, "lid"), column(batch, "y"), column(batch, "part"), pa.array(rows, pa.list_(pa.float64()))], names=["lid", "y", "part", "x"])

    rows = arrow_map(texts.select("lid", "y", "part", "text"), measure, "lid long, y int, part int, x array<double>").collect()
    rows.sort(key=lambda r: (r["lid"], r["part"], r["x"]))  # at most max_labelled rows
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), len(FEATURES))
    return Model(lexicon_without(None), x, np.array([r["y"] for r in rows], int), np.array([r["part"] == PARTS - 1 for r in rows], bool))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted. Null texts count as empty; a null id is in no fold and not
    held out; repeated rows are scored alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.terms)
        for batch in batches:
            x = np.array([feature_row(t.as_py(), lexicon) for t in column(batch, "text")], float).reshape(batch.num_rows, len(FEATURES))
            s = model.score(x)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), column(batch, "held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(fold(id_col) == 0, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return arrow_map(base, run, "doc_id long, held_out boolean, score double, predicted int")
