"""Operator 4, token counts with a linear longest-match automaton.

The vocabulary is a trie whose nodes carry a failure link and the number of pieces popped on taking it. Reading a word, a
node without the next letter adds its popped count and goes to its link; so the greedy longest-match length of a word comes
from one pass over its letters, and no piece is built. The vocabulary marks the first piece of a word by a leading sign, so
continuing pieces need no mark and one trie serves both. A word that no row of pieces covers counts as one unknown token.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docframe.llm.common import arrow_map, column, held

VOCABULARY = "piece_bpe_32k.model"
WORD_START = "▁"
CACHE_ENTRIES = 500_000


class LongestMatch:
    """Counts of greedy longest-match pieces. counts[word] is negative if the word is unknown."""

    def __init__(self, pieces: Iterable[str], word_start: str = WORD_START):
        self.word_start = word_start
        self.pieces = {p for p in pieces if p}
        goto: dict[int, int] = {}
        nodes = [(0, 0)]  # parent and letter, parents first
        depth_first = sorted(self.pieces, key=lambda p: (len(p), p))
        ends: set[int] = set()
        for piece in depth_first:
            node = 0
            for letter in map(ord, piece):
                to = goto.get(node << 21 | letter)
                if to is None:
                    to = goto[node << 21 | letter] = len(nodes)
                    nodes.append((node, letter))
                node = to
            ends.add(node)
        depth = [0] * len(nodes)
        for node, (parent, _) in enumerate(nodes[1:], 1):
            depth[node] = depth[parent] + 1
        link, popped = [-1] * len(nodes), [0] * len(nodes)
        for node in sorted(range(1, len(nodes)), key=depth.__getitem__):
            parent, letter = nodes[node]
            if node in ends:
                link[node], popped[node] = 0, 1
                continue
            at, count = link[parent], popped[parent]
            while at >= 0 and at << 21 | letter not in goto:
                count += popped[at]
                at = link[at]
            if at >= 0:
                link[node], popped[node] = goto[at << 21 | letter], count
        self._goto, self._link, self._popped = goto, link, popped

    def count(self, word: str) -> int:
        """Pieces of a word, -1 if it is unknown, 0 for the empty word."""
        if not word:
            return 0
        goto, link, popped = self._goto, self._link, self._popped
        node, total = 0, 0
        for letter in map(ord, self.word_start + word):
            to = goto.get(node << 21 | letter)
            while to is None:
                total += popped[node]
                node = link[node]
                if node < 0:
                    return -1
                to = goto.get(node << 21 | letter)
            node = to
        while node:
            total += popped[node]
            node = link[node]
            if node < 0:
                return -1
        return total

    def pieces_of(self, word: str) -> list[str] | None:
        """The same by trying ever shorter prefixes; for tests."""
        text, at, out = self.word_start + word if word else "", 0, []
        while at < len(text):
            to = next((j for j in range(len(text), at, -1) if text[at:j] in self.pieces), 0)
            if not to:
                return None
            out.append(text[at:to])
            at = to
        return out


class _Counts(dict):
    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        n = self[word] = self.automaton.count(word)
        return n


def vocabulary(path: str) -> list[str]:
    """The pieces of a vocabulary file: a model of pieces, or a text file of one piece a line."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        return [model.id_to_piece(i) for i in plain]
    with open(path, encoding="utf-8") as lines:
        return [line.rstrip("\n") for line in lines]


def load(path: str) -> _Counts:
    """The counts of a vocabulary file, which a worker holds."""
    return held(f"pieces {path}", lambda: _Counts(LongestMatch(vocabulary(path))))


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_tokens, n_unknown of the whole text.

    Words are split at white space; a word that the vocabulary cannot cover is one token and one unknown. Null and empty
    texts count zero. Repeated rows and null ids stay as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = load(path)
        for batch in batches:
            words_n, tokens, unknown = [], [], []
            for t in column(batch, "text"):
                words = (t.as_py() or "").split()
                each = list(map(counts.__getitem__, words))
                lost = each.count(-1)
                words_n.append(len(words))
                tokens.append(sum(each) + 2 * lost)
                unknown.append(lost)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), *(pa.array(x, pa.int64()) for x in (words_n, tokens, unknown))], names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(base, run, "doc_id long, n_words long, n_tokens long, n_unknown long", f"pieces {path}")
