"""Greedy word-piece lengths from a trie with failure links, without building the pieces.

A word-piece vocabulary has two kinds of pieces: those that start a word and those that continue one. Greedy longest match takes the longest starting
piece, then the longest continuing piece at each further position. The trie therefore has two roots; failure links lead into the one of
continuing pieces. The automaton reads a word once: where the trie has no edge for the next byte, the node's failure link leads to the state in which greedy
matching would stand after emitting its pieces, and the number of pieces emitted on the way is known beforehand.
"""

from __future__ import annotations

from collections import Counter, deque
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame

from spindrift.llm.bpe import TOKENIZER, vocabulary
from spindrift.llm.rows import add_columns, words_of

COLUMNS = "n_words long, n_pieces long, longest_word_pieces long"
_REMEMBERED = 400_000


class PieceCounter:
    """Counts the pieces of a word; both kinds are extended by every single byte, so that each word has pieces.

    Tokens that begin with the mark start a word (the mark is no part of the piece), those that hold none continue one.
    """

    def __init__(self, tokens: set[bytes], mark: bytes = b" "):
        self.next: dict[int, int] = {}
        whole = [False, False]  # the roots of starting and of continuing pieces
        edges: list[list[tuple[int, int]]] = [[], []]
        single = {bytes([b]) for b in range(256)}
        starting = {t.removeprefix(mark) for t in tokens if t.startswith(mark)} | single
        continuing = {t for t in tokens if not t.startswith(mark)} | single
        for root, token in [(0, t) for t in sorted(starting)] + [(1, t) for t in sorted(continuing)]:
            if not token:
                continue
            node = root
            for byte in token:
                key = node << 8 | byte
                if key not in self.next:
                    self.next[key] = len(whole)
                    edges[node].append((byte, len(whole)))
                    whole.append(False)
                    edges.append([])
                node = self.next[key]
            whole[node] = True
        self._link(whole, edges)
        self.seen: dict[bytes, int] = {}

    def _link(self, whole: list[bool], edges: list[list[tuple[int, int]]]) -> None:
        """Failure link, pieces popped on it, and pieces left when a word ends, for every node by depth."""
        self.fail, self.pops, self.left = [1] * len(whole), [0] * len(whole), [0] * len(whole)
        queue = deque([0, 1])
        while queue:
            node = queue.popleft()
            for byte, child in edges[node]:
                if whole[child]:
                    self.pops[child] = 1
                else:
                    state, popped = self.fail[node], self.pops[node]
                    while (step := self.next.get(state << 8 | byte)) is None:
                        popped += self.pops[state]
                        state = self.fail[state]
                    self.fail[child], self.pops[child] = step, popped
                self.left[child] = self.pops[child] + self.left[self.fail[child]]
                queue.append(child)

    def count(self, word: bytes) -> int:
        state, pieces = 0, 0
        follow, fail, pops = self.next.get, self.fail, self.pops
        for byte in word:
            while (step := follow(state << 8 | byte)) is None:
                pieces += pops[state]
                state = fail[state]
            state = step
        return pieces + self.left[state]

    def of_text(self, text: str) -> tuple[int, int, int]:
        """Words, pieces, and the pieces of the word with most of them."""
        words = words_of(text)
        total, most = 0, 0
        for word, times in Counter(words).items():
            pieces = self.seen.get(word)
            if pieces is None:
                pieces = self.count(word)
                if len(word) <= 40:
                    if len(self.seen) >= _REMEMBERED:
                        self.seen.clear()
                    self.seen[word] = pieces
            total += pieces * times
            most = max(most, pieces)
        return len(words), total, most


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(set(vocabulary(path)[0]))


def _count(path: str):
    own = counter(path)

    def work(texts: list[str | None]) -> list[pa.Array]:
        rows = [own.of_text(t or "") for t in texts]
        return [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]

    return work


def token_counts(df: DataFrame, text: str = "text", path: str = TOKENIZER) -> DataFrame:
    """``df`` without its text, with n_words, n_pieces and the pieces of its longest-cut word.

    Words are the runs without U+0020 and U+0009 to U+000D, read as bytes. A null text counts as empty: all three are 0. Texts of any length
    are counted whole, repeated rows give equal results, an empty table gives an empty one, columns named like a new one
    are replaced.
    """
    return add_columns(df, text, COLUMNS, partial(_count, path), drop=(text,))
