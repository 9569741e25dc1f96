"""Byte-level BPE by a backtracking encoder, decoding by an offset table.

Merging pairs by rank gives, for any text, the one token sequence in which every two neighbours are
*compatible*: encoding their joined bytes gives the two back. The encoder therefore never merges. It takes
the longest token at a position (all matches of a piece come from one Aho-Corasick pass), checks it against the token before it,
falls back to the next shorter token that is a prefix, and steps back one token when none fits. A position that failed
once is never ended at again, so work is linear in the piece.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from functools import lru_cache, partial

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from spindrift.llm.rows import add_columns, public_file

TOKENIZER = "byte_bpe_50k.json"
#: Fixed value: the piece pattern of byte-level BPE, its character classes left open.
PIECE = r"""'s|'t|'re|'ve|'m|'ll|'d| ?%(letter)s+| ?%(number)s+| ?%(other)s+|\s+(?!\S)|\s+"""
COLUMNS = "n_tokens long, ids array<int>, exact boolean"
DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"
#: The most pieces, and the most pairs, that a worker remembers: about 90 MB in all.
_REMEMBERED = 300_000


def byte_letters() -> dict[str, int]:
    """The printable letters that stand for the 256 bytes in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def vocabulary(path: str) -> tuple[dict[bytes, int], dict]:
    """Token bytes to id of a tokenizer file, and the file's content."""
    with open(public_file(path), encoding="utf-8") as file:
        content = json.load(file)
    letters = byte_letters()
    return {bytes(letters[c] for c in token): i for token, i in content["model"]["vocab"].items()}, content


class _Pairs(dict):
    """The table of compatible pairs, filled as pairs are met; emptied when it holds ``_REMEMBERED`` of them."""

    def __init__(self, compatible):
        super().__init__()
        self.compatible = compatible

    def __missing__(self, pair: tuple[int, int]) -> bool:
        if len(self) >= _REMEMBERED:
            self.clear()
        found = self[pair] = self.compatible(*pair)
        return found


class Codec:
    """Encoder and decoder of one byte-level tokenizer file without normalisation and prefix space."""

    def __init__(self, path: str):
        self.ids, content = vocabulary(path)
        split = content["pre_tokenizer"]
        if content["normalizer"] or content["post_processor"] or split["type"] != "ByteLevel" or split["add_prefix_space"]:
            raise ValueError(f"{path}: only plain byte-level tokenizers are supported")
        special = content["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in special):
            raise ValueError(f"{path}: special tokens with stripping, word bounds or normalisation are not supported")
        self.special = {t["content"]: t["id"] for t in special}
        marks = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self._pairs(content["model"]["merges"])
        self._matcher()
        self._offsets()
        self._patterns()
        self.seen: dict[str, bytes] = {}
        self.fits = _Pairs(self.compatible)

    def _pairs(self, merges: list) -> None:
        """Rank of each pair that merges, and of each token the pair that makes it."""
        letters = byte_letters()
        self.rank, self.parts, self.made_at = {}, {}, {i: -1 for i in self.ids.values()}
        for rank, merge in enumerate(merges):
            left, right = (bytes(letters[c] for c in part) for part in (merge.split(" ") if isinstance(merge, str) else merge))
            pair, whole = (self.ids[left], self.ids[right]), self.ids[left + right]
            self.rank.setdefault(pair, rank)
            if whole not in self.parts:
                self.parts[whole], self.made_at[whole] = pair, rank

    def _matcher(self) -> None:
        self.automaton = ahocorasick.Automaton()
        self.shorter: dict[int, int] = {}
        self.length = {i: len(token) for token, i in self.ids.items()}
        for token, i in self.ids.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token) - 1, i))
            for end in range(len(token) - 1, 0, -1):
                if (prefix := self.ids.get(token[:end])) is not None:
                    self.shorter[i] = prefix
                    break
        self.automaton.make_automaton()

    def _offsets(self) -> None:
        """All token bytes in one array; token i stands at offsets[i]:offsets[i + 1]."""
        tokens = {i: token for token, i in self.ids.items()} | {i: text.encode() for text, i in self.special.items()}
        ordered = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.sizes = np.array([len(t) for t in ordered], dtype=np.int64)
        self.offsets = np.concatenate(([0], np.cumsum(self.sizes)))
        self.bytes = np.frombuffer(b"".join(ordered), dtype=np.uint8)
        self.decimal = list(map(str, range(len(ordered))))

    def _patterns(self) -> None:
        """Pieces as the tokenizer library cuts them: characters newer than its Unicode tables are no letters or numbers."""
        known = regex.compile(r"[\p{L}\p{N}]")
        newer = [c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn" and known.match(chr(c))]
        starts = [c for i, c in enumerate(newer) if not i or newer[i - 1] != c - 1]
        ends = [c for i, c in enumerate(newer) if i + 1 == len(newer) or newer[i + 1] != c + 1]
        odd = "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends)) + "]" if newer else r"(?!)"
        self.newer = regex.compile(odd)
        self.late = re.compile(f"[{chr(min(newer, default=0x10FFFF))}-\U0010ffff]")
        self.pieces = regex.compile(PIECE % {"letter": r"\p{L}", "number": r"\p{N}", "other": r"[^\s\p{L}\p{N}]"})
        self.careful = regex.compile(PIECE % {
            "letter": rf"(?:(?!{odd})\p{{L}})", "number": rf"(?:(?!{odd})\p{{N}})", "other": rf"(?:[^\s\p{{L}}\p{{N}}]|{odd})",
        })

    def compatible(self, left: int, right: int) -> bool:
        """Whether encoding the two tokens' joined bytes gives just these two.

        Goes back in merge order: the later made of the two is taken apart at the seam. A pair across the seam merges
        if its rank comes before the merge that ended it; of equal ranks the one further left comes first.
        """
        until = len(self.rank) + 1
        while True:
            if self.rank.get((left, right), until) < until:
                return False
            if self.made_at[left] < 0 and self.made_at[right] < 0:
                return True
            if self.made_at[left] > self.made_at[right]:
                until, left = self.made_at[left], self.parts[left][1]
            else:
                until, right = self.made_at[right] + 1, self.parts[right][0]

    def encode_piece(self, piece: bytes) -> list[int]:
        letters = piece.decode("latin-1")
        fits, before, tokens = self.fits, -1, []
        for _, (_, token) in self.automaton.iter_long(letters):  # the longest match at 0, then at its end, and so on
            if before >= 0 and not fits[before, token]:
                return self._backtracked(letters)
            tokens.append(token)
            before = token
        return tokens

    def _backtracked(self, letters: str) -> list[int]:
        size = len(letters)
        longest = [-1] * (size + 1)
        for last, (more, token) in self.automaton.iter(letters):
            longest[last - more] = token  # matches come by their end, so the last one of a start is its longest
        failed: set[int] = set()
        tokens: list[int] = []
        length, shorter, fits = self.length, self.shorter, self.fits
        at, token, before = 0, longest[0], -1
        while at < size:
            end = at + length[token]
            if end not in failed and (before < 0 or fits[before, token]):
                tokens.append(token)
                at, before, token = end, token, longest[end]
            elif token in shorter:
                token = shorter[token]
            else:
                failed.add(at)
                token = tokens.pop()
                at -= length[token]
                before = tokens[-1] if tokens else -1
        return tokens

    def _remember(self, piece: str) -> bytes:
        found = array("I", self.encode_piece(piece.encode())).tobytes()
        if len(piece) <= 40:
            if len(self.seen) >= _REMEMBERED:
                self.seen.clear()
            self.seen[piece] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        """Ids of the text as 32-bit numbers, found piece by piece."""
        out, get, add = [], self.seen.get, self._remember
        for part in self.marks.split(text) if self.marks and self.marks.search(text) else [text]:
            if part in self.special:
                out.append(np.uint32(self.special[part]).tobytes())
                continue
            odd = not part.isascii() and self.late.search(part) and self.newer.search(part)
            out.extend([get(p) or add(p) for p in (self.careful if odd else self.pieces).findall(part)])
        return np.frombuffer(b"".join(out), dtype=np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids: one gather by the offset table."""
        tokens = np.asarray(ids, dtype=np.int64)
        sizes = self.sizes[tokens]
        ends = np.cumsum(sizes)
        at = np.repeat(self.offsets[tokens] - (ends - sizes), sizes)
        return self.bytes[at + np.arange(len(at))].tobytes()

    def digest(self, text: str) -> tuple[int, str, str]:
        ids = self.encode(text)
        back = self.decode(ids).decode("utf-8", "replace").encode()
        written = ",".join(map(self.decimal.__getitem__, ids.tolist())).encode()
        return len(ids), hashlib.sha256(written).hexdigest(), hashlib.sha256(back).hexdigest()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _encode(path: str):
    own = codec(path)

    def work(texts: list[str | None]) -> list[pa.Array]:
        ids = [own.encode(t or "") for t in texts]
        exact = [own.decode(i) == (t or "").encode() for i, t in zip(ids, texts)]
        sizes = np.array([len(i) for i in ids], dtype=np.int64)
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        flat = np.concatenate([*ids, np.empty(0, np.uint32)]).astype(np.int32)
        return [pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(exact, pa.bool_())]

    return work


def _decode(path: str):
    own = codec(path)

    def work(rows: list[list[int] | None]) -> list[pa.Array]:
        return [pa.array([own.decode(r or []).decode("utf-8", "replace") for r in rows], pa.string())]

    return work


def _digest(path: str):
    own = codec(path)

    def work(texts: list[str | None]) -> list[pa.Array]:
        rows = [own.digest(t or "") for t in texts]
        return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.string()))]

    return work


def encode(df: DataFrame, text: str = "text", path: str = TOKENIZER) -> DataFrame:
    """``df`` with n_tokens, ids, and whether decoding the ids gives the text back (exact).

    A null text counts as empty and has no ids. Texts of any length are encoded whole; rows are independent, so
    repeated rows give equal results; an empty table gives an empty one. Columns named like a new one are replaced.
    """
    return add_columns(df, text, COLUMNS, partial(_encode, path))


def decode(df: DataFrame, ids: str = "ids", path: str = TOKENIZER) -> DataFrame:
    """``df`` with the text decoded from its ids; no ids or null give an empty text, bytes that are no UTF-8 become U+FFFD."""
    return add_columns(df, ids, "decoded string", partial(_decode, path))


def encoding_digests(df: DataFrame, text: str = "text", path: str = TOKENIZER) -> DataFrame:
    """n_tokens and the SHA-256 digests of the ids (decimal, joined by commas) and of the decoded text; the text itself is left out.

    Nulls, repeated rows, empty tables and clashing names as in ``encode``.
    """
    return add_columns(df, text, DIGESTS, partial(_digest, path), drop=(text,))
