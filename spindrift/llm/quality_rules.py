"""Line-first cleaning: lines are judged one by one, failed ones go, then texts that lost too much are rejected."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spindrift.llm.rows import SPACE, add_columns

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
VERDICT = "n_lines long, n_failed_lines long, lost_words long, reason string, kept boolean"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
#: A text goes if its failed lines hold more than this share of its words.
MAX_LOST = 0.5

SYMBOLS = b"#*$%&|<>"
SENTENCE_ENDS = (".", "!", "?", "…", ":", ";", '"', "'", "”", "’", "»", ")", "]", "。", "！", "？", "।", "؟", "۔")
BOILERPLATE = re.compile(
    r"all rights reserved|terms of (?:use|service)|privacy policy|cookie policy|(?:use|uses|accept) cookies|enable javascript"
    r"|lorem ipsum|click here|sign up for|subscribe to (?:our|the) |licensed under|skip to (?:main )?content|copyright ©|© ?\d{4}",
    re.IGNORECASE,
)
#: Scripts written without spaces between words: Han, Kana, Thai, Lao, Myanmar, Khmer and their neighbours.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u2fdf\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
#: Letters of such a script that make about a word.
LETTERS_A_WORD = 3
SEPARATORS = re.compile(r"[|»›•]|(?<=\s)[>/·](?=\s)")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more in the text."""
    if len(words) <= window:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    # Number the windows by doubling: equal numbers mean equal words, without any hash.
    size, codes = 1, ids
    while size < window:
        step = min(size, window - size)
        pairs = codes[: len(codes) - step] * (codes.max() + 1) + codes[step:]
        codes = np.unique(pairs, return_inverse=True)[1]
        size += step
    counts = np.bincount(codes)
    at = np.flatnonzero(counts[codes] > 1)
    if not len(at):
        return 0
    marks = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(marks, at, 1)
    np.add.at(marks, at + window, -1)
    return int(np.count_nonzero(np.cumsum(marks[:-1])))


def measure(text: str) -> tuple[int, int, int, int, int, bool]:
    raw = text.encode()
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, SPACE))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip(SPACE)]
    repeated = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * len(words)
    return len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeated, failed


@lru_cache(maxsize=4096)
def is_letter(character: str) -> bool:
    """Letters and the marks that belong to them (vowel signs, accents)."""
    return unicodedata.category(character)[0] in "LM"


def line_fault(line: str) -> str | None:
    """The first rule that a line with words fails.

    Rules on words take the letters of scripts without spaces for a word each ``LETTERS_A_WORD``, so that a line of those is not one word.
    """
    n_words = len(line.split())
    if not line.isascii():
        n_words = max(n_words, len(UNSPACED.findall(line)) // LETTERS_A_WORD)
    solid = len(line) - line.count(" ")
    letters = sum(map(str.isalpha, line))
    if 2 * letters < solid and not line.isascii():
        letters = sum(map(is_letter, line))
    if 2 * letters < solid:
        return "few letters"
    if 10 * sum(map(line.count, "#*$%&|<>")) > solid:
        return "symbols"
    if n_words >= 4 and 4 * len(SEPARATORS.findall(line)) >= n_words:
        return "navigation"
    if n_words <= 30 and BOILERPLATE.search(line):
        return "boilerplate"
    if n_words >= 4 and line.isupper():
        return "capitals"
    if n_words < 3 and not line.endswith(SENTENCE_ENDS):
        return "no sentence"
    return None


def clean(text: str) -> tuple[str, int, int, int, str | None]:
    """The text without its failed lines, lines with words, failed ones, words lost, and the most costly rule."""
    passed, lost_by, n_lines, n_failed = [], {}, 0, 0
    for line in text.split("\n"):
        body = line.strip(" \t\n\r\x0b\x0c")
        fault = line_fault(body) if body else None
        n_lines += bool(body)
        if fault is None:
            passed.append(line)
        else:
            n_failed += 1
            lost_by[fault] = lost_by.get(fault, 0) + len(body.encode().split())
    worst = max(sorted(lost_by), key=lost_by.get, default=None)
    return "\n".join(passed), n_lines, n_failed, sum(lost_by.values()), worst


def _judge(with_text: bool, max_lost: float):
    def work(texts: list[str | None]) -> list[pa.Array]:
        base, rest, cleaned = [], [], []
        for text in texts:
            counts = measure(text or "")
            left, n_lines, n_failed, lost, worst = clean(text or "")
            too_much = lost > max_lost * counts[0]
            reason = "base" if counts[5] else worst if too_much else None
            base.append(counts)
            rest.append((n_lines, n_failed, lost, reason, not counts[5] and not too_much))
            cleaned.append(left)
        kinds = [pa.int64()] * 5 + [pa.bool_()]
        out = [pa.array([r[i] for r in base], k) for i, k in enumerate(kinds)]
        out += [pa.array([r[i] for r in rest], k) for i, k in enumerate([pa.int64()] * 3 + [pa.string(), pa.bool_()])]
        return out + ([pa.array(cleaned, pa.string())] if with_text else [])

    return work


def judge_lines(df: DataFrame, text: str = "text", with_text: bool = True, max_lost: float = MAX_LOST) -> DataFrame:
    """``df`` with the counts of its whole texts, the verdict, and (``with_text``) the cleaned text.

    A text fails the base rules with under 20 words, or if over 30 % of its words lie in 8-word windows that occur twice or
    more. Else its lines are judged (letters, symbols, navigation, boilerplate, capitals, sentence), and it goes if the
    failed lines hold more than ``max_lost`` of its words; reason names the rule that cost most. A null text counts as
    empty: all counts 0, base_failed, not kept. Repeated rows agree, an empty table gives an empty one, columns named like a
    new one are replaced.
    """
    ddl = ", ".join([BASE, VERDICT] + ["cleaned_text string"] * with_text)
    return add_columns(df, text, ddl, partial(_judge, with_text, max_lost), drop=() if with_text else (text,))
