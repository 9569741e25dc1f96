"""URL rules as globs, all of them run at once by a bit-parallel Shift-And automaton.

Each glob takes one bit for its start and one for each of its bytes; the bits of all globs are packed into 64-bit words with
carries between them. For a byte c the state becomes ``((state << 1) & takes[c]) | (state & stays[c])``: ``takes`` holds
the positions whose byte is c, ``stays`` those followed by a wildcard that c may be part of. The URLs of a batch are
stepped together, one vector operation per byte position.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spindrift.llm.rows import add_columns, lower_ascii, name, unused

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class HostRule:
    """Fits ``host`` and all its subdomains where the URL's path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def globs(self) -> tuple[str, str]:
        literal = "".join("\\" + c if c in "*?\\" else c for c in self.text)
        return literal + "**", "*." + literal + "**"


#: The rules of the registered query.
RULES = (
    HostRule("com", "/", ALLOW), HostRule("example.com", "/en/", BLOCK), HostRule("www.example.com", "/en/", ALLOW),
    HostRule("net", "/es/", BLOCK), HostRule("net", "/fr/", BLOCK),
)
#: Globs that block where no rule fits; the rest is allowed.
GLOBS = ("*spam*/**", "*casino*/**", "*pills*/**", "ads.*/**", "*.ads.*/**", "ads-*/**", "*.ads-*/**")
COLUMNS = "rule string, verdict string, glob string"


class ShiftAnd:
    """Matches whole texts against globs: ``*`` any run without "/", ``**`` any run, ``?`` one character byte but "/", ``\\`` escapes."""

    def __init__(self, globs: tuple[str, ...]):
        steps = [self._steps(g.encode()) for g in globs]
        bits = sum(len(s) for s in steps)
        self.words = max(1, -(-bits // 64))
        self.takes = np.zeros((256, self.words), dtype=np.uint64)
        self.stays = np.zeros((256, self.words), dtype=np.uint64)
        self.start = np.zeros(self.words, dtype=np.uint64)
        self.accepts, at = [], 0
        for pattern in steps:
            self.start[at >> 6] |= self._bit(at)
            for taken, kept in pattern:
                for table, accepted in ((self.takes, taken), (self.stays, kept)):
                    for byte in accepted:
                        table[byte, at >> 6] |= self._bit(at)
                at += 1
            self.accepts.append(at - 1)

    @staticmethod
    def _bit(at: int) -> np.uint64:
        return np.uint64(1 << (at & 63))

    @staticmethod
    def _steps(glob: bytes) -> list[tuple[set[int], set[int]]]:
        """Per bit the bytes that lead to it and the bytes it stays set for; the first is the start."""
        every, within = set(range(256)), set(range(256)) - {ord("/")}
        steps, i = [(set(), set())], 0
        while i < len(glob):
            if glob[i:i + 2] == b"**":
                steps[-1] = steps[-1][0], every
                i += 2
            elif glob[i:i + 1] == b"*":
                steps[-1] = steps[-1][0], steps[-1][1] | within
                i += 1
            elif glob[i:i + 1] == b"?":
                steps.append((within, set()))
                i += 1
            else:
                i += glob[i:i + 1] == b"\\" and i + 1 < len(glob)
                steps.append(({glob[i]}, set()))
                i += 1
        return steps

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """Row per text, column per glob. Texts are ordered by length, so that ended ones are left out of later steps."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        order = np.argsort(-sizes, kind="stable")
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(texts) else sizes
        stream = np.frombuffer(b"".join(texts), dtype=np.uint8)
        state = np.tile(self.start, (len(texts), 1))
        by_size, from_start = sizes[order], starts[order]
        one, top = np.uint64(1), np.uint64(63)
        alive = len(texts)
        for position in range(int(by_size[0]) if len(texts) else 0):
            while by_size[alive - 1] <= position:
                alive -= 1
            bytes_now = stream[from_start[:alive] + position]
            now = state[:alive]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:alive] = (moved & self.takes[bytes_now]) | (now & self.stays[bytes_now])
        ended = np.empty_like(state)
        ended[order] = state
        return np.stack([(ended[:, a >> 6] & self._bit(a)) != 0 for a in self.accepts], axis=1) if self.accepts else np.zeros((len(texts), 0), bool)


def _judge(rules: tuple[HostRule, ...], globs: tuple[str, ...]):
    ranked = sorted(rules, key=lambda r: (-len(r.text), r.verdict != BLOCK, r.text))
    automaton = ShiftAnd(tuple(g for r in ranked for g in r.globs()) + tuple(globs))

    def work(urls: list[str | None]) -> list[pa.Array]:
        fits = automaton.matches([(u or "").encode() for u in urls])
        of_rules = fits[:, : 2 * len(ranked)].reshape(len(urls), len(ranked), 2).any(axis=2)
        of_globs = fits[:, 2 * len(ranked):]
        rule: list[str | None] = []
        verdict: list[str] = []
        glob: list[str | None] = []
        for by_rule, by_glob in zip(of_rules, of_globs):
            first = int(by_rule.argmax()) if by_rule.any() else -1
            hit = globs[int(by_glob.argmax())] if by_glob.any() else None
            rule.append(ranked[first].text if first >= 0 else None)
            verdict.append(ranked[first].verdict if first >= 0 else BLOCK if hit else ALLOW)
            glob.append(hit if first < 0 else None)
        return [pa.array(x, pa.string()) for x in (rule, verdict, glob)]

    return work


def judge_urls(df: DataFrame, url: str = "url", rules: tuple[HostRule, ...] = RULES, globs: tuple[str, ...] = GLOBS) -> DataFrame:
    """``df`` without the URL, with its host, path, the longest rule that fits (else null), the verdict, and the glob that blocked.

    Host and path together are the canonical URL: host in lower case (A-Z), path as it is, no scheme, query or fragment.
    Of rules of equal length a blocking one wins, then the first by code point. Where no rule fits, a glob blocks and
    the rest is allowed. A null URL or one without "://" has empty host and path, fits no rule and is allowed. URLs of any
    length are read whole; rows are independent, so repeated rows agree; an empty table gives an empty one; columns
    named like a new one are replaced.
    """
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    whole, = unused(df, "_canonical")
    kept = [name(c) for c in df.columns if c not in (url, "host", "path", *COLUMNS.replace(" string", "").split(", "))]
    found = df.select(
        *kept,
        lower_ascii(F.coalesce(F.regexp_extract(name(url), parts, 1), F.lit(""))).alias("host"),
        F.coalesce(F.regexp_extract(name(url), parts, 2), F.lit("")).alias("path"),
    )
    canonical = found.withColumn(whole, F.concat("host", "path"))
    return add_columns(canonical, whole, COLUMNS, partial(_judge, rules, globs), drop=(whole,))


#: DuckDB text of the registered query, for ``RULES`` and ``GLOBS``.
URL_SQL = r"""
WITH p AS (
  SELECT page_id,
    translate(COALESCE(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    COALESCE(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
r AS (
  SELECT page_id, host, path, CASE
    WHEN '.' || host LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN '.' || host LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN '.' || host LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN '.' || host LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN '.' || host LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM p)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
  WHEN rule IS NOT NULL THEN 'block'
  WHEN starts_with(path, '/') AND (host LIKE '%spam%' OR host LIKE '%casino%' OR host LIKE '%pills%' OR '.' || host LIKE '%.ads.%'
    OR '.' || host LIKE '%.ads-%') THEN 'block'
  ELSE 'allow' END AS verdict
FROM r
"""
