"""Main text of web pages by consensus: pages of a host vote on the path of the container that holds their article.

First every page names its own best container and what it weighs; Spark sums the votes of a host by generalised path (tags and
first class without digits). Then every page is cut again at the container with the host's path, and falls back on its
own where it has none, or one with little of the page's text (a host may have several templates).
"""

from __future__ import annotations

import heapq
import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spindrift.llm.rows import lower_ascii, name, slices, unused, written

TOKEN = re.compile(
    # a quote opens a value only after "=", and only if it is closed somewhere; a value may hold < and >
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=<]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)>""", re.DOTALL
)
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "html body address article aside blockquote br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("body article main section div td center blockquote".split())
DROPPED = frozenset("nav footer aside form button select dialog menu svg canvas audio video object head fieldset".split())
ENDS_PARAGRAPH = BLOCKS - {"br", "option", "optgroup", "legend", "caption"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
#: Parts of class names and ids, and roles, that mark what is no part of an article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner sidebar sidenav rail menu nav navbar "
    "navigation topnav breadcrumb breadcrumbs footer masthead topbar cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments commentlist disqus respond "
    "reply replies widget widgets toolbar pagination pager search skip complementary contentinfo dialog hidden form".split()
)
#: Words beside a mark in an id that still name a part (ad-slot, related-posts); with any other word the id names a subject (share-prices).
ID_PLAIN = frozenset(
    "area articles bar block bottom box buttons container icons info inner items law left links list message outer page panel posts primary right "
    "row secondary section site slot stories tools top unit wrap wrapper".split()
)
#: Elements that hold text of the article itself: only a class that is a mark as a whole, of these, drops one.
CONTENT = frozenset("p table blockquote pre ul ol dl figure h1 h2 h3 h4 h5 h6".split())
CONTENT_MARKS = MARKS - frozenset("alert dialog form menu notice notices rail reply search skip social toolbar widget widgets".split())
COMMENTS = frozenset("comment comments commentlist reply replies respond".split())
#: First and last words of a class or id that state a layout (no-sidebar, comments-open) instead of naming a part.
STATES_FIRST, STATES_LAST = frozenset("has no with without".split()), frozenset("open closed enabled disabled".split())
IN_HEAD = frozenset("html head base basefont bgsound link meta title style script noscript noframes template".split())
HEADINGS = frozenset({"h1"})
PATH_STEPS = 6
#: Share of the weight of a page's own best container that those with the host's path must have.
HOST_SHARE = 0.5
#: Shares of the text that a container must hold to be gone down into: plain, article or main, and one with short blocks beside it.
NEARLY, HALF, MOST = 0.9, 0.5, 0.6
#: Characters from which a block may be prose.
PROSE = 60


def steps_of(attributes: str, tag: str = "div") -> tuple[str, frozenset[str], bool]:
    """First class without digits, the parts of class, id and role that may mark the element, and whether it is hidden.

    An id counts if it is made of marks and plain words alone, and never for an element of text; of the classes of those only whole ones that are marks count.
    """
    first, parts, hidden = "", set(), False
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values)
        if key == "class" and value.split():
            first = re.sub(r"\d+", "", value.split()[0].lower())
        if key in ("class", "id", "role"):
            for token in value.split():
                named = re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", token).lower())
                if tag in CONTENT and (key == "id" or len(named) > 1 or not CONTENT_MARKS.issuperset(named)):
                    continue
                if key == "id" and not (MARKS | ID_PLAIN | STATES_FIRST | STATES_LAST | {"main", "header", ""}).issuperset(named):
                    continue
                if len(named) < 2 or named[0] not in STATES_FIRST and named[-1] not in STATES_LAST:
                    parts.update(named)
        hidden |= key == "hidden" or key == "aria-hidden" and value.lower() == "true"
        hidden |= key == "style" and "display:none" in value.replace(" ", "").lower()
    return first, frozenset(parts), hidden


class Page:
    """Blocks of text with the containers they lie in."""

    def __init__(self, source: str):
        self.paths: list[str] = []          # by container
        self.semantic: list[int] = []       # by container: 2 article, 1 main, 0 else
        self.parents: list[int] = []        # by container
        self.blocks: list[tuple[int, str, int, bool]] = []  # container, text, characters within links, first heading
        self.marks: list[tuple[int, bool]] = []  # by marked element: marked one around, whether of comments
        self.marked: list[int] = []         # by container: marked element it is or lies in
        self.pieces: list[tuple[int, list[tuple[str, int, bool]], bool]] = []  # container, (text, marked element, link), first heading
        self._read(source)
        self._settle()

    def _read(self, source: str) -> None:
        # Open elements: tag, container it makes or -1, container around, dropped, link, path, header, marked element
        stack: list[tuple[str, int, int, bool, bool, str, bool, int]] = []
        places: dict[str, list[int]] = {}   # by tag: where it is open in the stack
        ends: list[int] = []                # where elements that end a paragraph are open
        last = lambda tags: max((places[t][-1] for t in tags if places.get(t)), default=-1)
        text: list[tuple[str, int, bool]] = []
        within: list[bool] = []             # by container: whether it is or lies in a semantic one
        container, dropped, link, path, header, heading, mark = -1, False, False, "", False, False, -1

        def flush() -> None:
            if text:
                self.pieces.append((container, text.copy(), heading))
                text.clear()

        def close(depth: int) -> None:
            nonlocal container, dropped, link, path, header, heading, mark
            if any(e[0] in BLOCKS for e in stack[depth:]):
                flush()
            _, _, container, dropped, link, path, header, mark = stack[depth]
            for e in stack[depth:]:
                places[e[0]].pop()
            while ends and ends[-1] >= depth:
                ends.pop()
            heading = heading and not any(e[0] in HEADINGS for e in stack[depth:])
            del stack[depth:]

        position, size = 0, len(source)
        while position < size:
            found = TOKEN.search(source, position)
            end = found.start() if found else size
            if stack and stack[-1][0] == "head" and source[position:end].strip():
                close(len(stack) - 1)
            if end > position and not dropped and (not header or heading):
                text.append((source[position:end], mark, link))
            if not found:
                break
            position = found.end()
            tag = (found[2] or "").lower()
            if not tag:
                continue
            if found[1]:
                depth = last((tag,))
                if depth >= 0:
                    close(depth)
                elif tag in BLOCKS:
                    flush()
                continue
            if tag not in IN_HEAD:  # the end tag of a head is optional
                depth = places["head"][0] if dropped and places.get("head") else -1
                if depth >= 0:
                    close(depth)
            if tag in RAW:
                ended = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(source, position)
                position = ended.end() if ended else size
                if tag in ("iframe", "noscript", "template"):
                    flush()
                continue
            if tag in BLOCKS:
                if tag in ENDS_PARAGRAPH:
                    if ends and stack[ends[-1]][0] == "p":
                        close(ends[-1])
                if tag in CLOSES and last(CLOSES[tag]) > last(SCOPES[tag]):
                    close(last(CLOSES[tag]))
                flush()
            if tag in VOID or found[3].endswith("/") and tag not in BLOCKS:
                continue
            first, parts, hidden = steps_of(found[3], tag) if found[3].strip() else ("", frozenset(), False)
            before = (tag, -1, container, dropped, link, path, header, mark)
            inside = container >= 0 and within[container]
            marked = parts & (COMMENTS if tag == "article" else MARKS)
            if tag not in ("html", "body", "main"):
                if tag in DROPPED or hidden:
                    dropped = True
                elif marked:
                    self.marks.append((mark, bool(parts & COMMENTS)))
                    mark = len(self.marks) - 1
            if tag == "header" or tag not in ("html", "body", "main", "article") and "header" in parts:
                header, dropped = True, dropped or not inside
            if tag in HEADINGS:
                heading = True
            link = link or tag == "a"
            if tag in CONTAINERS:
                path = ">".join([*path.split(">"), f"{tag}.{first}" if first else tag][-PATH_STEPS:]).lstrip(">")
                self.paths.append(path)
                self.semantic.append(2 if tag == "article" else 1 if tag == "main" or "main" in parts and tag == "div" else 0)
                self.parents.append(container)
                within.append(inside or bool(self.semantic[-1]))
                self.marked.append(mark)
                before = (tag, len(self.paths) - 1, *before[2:])
                container = len(self.paths) - 1
            places.setdefault(tag, []).append(len(stack))
            if tag in ENDS_PARAGRAPH:
                ends.append(len(stack))
            stack.append(before)
        flush()

    def _settle(self) -> None:
        """Blocks of what is kept. A marked element goes, unless it turns out to wrap the page: no article shows outside of it, and it
        holds most of the page's text, or the only article or main with text. Comments always go."""
        split: list[tuple[int, bool, dict[int, list]]] = []
        for container, pieces, heading in self.pieces:
            of: dict[int, list] = {}
            for piece in pieces:
                of.setdefault(piece[1], []).append(piece)
            split.append((container, heading, of))
        kept = {-1} | (self._wrappers(split) if self.marks else set())
        for (container, pieces, heading), (_, _, of) in zip(self.pieces, split):
            own = [p for p in pieces if p[1] in kept] if len(of) > 1 or not kept.issuperset(of) else pieces
            if body := " ".join("".join(entities.unescape(p[0]) for p in own).split()):
                self.blocks.append((container, body, sum(len(p[0]) for p in own if p[2]), heading))
        self.pieces.clear()

    def _wrappers(self, split: list[tuple[int, bool, dict[int, list]]]) -> set[int]:
        count = len(self.marks)
        texts = [0] * (count + 1)                            # by marked element, the last outside of all: text without comments
        shown: list[dict[int, int]] = [{} for _ in range(count + 1)]  # its own text alone: by kind of semantic container around
        holds = [False] * (count + 1)                        # whether an article or main with text lies within
        filled: set[int] = set()
        talk = [False] * (count + 1)                         # whether within comments
        for mark, (around, comments) in enumerate(self.marks):
            talk[mark] = comments or talk[around]
        kinds: list[int] = []                                # by container: 2 within an article, 1 within main, 0 else
        for container, parent in enumerate(self.parents):
            kinds.append(max(self.semantic[container], kinds[parent] if parent >= 0 else 0))
        for container, _, of in split:
            for mark, pieces in of.items():
                size = sum(len(" ".join(t.split())) * (-1 if link else 1) for t, _, link in pieces)
                if size > 0 and not talk[mark]:
                    texts[mark] += size
                    kind = kinds[container] if container >= 0 else 0
                    shown[mark][kind] = shown[mark].get(kind, 0) + size
                    at = container
                    while at >= 0 and at not in filled:
                        filled.add(at)
                        if self.semantic[at]:
                            holds[self.marked[at]] = True
                        at = self.parents[at]
        inner: dict[int, list[int]] = {}
        for mark in range(count - 1, -1, -1):  # marked elements come after the ones they lie in
            around, comments = self.marks[mark]
            inner.setdefault(around, []).append(mark)
            if not comments:
                texts[around] += texts[mark]
                holds[around] |= holds[mark]
        kept: set[int] = set()
        seen = dict(shown[-1])
        open_marks = [(-texts[m], m) for m in inner.get(-1, [])]
        heapq.heapify(open_marks)
        while open_marks:
            _, mark = heapq.heappop(open_marks)
            most = 2 * texts[mark] > texts[-1]
            if self.marks[mark][1] or seen.get(2) or not (most or holds[mark] and not seen.get(1)):
                continue
            kept.add(mark)
            for kind, size in shown[mark].items():
                seen[kind] = seen.get(kind, 0) + size
            for m in inner.get(mark, []):
                heapq.heappush(open_marks, (-texts[m], m))
        return kept

    def weights(self) -> list[float]:
        """Text of each container with all it holds: its characters, those in links taken off twice."""
        own = [0.0] * (len(self.paths) + 1)
        for container, body, linked, _ in self.blocks:
            own[container] += max(0, len(body) - 2 * linked)
        for container in range(len(self.paths) - 1, -1, -1):  # containers come after the ones they lie in
            own[self.parents[container]] += own[container]
        return own

    def best(self) -> tuple[int, float]:
        """The page's own container: down from the top into the one that holds nearly all of the text, at an article at the latest.

        An article or main may leave half of it outside; any other may leave more than a tenth only if that is mostly in blocks too short for
        prose, as lists of links and captions are. Else what lies beside it belongs to the story too.
        """
        own = self.weights()
        prose = [0.0] * (len(self.paths) + 1)
        for container, body, linked, _ in self.blocks:
            prose[container] += max(0, len(body) - 2 * linked) if len(body) >= PROSE else 0
        inner: dict[int, list[int]] = {}
        for container in range(len(self.paths) - 1, -1, -1):
            prose[self.parents[container]] += prose[container]
            inner.setdefault(self.parents[container], []).append(container)
        at = -1
        while not (at >= 0 and self.semantic[at] == 2):
            down = max(inner.get(at, []), key=lambda c: (own[c] * (1 + self.semantic[c]), -c), default=-1)
            if down < 0 or own[down] <= 0:
                break
            share = own[down] / own[at]
            short = prose[at] - prose[down] < HALF * (own[at] - own[down])
            if not (share >= (HALF if self.semantic[down] else NEARLY) or short and share >= MOST):
                break
            at = down
        return at, own[at]

    def text(self, path: str | None) -> str:
        """Blocks in the containers with ``path`` if they hold HOST_SHARE of the text of the page's own best one, else in that one, and
        the first heading before them."""
        chosen = {i for i, p in enumerate(self.paths) if path and p == path}
        at, weight = self.best()
        own = self.weights() if chosen else None
        covered = [False] * (len(self.paths) + 1)  # by container: whether one around it is chosen
        share = 0.0
        for c, parent in enumerate(self.parents):
            covered[c] = parent >= 0 and (parent in chosen or covered[parent])
            share += own[c] if c in chosen and not covered[c] else 0.0
        if share <= 0 or share < HOST_SHARE * weight:
            chosen = {at}
        if -1 in chosen:
            return " ".join(body for _, body, _, _ in self.blocks)
        within = [False] * (len(self.paths) + 1)
        for i, parent in enumerate(self.parents):
            within[i] = i in chosen or (parent >= 0 and within[parent])
        out: list[str] = []
        for container, body, _, heading in self.blocks:
            if (within[container] if container >= 0 else False) or heading and not out:
                out.append(body)
        return " ".join(out)


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            paths, weights = [], []
            for source in part.column(1).to_pylist():
                page = Page(source or "")
                at, weight = page.best()
                paths.append(page.paths[at] if at >= 0 else None)
                weights.append(int(weight))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(paths, pa.string()), pa.array(weights, pa.int64())], names=["host", "path", "weight"]
            )


def _cut(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            texts = [Page(h or "").text(p) for p, h in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
            made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(part.columns[2:] + made, names=names)


def host_of(url) -> F.Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def consensus_paths(df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, path): the container path with most text behind it on the pages of each host; ties by path."""
    votes = df.select(host_of(name(url)).alias("host"), name(html).alias("html")).mapInArrow(_vote, "host string, path string, weight long")
    sums = votes.filter("path IS NOT NULL AND weight > 0").groupBy("host", "path").agg(F.sum("weight").alias("weight"))
    return sums.groupBy("host").agg(F.max(F.struct("weight", "path")).alias("top")).select("host", F.col("top.path").alias("path"))


def main_text(df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``df`` without the html, with text (main text of the whole page) and n_chars (its code points).

    Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, markup and reader comments go; a first heading
    stays. White space in a block becomes one space, blocks are joined by one. A null or empty page, or one without text, gives ""; a null url, or
    one without host, votes under the empty host. Cut or wrongly nested pages are read as far as they go. Hosts may hold any share of
    the pages: votes are summed before they move, and paths come back to pages by a join whose hot hosts Spark splits. Repeated rows
    agree, an empty table gives an empty one, columns named like a new one are replaced.
    """
    kept = [c for c in df.columns if c not in ("text", "n_chars", html)]
    page, host, of, path = unused(df, "_html", "_host", "_of", "_path")
    source = df.select(name(html).alias(page), host_of(name(url)).alias(host), *[name(c) for c in kept])
    # Written first: Spark splits a hot key of a join only where both sides come straight from a shuffle.
    paths, _ = written(consensus_paths(df, url, html).select(F.col("host").alias(of), F.col("path").alias(path)), "paths")
    joined = source.join(paths, F.col(host) == F.col(of), "left").select(path, page, *[name(c) for c in kept])
    schema = df.select(*[name(c) for c in kept], F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    return joined.mapInArrow(lambda batches: _cut(batches, schema.names), schema)
