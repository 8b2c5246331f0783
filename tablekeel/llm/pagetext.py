"""The main text of web pages, from the containers that the pages of a host agree on.

Each page is parsed and its containers are scored by the running text they hold. The page
votes for the path of its best container: the tags, classes and ids above it, with digits
made alike. Spark adds up the votes by host. In a second pass each page is extracted from
the container whose path won most votes of its host, and from its own choice only where it
has none of these. Lists and boxes of links inside the main text are voted on in the same way.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekeel.llm.common import cut, pick, pieces, small

# Elements without an end tag, elements that do not break a line, and elements whose content is no markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
RAW = "script|style|template|iframe|noembed|noframes|xmp|textarea|title|svg|math"
# Start tags that end an open element of the same group, and what an end tag does not reach beyond.
PARAGRAPH_ENDS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
LISTS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
SCOPE = frozenset("table td th caption".split())
IN_HEAD = frozenset("meta link base title style script noscript template".split())

#: Elements that may hold the main text, and others that have a path of their own.
CONTAINERS = frozenset("article main section div td center".split())
BOXES = frozenset("ul ol dl table".split())
#: Elements that are never main text.
NEVER = frozenset("head nav footer aside form button select menu dialog noscript object canvas audio video map".split())
#: Those that are none even around an article.
ALWAYS = NEVER - {"form"}
#: Elements nested deeper than this count as the element they stand in; their text stays.
MOST_DEPTH = 256
#: Words in classes and ids, and roles, of what is no main text either.
CLASSES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense banner sponsor sponsored promo promotion "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager masthead topbar footer copyright sidebar "
    "aside cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations trending comment comments disqus "
    "reply replies respond".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar form".split())

#: The share of a page's running text that a container needs to be its choice, and that its articles need.
MOST_TEXT, SOME_TEXT = 0.7, 0.25
#: A path wins with the votes of one in so many of its host's pages, so that no host has more than so many winners.
ONE_IN = 50
#: Paths that a task counts before it hands on their votes, and hosts whose winners it keeps at hand.
MOST_HELD = 1 << 18

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?--!?>|.*\Z)"
    rf"|<(?P<raw>{RAW})\b[^>]*+(?:(?<=/)>|>(?:.*?</(?P=raw)\b[^>]*+>|.*\Z))"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+>?",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role|itemprop|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?![\w-])", re.IGNORECASE)
_TOKENS = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")


@lru_cache(maxsize=1 << 16)
def _path(above: int, label: str) -> int:
    return int.from_bytes(blake2b(above.to_bytes(8, signed=True) + label.encode("utf-8", "replace"), digest_size=8).digest(), signed=True)


@lru_cache(maxsize=1 << 14)
def _tag(name: str, attributes: str) -> tuple[str, bool, bool, bool]:
    """Of a start tag: its label, and whether it holds the article, is never part of it, or only inside one."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    names = sorted(found.get("class", "").split())
    label = ".".join([name, *names]) + (f"#{found['id'].strip()}" if found.get("id") else "")
    words = {w.lower() for x in (*names, found.get("id", "")) for w in _TOKENS.findall(x)}
    words |= {w.lower() for x in (*names, found.get("id", "")) for w in re.split(r"[^A-Za-z]+", x)}
    role = found.get("role", "").strip().lower()
    chosen = name in ("article", "main") or role in ("main", "article") or "articleBody" in found.get("itemprop", "")
    never = name in NEVER or role in ROLES or "hidden" in found or bool(words & CLASSES)
    outside = name == "header" or ("header" in words and name not in ("h1", "h2", "h3", "h4", "h5", "h6"))
    return re.sub(r"\d+", "0", label), chosen, never, outside


class Node:
    __slots__ = ("above", "name", "path", "chosen", "never", "outside", "holds", "depth", "good", "chars", "links", "anchors")

    def __init__(self, above: Node | None, name: str, path: int, chosen: bool, never: bool, outside: bool) -> None:
        self.above, self.name, self.path = above, name, path
        self.chosen, self.never, self.outside, self.holds = chosen, never, outside, False
        self.depth = above.depth + 1 if above else 0
        self.good = self.chars = self.links = self.anchors = 0

    @property
    def container(self) -> bool:
        return self.name in CONTAINERS or self.chosen or self.above is None

    def line(self) -> Iterator[Node]:
        """The element and those it stands in."""
        node: Node | None = self
        while node is not None:
            yield node
            node = node.above


class Page:
    """A page's blocks of text in order, each with the element it stands in, and the elements that matter."""

    def __init__(self, html: str) -> None:
        self.root = Node(None, "", 0, False, False, False)
        self.nodes = [self.root]
        self.blocks: list[tuple[Node, str, int]] = []
        self._parse(html)
        self._settle()

    def _parse(self, html: str) -> None:
        stack: list[tuple[str, Node]] = [("", self.root)]
        text: list[str] = []
        linked, in_link, at = 0, False, 0

        def flush() -> None:
            nonlocal linked
            if text:
                block = " ".join("".join(text).split())
                if block:
                    self.blocks.append((stack[-1][1], block, linked))
                text.clear()
            linked = 0

        def add(data: str) -> None:
            nonlocal linked
            if "&" in data:
                data = unescape(data)
            text.append(data)
            if in_link:
                linked += len("".join(data.split()))

        for token in _TOKEN.finditer(html):
            if token.start() > at:
                add(html[at : token.start()])
            at = token.end()
            name = token["name"]
            if name is None:
                continue
            name = name.lower()
            if token["end"]:
                if name == "a":
                    in_link = False
                if name in INLINE:
                    self._close_inline(stack, name, text, flush)
                elif name not in ("html", "body"):
                    flush()
                    in_link = False
                    for depth in range(len(stack) - 1, 0, -1):
                        if stack[depth][0] == name:
                            del stack[depth:]
                            break
                        if stack[depth][0] in SCOPE and name not in ("table", "tr", "tbody", "thead", "tfoot"):
                            break
                else:
                    flush()
                continue
            if name in ("html", "body"):
                flush()
                del stack[1:]
                continue
            if stack[-1][0] == "head" and name not in IN_HEAD:
                flush()
                stack.pop()
            label, chosen, never, outside = _tag(name, token["rest"] if _ATTRIBUTE.search(token["rest"]) else "")
            if name not in INLINE:
                flush()
                self._imply(stack, name)
            if name in VOID:
                continue
            above = stack[-1][1]
            if name == "a":
                in_link = True
                for node in above.line():
                    node.anchors += 1
            # Only elements that matter become nodes; the others share that of the element they stand in.
            matters = name in CONTAINERS or name in BOXES or chosen or never or outside
            if name in INLINE and not never:
                continue
            if matters and above.depth < MOST_DEPTH:
                flush()
                self.nodes.append(Node(above, name, _path(above.path, label), chosen, never, outside))
                above = self.nodes[-1]
            stack.append((name, above))
        if at < len(html):
            add(html[at:])
        flush()

    @staticmethod
    def _close_inline(stack: list[tuple[str, Node]], name: str, text: list[str], flush) -> None:
        """Inline elements are on the stack only if they are left out; their end tag does not end the blocks they stand in."""
        if stack[-1][0] == name:
            flush()
            stack.pop()

    @staticmethod
    def _imply(stack: list[tuple[str, Node]], name: str) -> None:
        """End what the start tag of a block ends: an open paragraph, and the item or cell before it."""
        while len(stack) > 1 and stack[-1][0] in INLINE:
            stack.pop()
        if name in PARAGRAPH_ENDS and stack[-1][0] == "p":
            stack.pop()
        if name in SIBLINGS:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in SIBLINGS[name]:
                    del stack[depth:]
                    if name != "tr" or not any(s[0] in ("td", "th") for s in stack[depth - 1 :]):
                        break
                elif stack[depth][0] in LISTS[name]:
                    break

    def _settle(self) -> None:
        """What is left out, from the outside in, and the text of all elements."""
        for node in self.nodes:
            if node.chosen and not node.never:
                for over in node.line():
                    over.holds = over.holds or over is not node
        for node in self.nodes[1:]:  # elements come after those they stand in
            article = any(over.chosen for over in node.above.line())
            around = node.holds and not article and node.name not in ALWAYS  # a wrapper, whatever its names say
            node.never = node.above.never or (node.never and not around) or (node.outside and not article and not around)
        kept = []
        for node, block, linked in self.blocks:
            if node.never:
                continue
            kept.append((node, block, linked))
            size = len(block)
            good = size if 2 * linked < size else 0
            for over in node.line():
                over.good += good
                over.chars += size
                over.links += linked
        self.blocks = kept

    def choice(self) -> Node:
        """The page's own: its article or main element, or else the smallest container that holds most of its running text."""
        total = self.root.good
        chosen = [n for n in self.nodes if n.chosen and not n.never]
        outer = [n for n in chosen if not any(over.chosen for over in n.above.line())]
        if total and outer and sum(n.good for n in outer) >= SOME_TEXT * total:
            best = max(outer, key=lambda n: n.good)
            inner = (n for n in chosen if n.good >= MOST_TEXT * best.good and any(over is best for over in n.above.line()))
            return next(inner, best)
        best = self.root
        for node in self.nodes:
            if node.container and not node.never and total and node.good >= MOST_TEXT * total and any(over is best for over in node.line()):
                best = node
        return best

    def menus(self) -> dict[int, int]:
        """1 for the path of each box that is a list of links, and -1 for that of each that is not; the votes of equal paths add up."""
        votes: Counter[int] = Counter()
        for node in self.nodes[1:]:
            if not node.never and not node.chosen and node.chars:
                votes[node.path] += 1 if node.anchors >= 3 and 10 * node.links >= 7 * node.chars else -1
        return {path: 1 if n > 0 else -1 for path, n in votes.items()}

    def text(self, winners: dict[int, int], menus: set[int]) -> str:
        """The blocks in the elements of the host's best path that the page has, or of its own choice."""
        here: Counter[int] = Counter()
        for node in self.nodes:
            if not node.never and node.container and node.path in winners:
                here[node.path] += node.good
        there = [p for p, good in here.items() if good]
        path = min(there, key=lambda p: (-winners[p], -here[p], p)) if there else self.choice().path
        main = {id(n) for n in self.nodes if n.path == path and not n.never and (n.good or not self.root.good)}
        out = []
        for node, block, _ in self.blocks:
            line = list(node.line())
            depth = next((i for i, over in enumerate(line) if id(over) in main), None)
            if depth is not None and not any(over.path in menus for over in line[:depth]):
                out.append(block)
        return " ".join(out)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, path, kind and votes: of main containers (0), of lists of links (1), and the pages themselves (2)."""
    held: Counter[tuple[str, int, int]] = Counter()

    def batch() -> pa.RecordBatch:
        host, path, kind = zip(*held, strict=True)
        arrays = [pa.array(host, pa.string()), pa.array(path, pa.int64()), pa.array(kind, pa.int32()), pa.array(held.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["host", "path", "kind", "votes"])

    for part in (p for b in batches for p in pieces(b, "html")):
        for host, html in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
            page = Page(html)
            held[host, 0, 2] += 1
            if page.root.good:
                held[host, page.choice().path, 0] += 1
            for path, vote in page.menus().items():
                held[host, path, 1] += vote
        if len(held) > MOST_HELD:
            yield batch()
            held.clear()
    if held:
        yield batch()


def host_winners(rows: DataFrame) -> DataFrame:
    """Per host the paths that won (main: path and votes) and those of lists of links (menus), and how many these are (entries).

    rows: host and html. Votes are added up in the tasks before they are shuffled, so that a
    host of very many pages is no more work than another. A path needs two votes at least.
    """
    votes = rows.mapInArrow(_votes, "host string, path long, kind int, votes long")
    votes = cut(votes.groupBy("host", "path", "kind").agg(F.sum("votes").alias("votes")).where("votes > 0"))
    pages = votes.where("kind = 2").select("host", F.col("votes").alias("pages"))
    won = votes.where("kind < 2").join(pages, "host").where(f"votes > 1 AND votes * {ONE_IN} >= pages")
    main = F.collect_list(F.when(F.col("kind") == 0, F.struct("path", "votes")))
    menus = F.collect_list(F.when(F.col("kind") == 1, F.col("path")))
    return cut(won.groupBy("host").agg(main.alias("main"), menus.alias("menus"), F.count("*").alias("entries")))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, tuple[dict[int, int], set[int]]] = {}
    for part in (p for b in batches for p in pieces(b, "html")):
        texts = []
        for i, (host, html) in enumerate(zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True)):
            if host not in known:
                if len(known) > MOST_HELD:
                    known.clear()
                main, menus = part.column("main")[i].as_py() or (), part.column("menus")[i].as_py() or ()
                known[host] = {m["path"]: m["votes"] for m in main}, set(menus)
            texts.append(Page(html).text(*known[host]))
        arrays = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text"])


def main_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (its code points), a row for each row of pages.

    text holds the blocks of the main container in page order, white space in each made one
    space, joined by one space; it is empty if there are none. A null html is empty. Pages
    without a url, or whose url has no host, vote together as one host. The winners of hosts
    are broadcast if they are counted to be few, and otherwise joined, where Spark splits
    the pages of a large host.
    """
    rows = pick(pages, page_id=page_id, url=url, html=html)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#\s]+)", 1))
    rows = rows.select("page_id", "url", host.alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    winners = host_winners(rows.select("host", "html"))
    entries = winners.agg(F.coalesce(F.sum("entries"), F.lit(0)).alias("n")).first().n
    joined = rows.join(small(winners.drop("entries"), entries), "host", "left")
    schema = T.StructType([rows.schema["page_id"], rows.schema["url"], T.StructField("text", T.StringType())])
    texts = joined.select("page_id", "url", "host", "html", "main", "menus").mapInArrow(_texts, schema)
    return texts.withColumn("n_chars", F.length("text").cast("long"))
