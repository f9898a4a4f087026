"""Main text of web pages by paths that the pages of a host agree on.

Each page names the container that encloses all its text besides lists of links, as the path of tags and classes
that leads to it, with numbers in classes generalised. The votes are counted per host in Spark. A page is then read
again with the paths that won on its host: its own choice if it is one of them, or else the first that holds most of
its text and cuts no article, or its own choice when none does. Menus, adverts, notices, forms, comments and the like do not count as text in either reading.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.rows import text_of
from martloom.storage import fits_broadcast, store

# What HTML says about its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math xmp noframes".split())
CONTAINERS = frozenset("html body main article section div td th table tbody tr center layer content blockquote dl ul ol li".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr br ruby rt rp nobr".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
SCOPES = frozenset("table ul ol dl body html article section div".split())

# Elements, and words of classes, ids and roles, that mark what is not main text.
LEFT_OUT = frozenset("nav footer aside form button select menu dialog head object audio video canvas fieldset".split())
MARKS = frozenset(
    "nav navigation navbar menu breadcrumb breadcrumbs header masthead footer sidebar side aside ad ads advert adverts "
    "advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert "
    "popup modal overlay newsletter subscribe subscription signup login search share sharing social related recommended "
    "comment comments commentlist disqus replies reply respond pagination pager widget toolbar complementary contentinfo "
    "toc copyright legal paywall skip".split()
)
#: Marks of what readers wrote: an article inside is one of theirs and spares nothing.
REPLIES = frozenset("comment comments commentlist disqus replies reply respond".split())
#: A name of two or more parts is a mark by its last part, unless it begins like this ...
ABOUT = frozenset("with without has no not is tag category cat topic".split())
#: ... or by its first part, if only these follow.
PIECES = frozenset(
    "area bar block body bottom box button buttons col column container content count form group icons inner item items left link "
    "links list main message outer post posts primary right row secondary section slot text title top unit widget widgets wrap wrapper".split()
)
OWN_HEADERS = frozenset("article entry post story".split())
#: Inside an element with one of these names, or words of its class or id, all text belongs together.
WHOLE = OWN_HEADERS | {"main", "content"}

#: A container that leaves links outside, or a winner of the host, must hold this share of the page's text.
DOMINANT = 0.6
#: A path must be chosen by this share of a host's pages, so a host has at most 1 / share paths.
LEAST_VOTES = 0.05

_TAG = re.compile(
    r"(?P<comment><!--.*?(?:-->|\Z))|(?P<cdata><!\[CDATA\[)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|<(?P<broken>/?[a-zA-Z][^\s/>]*)[^>]*>|<[!?/][^>]*>",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_WORD = re.compile(r"[a-z]+|[0-9]+")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}


@dataclass
class Page:
    """Elements in page order: parent, step of the path and how much text, also without blocks of links only; blocks of
    text with the element they stand in. A parent comes before its children, so one pass does for whole branches."""

    parents: list[int] = field(default_factory=lambda: [-1])
    steps: list[str] = field(default_factory=lambda: [""])
    container: list[bool] = field(default_factory=lambda: [True])
    whole: list[bool] = field(default_factory=lambda: [False])
    sizes: list[int] = field(default_factory=lambda: [0])
    prose: list[int] = field(default_factory=lambda: [0])
    marks: list[set[str]] = field(default_factory=lambda: [set()])
    article: list[bool] = field(default_factory=lambda: [False])
    blocks: list[tuple[int, str]] = field(default_factory=list)
    block_prose: list[int] = field(default_factory=list)

    def path(self, node: int) -> str:
        """Tags and classes from the page down to `node`."""
        steps = []
        while node > 0:
            steps.append(self.steps[node])
            node = self.parents[node]
        return "".join(reversed(steps))

    def _at(self, path: str) -> set[int]:
        """Containers with this path."""
        reached = [0]  # how much of the path leads to a node, or -1 off it
        for step, parent in zip(self.steps[1:], self.parents[1:]):
            before = reached[parent]
            reached.append(before + len(step) if before >= 0 and path.startswith(step, before) else -1)
        return {n for n, length in enumerate(reached) if length == len(path) and self.container[n]}

    def choice(self) -> int:
        """The deepest container that leaves no text outside but blocks of links, and none at all of an article."""
        children: dict[int, list[int]] = {}
        for node, parent in enumerate(self.parents):
            if parent >= 0 and self.container[node]:
                children.setdefault(parent, []).append(node)
        node = 0
        while node in children:
            best = max(children[node], key=lambda x: (self.sizes[x], -x))
            if not self.sizes[best] or self.prose[best] < self.prose[node]:
                break
            if self.sizes[best] < self.sizes[node] and (self.whole[node] or self.sizes[best] < DOMINANT * self.sizes[0]):
                break
            node = best
        return node

    def text(self, path: str | None) -> str | None:
        """Blocks under `path`; None when they are too little of the page or a part of an article.

        Without a path, those of the page's choice.
        """
        if path is None:
            roots = {self.choice()}
        else:
            roots = self._at(path)
        inside = []
        for node, parent in enumerate(self.parents):
            inside.append(node in roots or (parent >= 0 and inside[parent]))
        taken = [text for node, text in self.blocks if inside[node]]
        if path is not None and (sum(map(len, taken)) < DOMINANT * self.sizes[0] or self._cuts(inside)):
            return None
        return "\n".join(taken)

    def _cuts(self, inside: list[bool]) -> bool:
        """Whether some article has blocks both inside and outside."""
        tops: list[int] = []  # the outermost article around each element, or -1
        for node, parent in enumerate(self.parents):
            around = tops[parent] if parent >= 0 else -1
            tops.append(around if around >= 0 or not self.whole[node] else node)
        both: dict[int, set[bool]] = {}
        for node, _ in self.blocks:
            if tops[node] >= 0:
                both.setdefault(tops[node], set()).add(inside[node])
        return any(len(x) > 1 for x in both.values())

    def leave_out(self) -> None:
        """Take out the text of marked elements, except those that enclose an article or hold most of the page's text."""
        if not any(self.marks):
            return
        replies = [False]
        for node, parent in enumerate(self.parents[1:], 1):
            replies.append(replies[parent] or not REPLIES.isdisjoint(self.marks[node]))
        encloses = [False] * len(self.parents)
        for node in range(len(self.parents) - 1, 0, -1):
            encloses[node] |= self.article[node] and self.sizes[node] > 0
            if encloses[node] and not replies[node]:
                encloses[self.parents[node]] = True
        # with an article elsewhere, even a long advert is one
        most = DOMINANT * self.sizes[0] if not encloses[0] else math.inf
        out = [False]
        for node, parent in enumerate(self.parents[1:], 1):
            spared = not replies[node] and (encloses[node] or self.sizes[node] >= most)
            out.append(out[parent] or (bool(self.marks[node]) and not spared))
        kept = [(block, prose) for block, prose in zip(self.blocks, self.block_prose) if not out[block[0]]]
        self.container = [c and not o for c, o in zip(self.container, out)]
        self.blocks, self.block_prose = [b for b, _ in kept], [p for _, p in kept]
        self.count()

    def count(self) -> None:
        """How much text each element holds, its own and that of all below it."""
        self.sizes, self.prose = [0] * len(self.parents), [0] * len(self.parents)
        for (node, text), prose in zip(self.blocks, self.block_prose):
            self.sizes[node] += len(text)
            self.prose[node] += prose
        for node in range(len(self.parents) - 1, 0, -1):
            self.sizes[self.parents[node]] += self.sizes[node]
            self.prose[self.parents[node]] += self.prose[node]


def _mark_of(token: str) -> str | None:
    """The mark that a class, id or role is: as a whole, by its last part, or by its first with nothing telling after it."""
    parts = [w for w in _WORD.findall(token) if not w.isdigit()]
    if not parts or (len(parts) > 1 and parts[0] in ABOUT):
        return None
    if parts[-1] in MARKS:
        return parts[-1]
    return parts[0] if parts[0] in MARKS and PIECES.issuperset(parts[1:]) else None


def _marks(name: str, tokens: list[str], words: list[str], in_article: bool) -> set[str]:
    """The marks among the classes, id and role of an element; headers of articles are none."""
    marked = {m for m in map(_mark_of, tokens) if m}
    if in_article or not OWN_HEADERS.isdisjoint(words):
        marked.discard("header")
    # an article is what it says, unless a reader wrote it
    return marked & REPLIES if name in ("article", "main") else marked


def _is_left_out(name: str, words: list[str], in_article: bool) -> bool:
    return name in LEFT_OUT or (name == "header" and not in_article and OWN_HEADERS.isdisjoint(words))


def parse(source: str, by_marks: bool = True) -> Page:
    """The page read; without regard to marks when they would leave nothing of it."""
    page = Page()
    hidden = False  # whether a mark has left out anything at once
    # the open elements: (name, node, left out, inside an article, inside a link of the same block)
    stack: list[tuple[str, int, bool, bool, bool]] = [("", 0, False, False, False)]
    held: list[str] = []
    plain = False  # whether some of what is held is no link
    opened: Counter[str] = Counter()  # names on the stack
    at, end = 0, len(source)
    last = source.rfind(">") + 1  # beyond it nothing is a tag
    sections = source.rfind("]]>")  # beyond it no section ends

    def close_block(node: int) -> None:
        nonlocal plain
        text = " ".join("".join(held).split())
        held.clear()
        prose, plain = len(text) * plain, False
        if text:
            page.blocks.append((node, text))
            page.block_prose.append(prose)

    def shut(depth: int) -> None:
        opened.subtract(name for name, *_ in stack[depth:])
        del stack[depth:]

    while at < end:
        found = _TAG.search(source, at, last) if at < last else None
        open_comment = -1 if found else source.find("<!--", at)
        upto = found.start() if found else open_comment if open_comment >= 0 else end
        if upto > at and not stack[-1][2]:
            held.append(entities.unescape(source[at:upto]))
            plain = plain or (not stack[-1][4] and any(map(str.isalnum, held[-1])))
        if not found:
            break
        at = found.end()
        if found["comment"] is not None:
            # an open comment goes on to the end of the page
            at = at if len(found["comment"]) >= 7 and found["comment"].endswith("-->") else end
            continue
        if found["cdata"] is not None:
            if at > sections:
                at = source.index(">", at) + 1
                continue
            close = source.index("]]>", at)
            if not stack[-1][2]:
                held.append(source[at:close])
                plain = plain or not stack[-1][4]
            at = close + 3
            continue
        name = (found["name"] or "").lower()
        if not name:
            continue
        if found["end"]:
            if opened[name]:
                depth = next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name)
                if any(n not in INLINE for n, *_ in stack[depth:]):
                    close_block(stack[-1][1])
                shut(depth)
            continue
        if name in RAW:
            close = _RAW_END[name].search(source, at)
            at = close.end() if close else end
            continue
        if name in INLINE:
            if name == "br":
                held.append(" ")
            if name in VOID:
                continue
        else:
            close_block(stack[-1][1])
            # a block ends an open paragraph, and items and cells end those before them
            ending = CLOSES.get(name, set()) | {"p"} | ({"h1", "h2", "h3", "h4", "h5", "h6"} if name[:1] == "h" and name[1:].isdigit() else set())
            for i in range(len(stack) - 1, 0, -1):
                if not any(opened[n] for n in ending):
                    break
                if stack[i][0] in ending:
                    shut(i)
                elif stack[i][0] in SCOPES and stack[i][0] not in CLOSES:
                    break
            if name in VOID:
                continue
        if found["rest"].rstrip().endswith("/") and name not in CONTAINERS and name not in INLINE and name != "p":
            continue
        described: dict[str, str] = {}
        for kind, *values in _ATTRIBUTE.findall(found["rest"]) if "=" in found["rest"] else ():
            described.setdefault(kind.lower(), next((v for v in values if v), "").lower())
        words = [w for v in described.values() for w in _WORD.findall(v)]
        tokens = [t for v in described.values() for t in v.split()]
        _, parent, left_out, in_article, in_link = stack[-1]
        left_out = left_out or _is_left_out(name, words, in_article)
        marks = _marks(name, tokens, words, in_article) if by_marks and tokens and name not in ("html", "body") else set()
        if marks and name in INLINE:
            left_out, hidden = True, True
        classes = ".".join(sorted({re.sub("[0-9]+", "#", c) for c in described.get("class", "").split()}))
        node = len(page.parents)
        page.parents.append(parent)
        page.steps.append(f"/{name}.{classes}" if classes else f"/{name}")
        page.container.append(name in CONTAINERS and not left_out)
        page.whole.append(page.whole[parent] or (name not in ("html", "body") and not WHOLE.isdisjoint([name, *words])))
        page.marks.append(marks)
        page.article.append(name in ("article", "main"))
        linked = name in INLINE and (in_link or (name == "a" and "href" in found["rest"].lower()))
        opened[name] += 1
        stack.append((name, node, left_out, in_article or name == "article", linked))
    close_block(stack[-1][1])
    marked = hidden or any(page.marks)
    page.count()
    page.leave_out()
    return parse(source, False) if marked and not page.sizes[0] else page


def host_of(url: Column) -> Column:
    """The host of a url in lower case; empty without one."""
    found = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


def paths_of_hosts(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, paths): for each host the container paths that enough of its pages chose, most votes first."""
    rows = pages.select(host_of(pages[url]).alias("host"), text_of(pages, html).alias("html"))

    def vote(batches):
        for batch in batches:
            chosen = []
            for source in batch.column("html").to_pylist():
                page = parse(source)
                chosen.append(page.path(page.choice()) if page.sizes[0] else None)
            yield pa.record_batch([batch.column("host"), pa.array(chosen, pa.string())], ["host", "path"])

    votes = rows.mapInArrow(vote, "host STRING, path STRING").filter("path IS NOT NULL")
    votes = store(votes.groupBy("host", "path").agg(F.count("*").alias("n")), "container_votes")
    totals = votes.groupBy("host").agg(F.sum("n").alias("all"))
    winners = votes.join(totals, "host").filter(F.col("n") >= LEAST_VOTES * F.col("all"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "path")))
    return store(winners.groupBy("host").agg(ranked.alias("ranked")).select("host", F.col("ranked.path").alias("paths")), "host_paths")


def main_texts(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of `pages`: key, url, text, n_chars and path, the container it was taken from.

    Null and empty pages have empty text and no path. Pages without url form one host. Repeated rows vote
    and are read each for itself. An empty table gives no rows.
    """
    winners = paths_of_hosts(pages, url, html)
    rows = pages.select(
        pages[key].alias("key"), pages[url].alias("url"), host_of(pages[url]).alias("host"), text_of(pages, html).alias("html")
    )
    # few hosts go to all tasks; many are joined by shuffle, where a large host is split
    rows = rows.join(F.broadcast(winners) if fits_broadcast(winners, 20_000) else winners, "host", "left")

    def extract(batches):
        for batch in batches:
            texts, paths = [], []
            for source, offered in zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist()):
                page = parse(source)
                text, taken = None, None
                if page.sizes[0]:
                    own = page.path(page.choice())
                    for taken in () if own in (offered or ()) else offered or ():
                        text = page.text(taken)
                        if text is not None:
                            break
                    else:
                        text, taken = page.text(None), own
                texts.append(text or "")
                paths.append(taken)
            sizes = pa.array(list(map(len, texts)), pa.int64())
            columns = [batch.column("key"), batch.column("url"), pa.array(texts, pa.string()), sizes, pa.array(paths, pa.string())]
            yield pa.record_batch(columns, [key, "url", "text", "n_chars", "path"])

    kind = rows.schema["key"].dataType.simpleString()
    link = rows.schema["url"].dataType.simpleString()
    layout = f"`{key}` {kind}, url {link}, text STRING, n_chars BIGINT, path STRING"
    return rows.select("key", "url", "html", "paths").mapInArrow(extract, layout)
