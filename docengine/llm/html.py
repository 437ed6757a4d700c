"""Main text of web pages by inferred wrappers.

A page is a stream of tags and texts.  Streams of one host are aligned one after the other
into a wrapper, a regular expression without unions: equal tokens stay, equal neighbours
become a repeated group, tokens that one side lacks become an optional group, and differing
texts become a text slot.  Aligning two wrappers is the same operation, so each task folds
its pages of a host into one wrapper and wrappers are merged as a tree (host and salt, host and
fewer salts, host): a hot host costs a few small rows per task, never its pages in one task.  A
wrapper of more than NODES elements forgets its rarest optional groups, so its size is bounded,
and says so (``cut``).  The pages of such a host are taken again, with a row for each place (the
names from the page down to an element): sums by host and place forget none, however many there
are, and the same rules judge them.

The wrapper adds up, per element, pages, text, link text and text that never varies, and that
decides what is beside the article.  An element is, if it is one by HTML (nav, footer, form and
the like; a header outside the article); if most of its text is links; if all pages of the host
have it with the same text (three pages at least, and only while most of the host's text
varies, so copies of a page do not hide it); or if its class says so and it is a small part
(MINOR) of the text, or an optional or repeated group that holds less than half of it.  The main
element is the innermost container with most of what is left; elements beside it are cut
from it by their place in the wrapper.  A page that lacks the main element is its own wrapper.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.llm.common import materialise

SALTS = (1024, 32)  # groups of the first two merge steps
SPREAD = 64  # groups over which the pages of a host are dealt when its plan joins them
NODES = 3000  # elements of a wrapper
HOSTS = 500  # hosts of which a task holds a wrapper at a time
DEPTH = 200  # nesting that is kept; what is nested deeper counts as part of its ancestor there
MAJOR = 0.5  # share of the text that the main element's container must hold
NAMED = 0.05  # share from which a container named article or main is the main element, whatever stands beside it
MINOR = 0.25

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    # Drawings that end in their own tag; raw text, which only its end tag ends; other elements without text of the page, if they end.
    r"|<svg(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^>\"'])*/>"
    r"|<(script|style|textarea|title)(?=[\s/>]).*?(?:</\1\s*>|\Z)|<(noscript|template|svg|iframe|select)(?=[\s/>]).*?</\2\s*>"
    # A quote only opens a value right after the equals sign.
    r"|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)>?|<[!?/][^>]*>?|[^<]+|<",
    re.S | re.I,
)
_NAME = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
# Element names of HTML.
_INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = set("area base col embed head hr link meta param source track".split())  # and head, whose tags may be missing
_PARAGRAPHS = set("p h1 h2 h3 h4 h5 h6 pre blockquote address figcaption dt dd li caption td th".split())
_PROSE = set("p h1 h2 h3 h4 h5 h6 pre blockquote td th tr tbody".split())
_CLOSES_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_ASIDE = set("nav footer aside form button menu dialog fieldset".split())
_ASIDE_WORDS = set(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads adv advert advertisement advertising sponsor sponsored promo banner cookie cookies consent notice "
    "alert popup modal overlay comment comments disqus respond reply share sharing social related recommended breadcrumb breadcrumbs login signup newsletter subscribe search "
    "form widget toolbar pagination pager tags skip copyright".split()
)


class Node:
    """An element of a page or of a wrapper.  A text is a node named ``#``; ``fixed`` is text that is alike on all its pages; a root is ``cut`` if groups were forgotten."""

    __slots__ = ("name", "repeated", "optional", "pages", "chars", "links", "fixed", "text", "kids", "cut")

    def __init__(self, name: str, text: str | None = None, links: int = 0):
        self.name, self.text, self.kids = name, text, []
        self.repeated = self.optional = self.cut = False
        self.pages, self.chars, self.links = 1, len(text or ""), links
        self.fixed = self.chars

    def dump(self) -> list:
        return [self.name, self.repeated, self.optional, self.pages, self.chars, self.links, self.fixed, self.text, [k.dump() for k in self.kids], self.cut]

    @staticmethod
    def load(row: list) -> "Node":
        node = Node(row[0])
        _, node.repeated, node.optional, node.pages, node.chars, node.links, node.fixed, node.text, kids, node.cut = row
        node.kids = [Node.load(k) for k in kids]
        return node

    def summed(self) -> None:
        """Fixed text of an element from its children's."""
        if self.name != "#":
            self.fixed = sum(k.fixed for k in self.kids)
        elif self.text is None:
            self.fixed = 0

    def expression(self) -> str:
        """The wrapper as a readable expression."""
        own = "#" if self.name == "#" and self.text is None else repr(self.text) if self.name == "#" else f"<{self.name}>{''.join(k.expression() for k in self.kids)}</{self.name}>"
        return f"({own}){'+' if self.repeated else ''}{'?' if self.optional else ''}" if self.repeated or self.optional else own


def _label(name: str, attributes: str) -> str:
    if name in ("html", "body", "article", "main", "p") or "=" not in attributes:
        return name
    found = [re.sub(r"\d+", "0", (m[1] or m[2] or m[3] or "").strip().lower()) for m in _NAME.finditer(attributes)]
    return ".".join([name, *[" ".join(x.split()) for x in found if x]])


def parse(page: str) -> Node:
    """The page's elements, with tag soup closed as browsers do it: an open p ends at the next block, li at li."""
    root = Node("page")
    stack, names = [root], ["page"]
    text: list[str] = []
    link = links = 0

    def flush() -> None:
        nonlocal links
        joined = " ".join(entities.unescape("".join(text)).split())
        if joined:
            stack[-1].kids.append(Node("#", joined, min(links, len(joined))))
        text.clear()
        links = 0

    for m in _TOKEN.finditer(page):
        name = m[4]
        if name is None:
            token = m[0]
            if token[0] != "<" or token == "<":
                text.append(token)
                links += link and len(token)
            continue
        name = name.lower()
        if name in _INLINE:
            if name == "a":
                link = 0 if m[3] else 1
            elif name == "br":
                text.append(" ")
            continue
        flush()
        if m[3]:
            if name in names:
                while True:
                    stack.pop()
                    if names.pop() == name:
                        break
            continue
        if name in _VOID:
            continue
        if names[-1] == "p" and name in _CLOSES_P or names[-1] == name and name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            stack.pop()
            names.pop()
        node = Node(_label(name, m[5] or ""))
        if len(stack) < DEPTH:
            stack[-1].kids.append(node)
        if not (m[5] or "").rstrip().endswith("/"):
            stack.append(node if len(stack) < DEPTH else stack[-1])
            names.append(name)
    flush()
    return root


def _fold(kids: list[Node]) -> list[Node]:
    """Equal neighbours become one repeated element; so do groups of two to four elements in a row."""
    out: list[Node] = []
    for kid in kids:
        if out and out[-1].name == kid.name:
            pages = max(out[-1].pages, kid.pages)
            out[-1] = align(out[-1], kid)
            out[-1].repeated, out[-1].pages = True, pages
        else:
            out.append(kid)
    for width in (2, 3, 4):
        i = 0
        while i + 2 * width <= len(out):
            if [k.name for k in out[i : i + width]] == [k.name for k in out[i + width : i + 2 * width]]:
                for j in range(width):
                    pages = max(out[i + j].pages, out[i + width + j].pages)
                    out[i + j] = align(out[i + j], out[i + width + j])
                    out[i + j].repeated, out[i + j].pages = True, pages
                del out[i + width : i + 2 * width]
            else:
                i += 1
    return out


def wrapper(node: Node) -> Node:
    """The wrapper of one page: repeats folded, sums filled in."""
    kids = _fold([wrapper(k) for k in node.kids])
    made = Node(node.name, node.text, node.links)
    made.kids = kids
    if node.name != "#":
        made.chars, made.links = sum(k.chars for k in kids), sum(k.links for k in kids)
    made.summed()
    return made


def _matches(a: list[Node], b: list[Node]) -> list[tuple[int, int]]:
    """Children of the same name to align, in ascending order on both sides, in O(n log n).

    The k-th child of a name from the front goes with the k-th, and so from the back; a longest
    ascending chain of these pairs is taken.
    """
    if [k.name for k in a] == [k.name for k in b]:
        return [(i, i) for i in range(len(a))]
    places: dict[str, tuple[list[int], list[int]]] = {}
    for side, kids in enumerate((a, b)):
        for i, k in enumerate(kids):
            places.setdefault(k.name, ([], []))[side].append(i)
    pairs = {p for x, y in places.values() for p in [*zip(x, y), *zip(x[::-1], y[::-1])]}
    tops: list[int] = []  # least end on the b side of a chain of each length
    ends: list[tuple] = []
    for i, j in sorted(pairs, key=lambda p: (p[0], -p[1])):  # descending on the b side, so that no chain takes a child twice
        n = bisect_left(tops, j)
        link = (i, j, ends[n - 1] if n else None)
        tops[n : n + 1], ends[n : n + 1] = [j], [link]
    out, link = [], ends[-1] if ends else None
    while link:
        out.append(link[:2])
        link = link[2]
    return out[::-1]


def align(a: Node, b: Node) -> Node:
    """The wrapper of both: mismatches become optional or repeated groups and text slots."""
    out = Node(a.name, a.text if a.text == b.text else None)
    out.repeated, out.optional, out.cut = a.repeated or b.repeated, a.optional or b.optional, a.cut or b.cut
    out.pages, out.chars, out.links = a.pages + b.pages, a.chars + b.chars, a.links + b.links
    kids, i, j = [], 0, 0
    for x, y in [*_matches(a.kids, b.kids), (len(a.kids), len(b.kids))]:
        for k in [*a.kids[i:x], *b.kids[j:y]]:
            k.optional = True
            kids.append(k)
        if x < len(a.kids):
            kids.append(align(a.kids[x], b.kids[y]))
        i, j = x + 1, y + 1
    out.kids = _fold(kids)
    out.summed()
    return out


def bounded(root: Node) -> Node:
    """The wrapper without its rarest optional groups, if it has more than NODES elements; sums stay as they are."""
    own: list[tuple[int, int, Node]] = []

    def walk(node: Node, depth: int) -> None:
        for k in node.kids:
            own.append((k.pages, -depth, k))
            walk(k, depth + 1)

    walk(root, 0)
    if len(own) > NODES:
        rare = {id(k) for _, _, k in sorted(own, key=lambda x: x[:2])[: len(own) - NODES // 2] if k.optional}

        def cut(node: Node) -> None:
            node.kids = [k for k in node.kids if id(k) not in rare]
            for k in node.kids:
                cut(k)

        cut(root)
        root.cut = root.cut or bool(rare)
    return root


def _by_tag(name: str, inside: bool) -> bool:
    tag = name.split(".")[0]
    return tag in _ASIDE or tag == "header" and not inside


def _by_class(name: str) -> bool:
    return any(w in _ASIDE_WORDS for part in name.split(".")[1:] for w in re.split(r"[^a-z]+", part))


def _listed(k: Node) -> int:
    """Text of an element in repeated elements, as comments and teasers are; paragraphs are no list."""
    listed, left = 0, [k]
    while left:
        for x in left.pop().kids:
            if x.repeated and x.name != "#" and x.name.split(".")[0] not in _PROSE:
                listed += x.chars
            else:
                left.append(x)
    return listed


def _named(name: str) -> bool:
    return name in ("article", "main")


def _judged_alone(name: str) -> bool:
    """Whether links and constant text may put an element beside the article."""
    return name.split(".")[0] not in _PARAGRAPHS and name not in ("article", "main", "body", "html")


def _next(options: list[tuple[bool, int, bool, object]], total: int):
    """The container to go down to, of (named, text, repeated, container), or None."""
    named = [o for o in options if o[0] and not o[2] and o[1] >= NAMED * total]
    options = named or [o for o in options if o[1] >= MAJOR * total] or [o for o in options if o[0] and o[1] >= 0.2 * total]
    return max(options, key=lambda o: (o[0], o[1]))[3] if options else None


class Plan:
    """What a wrapper says: names from the page down to the main element, and the places of elements beside the article."""

    def __init__(self, root: Node):
        self.root = root
        self.varied = root.pages >= 3 and 2 * root.fixed < root.chars  # else the pages are few, or copies of each other
        self.whole = max(self._good(root, False, False), 1)
        self.main = self._main()
        self.beside: set[str] = set()
        self._places(root, "", False)

    def _beside(self, k: Node, inside: bool) -> bool:
        if _by_tag(k.name, inside):
            return True
        if _judged_alone(k.name):
            if 2 * k.links > k.chars and not inside:  # an article may list links
                return True
            if self.varied and k.chars and k.fixed == k.chars and k.pages >= self.root.pages:
                return True
        if not _by_class(k.name):
            return False
        if 2 * _listed(k) > k.chars:
            return True
        own = self._good(k, inside, False)
        return own < MINOR * self.whole or (k.optional or k.repeated) and 2 * own < self.whole

    def _good(self, node: Node, inside: bool, judged: bool) -> int:
        """Text of a wrapper element that may be the article's; ``judged`` leaves out what is beside it."""
        if node.name == "#":
            return max(node.chars - 2 * node.links, 0)
        inside = inside or node.name in ("article", "main")
        return sum(self._good(k, inside, judged) for k in node.kids if k.name == "#" or not (self._beside(k, inside) if judged else _by_tag(k.name, inside)))

    def _main(self) -> list[str]:
        path, node, inside = [], self.root, False
        total = max(self._good(node, False, True), 1)
        while True:
            inside = inside or node.name in ("article", "main")
            below = [k for k in node.kids if k.name != "#" and k.name.split(".")[0] not in _PARAGRAPHS and not self._beside(k, inside)]
            below = [k for k in below if not inside or k.name in ("article", "main")]  # an article is not cut down to a part of it
            node = _next([(_named(k.name), self._good(k, inside, True), k.repeated, k) for k in below], total)
            if node is None:
                return path
            path.append(node.name)

    def _places(self, node: Node, at: str, inside: bool) -> None:
        inside = inside or node.name in ("article", "main")
        for k in node.kids:
            if k.name != "#":
                place = f"{at}/{k.name}"
                if self._beside(k, inside):
                    self.beside.add(place)
                else:
                    self._places(k, place, inside)

    def dump(self) -> str:
        return json.dumps([self.main, sorted(self.beside)])


def extract(page: Node, main: list[str], beside: set[str]) -> list[str]:
    """Blocks of the elements that the path ``main`` names, without those at the places ``beside``; a page without them is its own wrapper."""
    found = [page]
    for name in main:
        found = [k for node in found for k in node.kids if k.name == name]
        if not found:
            own = Plan(wrapper(page))
            return [] if own.main == main else extract(page, own.main, own.beside)
    blocks: list[str] = []

    def walk(node: Node, at: str, inside: bool) -> None:
        for k in node.kids:
            if k.name == "#":
                blocks.append(k.text)
            elif f"{at}/{k.name}" not in beside and not _by_tag(k.name, inside):
                walk(k, f"{at}/{k.name}", inside or k.name in ("article", "main"))

    for node in found:
        walk(node, "".join(f"/{x}" for x in main), any(x in ("article", "main") for x in main))
    return blocks


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper for each host of a task (or of HOSTS hosts of it at a time)."""
    task = TaskContext.get()
    salt = task.partitionId() if task else 0
    found: dict[str, Node] = {}

    def flush():
        nonlocal salt
        rows = sorted(found.items())
        found.clear()
        salt += 7919
        return pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in rows], pa.string()), pa.array([salt % SALTS[0]] * len(rows), pa.int32()), pa.array([json.dumps(w.dump()) for _, w in rows], pa.string())],
            names=["host", "salt", "wrapper"],
        )

    for batch in batches:
        for url, page in zip(batch.column(0), batch.column(1)):
            host, own = host_of(url.as_py()), wrapper(parse(page.as_py() or ""))
            found[host] = bounded(align(found[host], own) if host in found else own)
            if len(found) >= HOSTS:
                yield flush()
    if found:
        yield flush()


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    done = None
    for text in sorted(rows["wrapper"]):
        own = Node.load(json.loads(text))
        done = own if done is None else bounded(align(done, own))
    return pd.DataFrame({"host": [rows["host"].iloc[0]], "salt": [rows["salt"].iloc[0] % SALTS[1]], "wrapper": [json.dumps(done.dump())]})


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): one wrapper per host, from all its pages."""
    kind = "host string, salt int, wrapper string"
    parts = pages.select("url", "html").mapInArrow(_fold_pages, kind)
    for keys in (["host", "salt"], ["host", "salt"], ["host"]):
        parts = parts.groupBy(*keys).applyInPandas(_merge, kind)
    return parts.select("host", "wrapper")


def _extract_pages(at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans: dict[str, tuple[list[str], set[str]]] = {}
        for batch in batches:
            texts = []
            for page, plan in zip(batch.column(at), batch.column(at + 1)):
                plan = plan.as_py()
                if plan not in plans:
                    if len(plans) > 1000:
                        plans.clear()
                    path, beside = json.loads(plan)
                    plans[plan] = path, set(beside)
                texts.append("\n".join(extract(parse(page.as_py() or ""), *plans[plan])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=names)

    return run


def _plans(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        nodes = [Node.load(json.loads(w.as_py())) for w in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([Plan(n).dump() for n in nodes], pa.string()), pa.array([n.cut for n in nodes], pa.bool_())], names=["host", "plan", "cut"])


def _place_sums(root: Node) -> dict[str, list]:
    """Place -> [text, text in links, text that may be the article's, text in lists, repeated, inside the article, digest of its one text] in a page's wrapper.

    Texts have a place too; elements that HTML puts beside the article, and what is in them, have none.
    """
    out: dict[str, list] = {}

    def add(place: str, *sums) -> None:
        if row := out.get(place):
            row[:4] = [x + y for x, y in zip(row, sums)]
            row[4], row[6] = True, row[6] if row[6] == sums[6] else None
        else:
            out[place] = list(sums)

    def walk(node: Node, place: str, inside: bool, apart: bool) -> int:
        within, good = inside or _named(node.name), 0
        for k in node.kids:
            at = f"{place}{SEP}{k.name}"
            if k.name == "#":
                text = None if k.text is None else int.from_bytes(hashlib.blake2b(k.text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)
                good += max(k.chars - 2 * k.links, 0)
                add(at, k.chars, k.links, 0, 0, k.repeated, within, text)
            elif apart or _by_tag(k.name, within):
                walk(k, at, within, True)
            else:
                good += walk(k, at, within, False)
        if not apart:
            add(place, node.chars, node.links, good, _listed(node) if _by_class(node.name) else 0, node.repeated, inside, None)
        return good

    walk(root, "", False, False)
    return out


def _last(place: str) -> str:
    return place.rsplit(SEP, 1)[-1]


def _pages_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of places for pages (host, html)."""
    for batch in batches:
        for host, page in zip(batch.column(0), batch.column(1)):
            found = _place_sums(wrapper(parse(page.as_py() or "")))
            names = [_last(p) for p in found]
            columns = [[host.as_py()] * len(found), list(found), [p.rpartition(SEP)[0] for p in found], *zip(*found.values()), [_judged_alone(n) for n in names], [_by_class(n) for n in names]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PLACE_TYPES)], names=_PLACE_NAMES)


SEP = "\x1f"  # between the names of a place; names hold no white space but blanks
_PLACE_NAMES = ["host", "place", "parent", "chars", "links", "good", "listed", "repeated", "inside", "text", "alone", "classed"]
_PLACE_TYPES = [pa.string()] * 3 + [pa.int64()] * 4 + [pa.bool_()] * 2 + [pa.int64()] + [pa.bool_()] * 2
_PLACE_KIND = "host string, place string, parent string, chars long, links long, good long, listed long, repeated boolean, inside boolean, text long, alone boolean, classed boolean"


def places(pages: DataFrame) -> DataFrame:
    """(host, place, parent, repeated, beside): what Plan says of the elements of a wrapper, for every place of the hosts of ``pages`` (host, html)."""
    rows = pages.select("host", "html").mapInArrow(_pages_places, _PLACE_KIND)
    most = lambda *names: [F.max(c).alias(c) for c in names]
    sums = rows.groupBy("host", "place", "parent").agg(
        F.count(F.lit(1)).alias("pages"), *[F.sum(c).alias(c) for c in ("chars", "links", "good", "listed")], *most("repeated", "inside", "alone", "classed"),
        ((F.count("text") == F.count(F.lit(1))) & (F.min("text") == F.max("text"))).alias("same"),
    )
    sums = materialise(sums)
    text = F.endswith("place", F.lit(f"{SEP}#"))
    parts = F.split("place", SEP)
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), SEP))
    fixed = sums.where(text & F.coalesce("same", F.lit(False))).select("host", F.explode(above).alias("place"), "chars").groupBy("host", "place").agg(F.sum("chars").alias("fixed"))
    elements = sums.where(~text).join(fixed, ["host", "place"], "left").withColumn("fixed", F.coalesce("fixed", F.lit(0)))
    roots = elements.where("place = ''").select(
        "host", F.greatest("good", F.lit(1)).alias("whole"), F.col("pages").alias("all_pages"), ((F.col("pages") >= 3) & (2 * F.col("fixed") < F.col("chars"))).alias("varied")
    )
    over = sums.where(~text).select("host", F.col("place").alias("parent"), F.col("pages").alias("over"))
    known = elements.where("place <> ''").join(over, ["host", "parent"]).join(roots, "host")
    optional = F.col("pages") < F.col("over")
    constant = F.col("varied") & (F.col("chars") > 0) & (F.col("fixed") == F.col("chars")) & (F.col("pages") >= F.col("all_pages"))
    small = (F.col("good") < MINOR * F.col("whole")) | (optional | F.col("repeated")) & (2 * F.col("good") < F.col("whole"))
    beside = F.col("alone") & ((2 * F.col("links") > F.col("chars")) & ~F.col("inside") | constant) | F.col("classed") & ((2 * F.col("listed") > F.col("chars")) | small)
    return known.select("host", "place", "parent", "repeated", beside.alias("beside"))


def _pages_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, digest, place) of the elements of pages (host, digest, html)."""
    for batch in batches:
        for host, digest, page in zip(*batch.columns):
            own = sorted(p for p, row in _place_sums(wrapper(parse(page.as_py() or ""))).items() if p and _last(p) != "#")
            yield pa.RecordBatch.from_arrays([pa.array([x.as_py()] * len(own), pa.string()) for x in (host, digest)] + [pa.array(own, pa.string())], names=["host", "digest", "place"])


def _pages_good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, place, good): text of the places of pages (host, html, beside) that is not beside the article."""
    for batch in batches:
        for host, page, beside in zip(*batch.columns):
            out, apart = {}, set(beside.as_py() or [])

            def walk(node: Node, place: str, inside: bool) -> int:
                inside, good = inside or _named(node.name), 0
                for k in node.kids:
                    at = f"{place}{SEP}{k.name}"
                    if k.name == "#":
                        good += max(k.chars - 2 * k.links, 0)
                    elif at not in apart and not _by_tag(k.name, inside):
                        good += walk(k, at, inside)
                out[place] = out.get(place, 0) + good
                return good

            walk(wrapper(parse(page.as_py() or "")), "", False)
            yield pa.RecordBatch.from_arrays([pa.array([host.as_py()] * len(out), pa.string()), pa.array(list(out), pa.string()), pa.array(list(out.values()), pa.int64())], names=["host", "place", "good"])


def _main_place(rows: pd.DataFrame) -> pd.DataFrame:
    """The main element of a host from its places with a share NAMED of the text, of which there are few at each depth."""
    below: dict[str, list] = {}
    for place, good, repeated in zip(rows["place"], rows["good"], rows["repeated"]):
        if place:
            below.setdefault(place.rpartition(SEP)[0], []).append((_named(_last(place)), int(good), bool(repeated), place))
    total, place, inside = int(rows["total"].iloc[0]), "", False
    while True:
        options = [o for o in sorted(below.get(place, []), key=lambda o: o[3]) if (o[0] if inside else _last(o[3]).split(".")[0] not in _PARAGRAPHS)]
        lower = _next(options, total)
        if lower is None:
            return pd.DataFrame({"host": [rows["host"].iloc[0]], "main": [place.split(SEP)[1:]]})
        place, inside = lower, inside or _named(_last(lower))


def _wide_plans(pages: DataFrame) -> DataFrame:
    """``pages`` (row, html, host) of hosts whose wrappers were cut, each with a plan: its host's main element and its own places beside it."""
    place = materialise(places(pages))
    known = pages.withColumn("digest", F.sha2(F.coalesce("html", F.lit("")), 256))
    own = known.select("host", "digest", "html").mapInArrow(_pages_own, "host string, digest string, place string").distinct()
    apart = own.join(place.where("beside").select("host", "place"), ["host", "place"]).groupBy("host", "digest").agg(F.sort_array(F.collect_list("place")).alias("apart"))
    told = materialise(known.join(apart, ["host", "digest"], "left").select("row", "html", "host", "apart"))
    good = materialise(told.select("host", "html", "apart").mapInArrow(_pages_good, "host string, place string, good long").groupBy("host", "place").agg(F.sum("good").alias("good")))
    total = good.where("place = ''").select("host", F.greatest("good", F.lit(1)).alias("total"))
    large = good.join(total, "host").where((F.col("good") >= NAMED * F.col("total")) | (F.col("place") == "")).join(place.select("host", "place", "repeated"), ["host", "place"], "left")
    mains = large.withColumn("repeated", F.coalesce("repeated", F.lit(False))).groupBy("host").applyInPandas(_main_place, "host string, main array<string>")
    beside = F.transform(F.coalesce("apart", F.array().cast("array<string>")), lambda p: F.replace(p, F.lit(SEP), F.lit("/")))
    plan = F.concat(F.lit("["), F.to_json("main"), F.lit(","), F.to_json(beside), F.lit("]"))
    return _with_host(told, mains).select("row", "html", plan.alias("plan"))


def _with_host(pages: DataFrame, rows: DataFrame) -> DataFrame:
    """``pages`` with the one row of their host.  A hot host's pages are spread over SPREAD groups; its row is repeated for each."""
    spread = pages.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SPREAD)).cast("int"))
    every = rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    return spread.join(every, ["host", "salt"])


def main_text(pages: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``.

    A null html counts as empty and gives the empty text; pages without a url share the host "".
    Very long pages are read whole.  Repeated rows get equal texts, extra columns are ignored
    unless carried, and an empty table gives an empty result.
    """
    carry = ["page_id", "url", *[c for c in carry or [] if c not in ("page_id", "url", "text", "n_chars")]]
    plans = materialise(wrappers(pages).mapInArrow(_plans, "host string, plan string, cut boolean"))
    host = F.pandas_udf(lambda urls: urls.map(lambda u: host_of(u if isinstance(u, str) else None)), "string")
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in carry)
    # A hot host's pages are spread over SPREAD groups; its one plan is repeated for each.
    spread = pages.select(*carry, "html", host("url").alias("host"), F.pmod(F.xxhash64("url", "html"), F.lit(SPREAD)).cast("int").alias("salt"))
    every = plans.where("NOT cut").select("host", "plan", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("salt"))
    joined = spread.join(every, ["host", "salt"]).select(*carry, "html", "plan")
    wide = plans.where("cut").select("host")
    if not wide.isEmpty():
        row = pages.select(F.struct(*carry).alias("row"), "html", host("url").alias("host"))
        joined = joined.union(_wide_plans(_with_host(row, wide).select("row", "html", "host")).select(*[F.col("row")[c].alias(c) for c in carry], "html", "plan"))
    return joined.mapInArrow(_extract_pages(len(carry), [*carry, "text", "n_chars"]), f"{schema}, text string, n_chars long")
