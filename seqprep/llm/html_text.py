"""Main text of web pages by wrapper induction.

The texts of all pages of a host are counted, each with the tags and classes around it. Of
those that enough stories hold, two pages each are aligned by simple tree matching: equal
tags and classes match in order, and the matching with the most nodes around equal texts
wins. Texts that two of them share at one place are candidates. Then every page of the host
is aligned with these and votes: candidates that most of the host's stories hold are constant nodes, the
host's template; all else are slots. Pages with the same longest block tell one story,
so copies have one vote. In the end every page is aligned with the template. What stands
in a constant node is dropped, inside the article and outside it, and so are regions
whose tag, class, id or role says what they are (menus, headers, footers, sidebars,
notices, adverts, forms, reader comments). The text of the slots that are left in the
article is the main text.

The article is the page's largest <article>, with all others in the same <main>, else
the largest <main>, else the innermost element with most of the text of the slots; there,
blocks that are mostly links are dropped too. Constant nodes that hold more than half
of a marked article stay: such a page is a near copy of others, its story no template.

Cases: a null or empty html has an empty text. Pages cut off in the middle are read to
their end. A host of one page, or of one story, has no template. A page without a URL
belongs to the host without a name. Of articles of equal size in no common <main> the
first one counts. Repeated rows each get a result. Pages of any length and depth
are read whole; a task holds one page's tree at a time. An empty table has an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as html_entities
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Container, Iterable, Iterator, Sequence
from functools import lru_cache
from typing import TypeVar

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.llm.arrays import chunks
from seqprep.llm.shared import materialise, quoted, small, small_batches, table

#: A candidate is constant if this share of the host's stories, and two of them, hold it.
CONSTANT_SHARE = 0.6
#: Templates of this size together, in bytes, are sent to every task; larger ones are joined.
BROADCAST_BYTES = 16 << 20
#: Constant nodes that hold more than this share of a marked article are its own text.
OWN_SHARE = 0.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Tags that an opening tag ends, as a page may leave out their end tags.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
SCOPES = frozenset("ul ol dl table body article section div main aside nav footer header form".split())
DROPPED = frozenset(
    "head script style noscript template nav footer aside form button select textarea input iframe "
    "svg canvas object dialog menu header title".split()
)
#: Parts of a class, id or role that name a region which is not the article.
NAMES = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner nav navbar navigation menu "
    "header masthead footer sidebar aside breadcrumb breadcrumbs cookie cookies consent gdpr notice "
    "alert popup modal overlay comment comments reply replies disqus share sharing social related recommended "
    "newsletter subscribe signup login search pagination pager toolbar widget contentinfo complementary teaser".split()
)
#: Parts that may stand beside these in the name of a region. Any other word makes it the page's own name.
BESIDE = frozenset(
    "site page main primary secondary global top bottom left right upper lower inner outer box bar slot area "
    "wrap wrapper container section list item items link links button buttons icon icons block panel form field "
    "user reader readers post posts article articles story stories entry content media group row col unit "
    "sticky fixed mobile desktop small large first last the of for and to us thread feed policy info message title text image img".split()
)
#: A header of one of these holds the headline.
STORY = frozenset("article post story entry".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S
)
NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
PARTS = re.compile(r"[^\W\d_]+")


class Node:
    """An element: its tag, the names it goes by and its children (nodes and texts)."""

    __slots__ = ("below", "children", "names", "own", "tag")

    def __init__(self, tag: str, names: str = ""):
        self.tag, self.names, self.children = tag, names, []
        self.below = self.own = None

    def elements(self) -> list[Node]:
        """The child nodes; asked for only when the page has been read."""
        if self.below is None:
            self.below = [c for c in self.children if isinstance(c, Node)]
        return self.below

    def own_text(self) -> str:
        if self.own is None:
            self.own = " ".join(" ".join(c for c in self.children if isinstance(c, str)).split())
        return self.own


def parse(page: str) -> Node:
    """The page as a tree; wrong or missing end tags are put up with."""
    root = Node("#root")
    stack, at = [root], 0
    while True:
        found = TOKEN.search(page, at)
        if found is None:
            stack[-1].children.append(html_entities.unescape(page[at:]))
            return root
        if found.start() > at:
            stack[-1].children.append(html_entities.unescape(page[at : found.start()]))
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in SCOPES and tag in INLINE | {"p", "li"}:
                    break
            continue
        if tag not in INLINE and any(x.tag == "p" for x in stack[-8:]):
            i = max(i for i, x in enumerate(stack) if x.tag == "p")
            if all(x.tag in INLINE for x in stack[i + 1 :]):
                del stack[i:]
        if tag in ENDS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ENDS[tag]:
                    del stack[i:]
                    break
                if stack[i].tag in SCOPES:
                    break
        names = " ".join(sorted(v.strip("\"'").lower() for _, v in NAMED.findall(found[3]))) if found[3] else ""
        node = Node(tag, names)
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            at = end.start() if end else len(page)
        if tag not in VOID and not found[3].endswith("/"):
            stack.append(node)


@lru_cache(maxsize=4096)
def named_away(names: str) -> bool:
    """Whether one of the names, as a whole, is that of a region."""
    for name in names.split():
        parts = PARTS.findall(name)
        known = [w for w in parts if w in NAMES]
        if known and all(w in NAMES or w in BESIDE for w in parts):
            if known != ["header"] or not STORY.intersection(parts):
                return True
    return False


def holds_article(node: Node) -> bool:
    todo = [node]
    while todo:
        x = todo.pop()
        if x.tag in ("article", "main") and not named_away(x.names):
            return True
        todo += x.elements()
    return False


def dropped(node: Node, in_article: bool) -> bool:
    """Whether the region is not the article's. A frame around the article never is."""
    if in_article and node.tag in ("header", "article") and not node.names:
        return False
    if node.tag in DROPPED:
        return not (node.tag == "form" and holds_article(node))
    if not node.names or node.tag in ("html", "body", "h1", "h2", "h3", "h4", "h5", "h6") or not named_away(node.names):
        return False
    return in_article or not holds_article(node)


# --- simple tree matching --------------------------------------------------------------

# A template node is a list [tag, names, texts, children]; texts go with a number each.

T = TypeVar("T")


def fits(t: list, node: Node) -> bool:
    return t[0] == node.tag and t[1] == node.names


def children_first(top: T, below: Callable[[T], Iterable[T]]) -> list[T]:
    found, todo = [], [top]
    while todo:
        x = todo.pop()
        found.append(x)
        todo += below(x)
    return found[::-1]


def holders(root: Node, texts: Container[str]) -> dict[int, list[Node]]:
    """The nodes with one of the texts in or below them, and their children of that kind."""
    found: dict[int, list[Node]] = {}
    for x in children_first(root, Node.elements):
        held = [c for c in x.elements() if id(c) in found]
        if held or x.own_text() in texts:
            found[id(x)] = held
    return found


def match(a: list, b: Node, live: dict[int, list[Node]] | None = None) -> list[tuple[list, Node]]:
    """Pairs of template and page nodes below two that fit: the matching that is worth most.

    A pair is worth one, and one more where the page's text is among the template's;
    a pair without such a text in or below it is worth nothing. Worths are found
    from the leaves up, without recursion, and once for all subtrees that are alike,
    so trees may be of any depth and have any number of repeated rows.
    """
    parts = children_first(a, lambda t: t[3])
    if live is None:
        live = holders(b, {x for t in parts for x in t[2]})
    if id(b) not in live or not fits(a, b):
        return []
    kinds: dict = {}
    left: dict[int, int] = {}
    right: dict[int, int] = {}
    shape: list[tuple] = []

    def kind(key: tuple) -> int:
        if key not in kinds:
            kinds[key] = len(shape)
            shape.append(key)
        return kinds[key]

    for t in parts:
        left[id(t)] = kind((t[0], t[1], frozenset(t[2]), tuple(left[id(c)] for c in t[3])))
    for x in children_first(b, lambda x: live[id(x)]):
        right[id(x)] = kind((x.tag, x.names, x.own_text(), tuple(right[id(c)] for c in live[id(x)])))
    worth: dict[tuple[int, int], int] = {}
    todo = [(left[id(a)], right[id(b)])]
    while todo:
        l, r = todo[-1]
        (_, _, texts, below), (_, _, own, beside) = shape[l], shape[r]
        new = {(x, y) for x in set(below) for y in set(beside) if shape[x][:2] == shape[y][:2]} - worth.keys()
        if new and (l, r) not in worth:
            todo += new
            continue
        todo.pop()
        total = (own in texts) + (aligned(below, beside, worth)[0] if below and beside else 0)
        worth[l, r] = total + (total > 0)
    pairs, found = [], [(a, b)] if worth[left[id(a)], right[id(b)]] else []
    while found:
        t, x = found.pop()
        pairs.append((t, x))
        below = live[id(x)]
        if t[3] and below:
            places = aligned([left[id(c)] for c in t[3]], [right[id(c)] for c in below], worth)[1]
            found += [(t[3][i], below[j]) for i, j in places]
    return pairs


def aligned(left: Sequence[int], right: Sequence[int], worth: dict[tuple[int, int], int]) -> tuple[int, list[tuple[int, int]]]:
    """(worth, places) of the best pairing of two rows of subtrees in their order.

    Only pairs with a worth are visited. ``ends`` and ``totals`` rise together: a total
    and the earliest place on the right that it is reached at; ``chains`` are its pairs.
    """
    places: dict[int, list[int]] = {}
    for j, y in enumerate(right):
        places.setdefault(y, []).append(j)
    ends, totals, chains = [-1], [0], [None]
    for i, x in enumerate(left):
        added = []
        for y, at in places.items():
            w = worth.get((x, y), 0)
            for j in at if w else ():
                k = bisect_left(ends, j) - 1
                added.append((j, totals[k] + w, (i, j, chains[k])))
        for j, total, chain in added:
            k = bisect_left(ends, j)
            if totals[k - 1] >= total or k < len(ends) and ends[k] == j and totals[k] >= total:
                continue
            stop = k
            while stop < len(ends) and totals[stop] <= total:
                stop += 1
            ends[k:stop], totals[k:stop], chains[k:stop] = [j], [total], [chain]
    found, chain = [], chains[-1]
    while chain is not None:
        found.append(chain[:2])
        chain = chain[2]
    return totals[-1], found[::-1]


def frame_of(node: Node, live: dict[int, list[Node]], texts: Container[str]) -> list:
    """A page's branches with one of the texts as a template of that page."""
    top: list = []
    todo = [(node, top)]
    while todo:
        x, into = todo.pop()
        made = [x.tag, x.names, {x.own_text(): 1} if x.own_text() in texts else {}, []]
        into.append(made)
        todo += [(c, made[3]) for c in reversed(live.get(id(x), []))]
    return top[0]


def candidates(pages: list[str]) -> list | None:
    """The texts that two of a host's pages share at one place, numbered, in a tree; None without any."""
    trees = [parse(p) for p in pages]
    seen: Counter[str] = Counter()
    for tree in trees:
        seen.update({x.own_text() for x in children_first(tree, Node.elements)})
    texts = {x for x, n in seen.items() if x and n > 1}
    if not texts:
        return None
    lives = [holders(tree, texts) for tree in trees]
    frame = frame_of(trees[0], lives[0], texts)
    for tree, live in zip(trees[1:], lives[1:]):
        if id(tree) not in live:
            continue
        pairs = match(frame, tree, live) or [(frame, tree)]
        partner = {id(node): t for t, node in pairs}
        for t, node in pairs:
            if node.own_text() in texts:
                t[2][node.own_text()] = t[2].get(node.own_text(), 0) + 1
            at = {id(x): i for i, x in enumerate(t[3])}
            merged, done = [], 0
            for c in live[id(node)]:
                if id(c) in partner:
                    stop = at[id(partner[id(c)])] + 1
                    merged += t[3][done:stop]
                    done = stop
                else:
                    merged.append(frame_of(c, live, texts))
            t[3] = merged + t[3][done:]
    number = 0
    for t in children_first(frame, lambda t: t[3]):
        shared = sorted(x for x, n in t[2].items() if n > 1)
        t[2] = {x: number + i for i, x in enumerate(shared)}
        number += len(shared)
    return pruned(frame)


def pruned(template: list) -> list | None:
    """The template without branches that hold no text."""
    for t in children_first(template, lambda t: t[3]):
        t[3] = [c for c in t[3] if c[2] or c[3]]
    return template if template[2] or template[3] else None


def settled(template: list, constant: Container[int]) -> list | None:
    """The template of the candidates whose numbers are in ``constant``."""
    for t in children_first(template, lambda t: t[3]):
        t[2] = {x: n for x, n in t[2].items() if n in constant}
    return pruned(template)


def to_json(template: list | None) -> str | None:
    """The nodes in page order, each with the number of its children: flat at any depth."""
    if template is None:
        return None
    nodes, todo = [], [template]
    while todo:
        tag, names, texts, below = todo.pop()
        nodes.append([tag, names, texts, len(below)])
        todo += reversed(below)
    return json.dumps(nodes)


@lru_cache(maxsize=256)
def from_json(text: str | None) -> list | None:
    if not text:
        return None
    done: list[list] = []
    for tag, names, texts, n in reversed(json.loads(text)):
        below = done[len(done) - n :][::-1]
        del done[len(done) - n :]
        done.append([tag, names, texts, below])
    return done[0]


def votes_of(root: Node, template: list) -> tuple[int | None, set[int]]:
    """(story, numbers of the candidates that the page holds); a page without a story has no vote."""
    held = {id(x): t[2][x.own_text()] for t, x in match(template, root) if x.own_text() in t[2]}
    slots = (x.own_text() for x in walk(root) if id(x) not in held)
    story = max(slots, key=lambda x: (len(x), x), default="")
    if not story:
        return None, set(held.values())
    digest = hashlib.blake2b(story.encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(digest, "big", signed=True), set(held.values())


# --- extraction ------------------------------------------------------------------------


def size(node: Node, constant: set[int]) -> tuple[int, int]:
    """(characters, characters in links) of what is kept below a node."""
    total = linked = 0
    todo = [(node, node.tag == "a")]
    while todo:
        x, link = todo.pop()
        for c in x.children:
            if isinstance(c, str):
                if id(x) not in constant:
                    n = len(c.strip())
                    total, linked = total + n, linked + n * link
            elif not dropped(c, False):
                todo.append((c, link or c.tag == "a"))
    return total, linked


def walk(node: Node) -> Iterator[Node]:
    """The elements that are not dropped, in page order."""
    todo = [node]
    while todo:
        x = todo.pop()
        yield x
        todo += [c for c in reversed(x.elements()) if not dropped(c, False)]


def articles_of(root: Node, constant: set[int]) -> tuple[list[Node], bool]:
    """(the parts of the article, whether the page marks it as such)."""
    articles, mains = [], []
    todo: list[tuple[Node, Node | None, bool]] = [(root, None, False)]
    while todo:
        x, main, inside = todo.pop()
        if x.tag == "article":
            articles.append((x, main, inside))
        elif x.tag == "main":
            mains.append(x)
        below = (x if x.tag == "main" else main, inside or x.tag == "article")
        todo += [(c, *below) for c in reversed(x.elements()) if not dropped(c, False)]
    if articles:
        best, main, inside = max(articles, key=lambda a: size(a[0], set())[0])
        if main is None or inside:
            return [best], True
        return [x for x, m, i in articles if m is main and not i], True
    if mains:
        return [max(mains, key=lambda x: size(x, set())[0])], True
    at = root
    while True:
        whole = size(at, constant)[0]
        inner = [c for c in at.elements() if c.tag not in INLINE and not dropped(c, False)]
        large = next((c for c in inner if size(c, constant)[0] > 0.6 * whole), None)
        if large is None or large.tag in ("p", "h1", "h2", "pre", "blockquote", "ul", "ol", "table"):
            return [at], False
        at = large


def main_text(page: str | None, template: list | None) -> str:
    """The blocks of the article, joined by line feeds."""
    if not page:
        return ""
    root = parse(page)
    constant: set[int] = set()
    if template is not None:
        constant = {id(p) for t, p in match(template, root) if p.own_text() in t[2]}
    articles, marked = articles_of(root, constant)
    if marked and constant:
        whole = sum(size(x, set())[0] for x in articles)
        if sum(size(x, constant)[0] for x in articles) < (1 - OWN_SHARE) * whole:
            constant = set()
    blocks: list[str] = []
    now: list[str] = []
    links = [0]

    def close() -> None:
        text = " ".join("".join(now).split())
        if text and (marked or links[0] <= 0.5 * len(text)):
            blocks.append(text)
        now.clear()
        links[0] = 0

    todo: list = [(x, False) for x in reversed(articles)]
    while todo:
        x, link = todo.pop()
        if x is None:
            close()
        elif isinstance(x, str):
            now.append(x)
            links[0] += len(x.strip()) * link
        elif x.tag == "br":
            now.append(" ")
        else:
            block = x.tag not in INLINE
            if block:
                close()
                todo.append((None, False))
            link = link or x.tag == "a"
            for c in reversed(x.children):
                if isinstance(c, Node) and not dropped(c, marked) or isinstance(c, str) and id(x) not in constant:
                    todo.append((c, link))
    close()
    return "\n".join(blocks)


# --- Spark -----------------------------------------------------------------------------


Lookup = Callable[[pa.RecordBatch], list[str | None]]
Mapping = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def host_of(url: Column) -> Column:
    found = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return found


def _finding(frame: pd.DataFrame) -> pd.DataFrame:
    made = candidates(frame.sort_values("pick")["html"].tolist())
    return pd.DataFrame({"host": frame["host"].iloc[:1], "template": [to_json(made)]})


@lru_cache(maxsize=1 << 14)
def digest(*parts: str | int) -> int:
    joined = "\0".join(map(str, parts)).encode("utf-8", "replace")
    return int.from_bytes(hashlib.blake2b(joined, digest_size=8).digest(), "big", signed=True)


def places_of(root: Node) -> Iterator[tuple[int, str, bool]]:
    """(place, text, whether it may be a story) of a page's texts; a place is the text and the tags and names around it."""
    slots = {id(x) for x in walk(root)}
    todo = [(root, 0)]
    while todo:
        x, around = todo.pop()
        path = digest(around, x.tag, x.names)
        if x.own_text():
            yield digest.__wrapped__(path, x.own_text()), x.own_text(), id(x) in slots
        todo += [(c, path) for c in x.elements()]


def _placing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, pick, place, text, n_chars, slot) of all texts of all pages, each place of a page once."""
    for batch in batches:
        for part in chunks(batch, "html"):
            rows = []
            for host, page, pick in zip(*(part.column(c).to_pylist() for c in ("host", "html", "pick"))):
                found: dict[int, tuple[str, bool]] = {}
                for place, text, slot in places_of(parse(page)):
                    found[place] = text, slot or found.get(place, (text, False))[1]
                rows += [(host, pick, at, digest.__wrapped__(x), len(x), slot) for at, (x, slot) in found.items()]
            if rows:
                types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(columns, ["host", "pick", "place", "text", "n_chars", "slot"])


def _picks(marked: DataFrame) -> DataFrame:
    """(host, pick): two pages for each place that may be constant, counted over all pages.

    A page's story is its longest text, or the longest that no other page has at that place;
    what is constant by either is looked at. Each place takes a share of the host's
    stories, so a host has few of them, however many pages.
    """
    placed = materialise(
        marked.mapInArrow(_placing, "host string, pick long, place long, text long, n_chars int, slot boolean")
    )
    shared = materialise(
        placed.groupBy("host", "place").agg(F.min("pick").alias("first"), F.max("pick").alias("last")).where("first <> last")
    )
    texts = placed.join(shared, ["host", "place"], "left")
    longest = F.struct("n_chars", "text")
    stories = (
        texts.where("slot")
        .groupBy("host", "pick")
        .agg(F.max(longest)["text"].alias("any"), F.max(F.when(F.col("first").isNull(), longest))["text"].alias("own"))
    )
    counted = [F.count_distinct(c).alias(f"n_{c}") for c in ("any", "own")]
    whole = stories.groupBy("host").agg(*counted).withColumnsRenamed({"n_any": "all_any", "n_own": "all_own"})
    held = texts.where("first IS NOT NULL").join(stories, ["host", "pick"]).groupBy("host", "place", "first", "last").agg(*counted)
    enough = [f"n_{c} >= 2 AND n_{c} >= {CONSTANT_SHARE} * all_{c}" for c in ("any", "own")]
    chosen = held.join(whole, "host").where(f"{enough[0]} OR {enough[1]}")
    return materialise(chosen.select("host", F.explode(F.array("first", "last")).alias("pick")).distinct())


def host_candidates(pages: DataFrame) -> DataFrame:
    """(host, template) from (host, html): all pages decide which of them are aligned.

    The picks are a few numbers a host; up to a million of them go to the pages, not
    the pages to them."""
    marked = pages.where("html IS NOT NULL").withColumn("pick", F.xxhash64("html"))
    sample = marked.join(small(_picks(marked)), ["host", "pick"], "left_semi").groupBy("host", "pick").agg(F.min("html").alias("html"))
    return sample.groupBy("host").applyInPandas(_finding, "host string, template string").where("template IS NOT NULL")


class Templates:
    """Templates by host: sent to every task if they are small together, joined to the pages if not."""

    def __init__(self, templates: DataFrame):
        self.table = materialise(templates)
        bytes_ = self.table.agg(F.sum(F.length("template") + F.length("host"))).first()[0] or 0
        self.known = None
        if bytes_ <= BROADCAST_BYTES:
            context = templates.sparkSession.sparkContext
            self.known = context.broadcast({r.host: r.template for r in self.table.collect()})

    def beside(self, pages: DataFrame) -> DataFrame:
        return pages if self.known is not None else pages.join(self.table, "host", "left")

    def reader(self) -> Lookup:
        """A function that gives the templates of the pages of a batch."""
        known = self.known

        def read(part: pa.RecordBatch) -> list[str | None]:
            if known is None:
                return part.column("template").to_pylist()
            return [known.value.get(h) for h in part.column("host").to_pylist()]

        return read


def _voting(templates: Lookup) -> Mapping:
    """(host, story, number) of the candidates a page holds, and (host, story, -1) for the page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "html"):
                rows = set()
                for host, page, known in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), templates(part)):
                    template = from_json(known)
                    if page and template is not None:
                        story, held = votes_of(parse(page), template)
                        rows |= {(host, story, n) for n in (-1, *held) if story is not None}
                if rows:
                    host, story, number = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(host, pa.string()), pa.array(story, pa.int64()), pa.array(number, pa.int32())],
                        ["host", "story", "number"],
                    )

    return run


def _settling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        chosen = zip(batch.column("template").to_pylist(), batch.column("constant").to_pylist())
        # read anew, as settling changes the tree
        made = [to_json(settled(from_json.__wrapped__(t), set(c))) for t, c in chosen]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(made, pa.string())], ["host", "template"])


def host_templates(pages: DataFrame) -> DataFrame:
    """(host, template) from (host, html): all pages of a host vote on its candidates.

    Votes are counted by host, number and story first, so a hot host is spread by its stories.
    """
    found = Templates(host_candidates(pages))
    votes = found.beside(pages).mapInArrow(_voting(found.reader()), "host string, story long, number int")
    counts = votes.distinct().groupBy("host", "number").agg(F.count(F.lit(1)).alias("n"))
    by_host = counts.groupBy("host").agg(
        F.collect_list(F.struct("number", "n")).alias("counts"),
        F.max(F.when(F.col("number") < 0, F.col("n"))).alias("stories"),
    )
    enough = F.filter("counts", lambda c: (c["number"] >= 0) & (c["n"] >= 2) & (c["n"] >= CONSTANT_SHARE * F.col("stories")))
    constant = by_host.select("host", F.transform(enough, lambda c: c["number"]).alias("constant"))
    chosen = found.table.join(constant.where(F.size("constant") > 0), "host")
    return chosen.mapInArrow(_settling, "host string, template string").where("template IS NOT NULL")


def _extracting(templates: Lookup) -> Mapping:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "html"):
                texts = [main_text(p, from_json(t)) for p, t in zip(part.column("html").to_pylist(), templates(part))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
                )

    return run


def extract_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text) of every page."""
    rows = small_batches(pages).select(
        F.col(quoted(page_id)).alias("page_id"), F.col(quoted(url)).alias("url"), F.col(quoted(html)).alias("html")
    ).withColumn("host", host_of(F.col("url")))
    kind = rows.schema["page_id"].dataType.simpleString()
    found = Templates(host_templates(rows.select("host", "html")))
    out = found.beside(rows).mapInArrow(_extracting(found.reader()), f"page_id {kind}, url string, text string")
    return out.withColumnsRenamed({"page_id": page_id, "url": url})


# --- query -----------------------------------------------------------------------------


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
