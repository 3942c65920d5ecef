"""Main text of web pages by consensus paths of their host.

First pass: every page is parsed, its containers are scored by the running
text below them, and the page votes for the generalised path (tags, classes
and ids with digits folded) of its best container.  Votes are summed per host
and path in Spark, also of containers that pages leave out.  Second pass: every
page is parsed again with the winning paths of its host and the text of all
containers of a winning path is taken; a page whose own best container holds
more, other than what the host's pages leave out, uses that one.

Pages are never shuffled unless the winners (three paths a host) are too large
for the planner's broadcast limit; then they meet in a join that splits hot
hosts at run time.

Defined results: null or empty html gives an empty text; a null url counts as
a host of its own; repeated rows are judged alike; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Collection, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.session import stage

PATHS = 3               # winning paths kept per host
BESIDE = 20             # paths kept per host that its pages leave out
FULL_VOTE = 1000        # vote of a page with at least FULL_TEXT characters of running text
FULL_TEXT = 400
COVER = 0.85            # a container is entered while one child holds this share
DEPTH = 400             # deeper elements become siblings: bounds work on broken pages
FAIR = 0.25             # share of the running text that a winning path must hold

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is text up to their end tag, and embedded ones, which
# are dropped if their end tag stands where it belongs.
RAW = frozenset("script style noscript template textarea iframe title".split())
EMBEDS = frozenset("svg math select object canvas audio video".split())
BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "caption blockquote pre figure figcaption address fieldset hr details summary center header footer nav aside "
    "form menu dialog".split())
CONTAINERS = frozenset("body main article section div td center".split())
# Elements that are never part of an article.
DROP_TAGS = frozenset("nav header footer aside form menu dialog button head".split())
# Of those, the ones that also stand around whole articles.
SOFT_TAGS = frozenset("form dialog button head".split())
# Words of a class, id or role that mark what is around an article.
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner nav navbar "
    "navigation menu menus breadcrumb breadcrumbs header masthead footer sidebar sidebars aside widget widgets "
    "complementary contentinfo cookie cookies consent gdpr notice notices notification notifications alert popup "
    "modal dialog overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations comment comments commentlist respond reply replies disqus discussion form search searchform "
    "pagination pager toolbar skip copyright".split())
# Words that mark reader comments, adverts and consent boxes in any compound name.
STRONG_WORDS = frozenset("comment comments commentlist disqus respond cookie cookies consent gdpr advert adverts "
                         "advertisement advertising sponsored newsletter".split())
# Words that a marking name may have besides: "related-posts" marks a box,
# "related-work" does not.
BOX_WORDS = frozenset(
    "box boxes bar bars list lists link links button buttons icon icons post posts article articles item items section "
    "sections wrapper wrap container area block blocks panel panel column col row top bottom left right site page main "
    "content inner outer global primary secondary mobile desktop sticky fixed full small large js id the us of for in "
    "on up out open close closed group text title head heading body slot unit zone message messages news story stories "
    "tools tool count counts more latest popular field fields input entry blog web holder module region by".split())
OUTWEIGH = 2            # a marked element stays if it holds this many times the unmarked text
LEAST = 200             # and so many characters of running text
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tr", "td", "th", "thead", "tbody"),
          "option": ("option",)}
# What an implied end tag may not cross.
FENCES = frozenset("ul ol dl table body article main section div td".split()) | EMBEDS

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:._-]*)(?P<attrs>[^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-z][a-z0-9:._-]*)(?P<attrs2>[^>]*)>|<[!?/][^>]*>", re.I | re.S)
RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
CAMEL = re.compile(r"([a-z])([A-Z])")
WORDS = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    path: str
    drop: bool = False          # by tag, role, class or id
    soft: bool = False          # dropped unless it outweighs the unmarked text
    own: bool = False           # a header within an article
    keeper: bool = False        # holds an article, main or h1
    running: int = 0            # characters of running text in blocks at or below
    inline: int = 0             # of an inline element: its characters, and those in links
    linked: int = 0
    parts: list = field(default_factory=list)      # text, None (block border) or child number


def parse(source: str) -> list[Node]:
    """The page as a list of nodes in page order; node 0 is the root."""
    nodes = [Node("html", -1, "")]
    stack, at = [0], 0
    endless: set[str] = set()       # raw elements without an end tag in the rest of the page

    def text(piece: str) -> None:
        if piece:
            nodes[stack[-1]].parts.append(html.unescape(piece) if "&" in piece else piece)

    def close(upto: int, own: bool = False) -> None:
        _cut(nodes, stack, upto, own)

    while m := TOKEN.search(source, at):
        text(source[at:m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag, ending = tag.lower(), m["end"] or m["end2"]
        if tag in RAW:
            foreign = m.group().endswith("/>") and any(nodes[k].tag in ("svg", "math") for k in stack)
            if not ending and not foreign:
                begin = source.index(">", m.start()) + 1
                last = None if tag in endless else RAW_END[tag].search(source, begin)
                if last:
                    at = last.end()
                else:
                    endless.add(tag)
                    if tag in ("script", "style"):
                        at = len(source)
            continue
        if ending:
            for k in range(len(stack) - 1, 0, -1):
                open_tag = nodes[stack[k]].tag
                if open_tag == tag:
                    close(k, own=True)
                    break
                if tag not in BLOCKS and tag not in EMBEDS and open_tag in BLOCKS:
                    break           # an inline end tag does not close a block
                if tag == "p" and open_tag in FENCES:
                    break
            continue
        if tag == "br" or tag == "hr":
            nodes[stack[-1]].parts.append(" " if tag == "br" else None)
            continue
        if tag in VOID:
            continue
        if tag in ("html", "body", "head"):
            if tag == "body":
                close(1)
            elif tag == "html":
                continue
        if tag in BLOCKS:
            _imply(nodes, stack, ("p",))
            for k in range(len(stack) - 1, 0, -1):      # an open head ends where the body begins
                if nodes[stack[k]].tag == "head":
                    close(k)
        if tag in CLOSES:
            _imply(nodes, stack, CLOSES[tag])
        attrs = m["attrs"] or m["attrs2"] or ""
        parent = nodes[stack[-1]]
        names, mark = _names(tag, attrs) if attrs.strip() else ("", "")
        hard = tag in EMBEDS or (tag in DROP_TAGS and tag not in SOFT_TAGS) or mark == "hard"
        node = Node(tag, stack[-1], f"{parent.path}>{tag}{names}" if len(stack) < 40 else parent.path,
                    hard or bool(mark) or tag in SOFT_TAGS)
        node.soft = node.drop and not hard
        if tag == "header" and any(nodes[k].tag == "article" for k in stack):
            node.own = True                 # of the article; stays if it holds the headline
        if tag in ("article", "main", "h1"):
            for k in stack:
                nodes[k].keeper = True
        parent.parts.append(len(nodes))
        nodes.append(node)
        if len(stack) < DEPTH and (tag in BLOCKS or not m.group().endswith("/>")):
            stack.append(len(nodes) - 1)
    text(source[at:])
    close(1)
    return nodes


def _cut(nodes: list[Node], stack: list[int], upto: int, own: bool = False) -> None:
    """Close all from ``upto`` on, that one by its ``own`` end tag.  An embedded
    element that another tag closes does not take what follows it along."""
    for k in stack[upto + own:]:
        if nodes[k].tag in EMBEDS:
            nodes[k].drop = False
    del stack[upto:]


def _imply(nodes: list[Node], stack: list[int], tags: tuple) -> None:
    """Close the nearest open element of ``tags`` within the current fence."""
    for k in range(len(stack) - 1, 0, -1):
        tag = nodes[stack[k]].tag
        if tag in tags:
            _cut(nodes, stack, k)
            return
        if tag in FENCES:
            return


def _names(tag: str, attrs: str) -> tuple[str, str]:
    """Generalised classes and id of a tag, and whether they mark clutter: "hard"
    (hidden, or a strong word), "soft" or ""."""
    names, mark = [], ""
    for m in ATTR.finditer(attrs):
        kind, value = m[1].lower(), CAMEL.sub(r"\1-\2", m[2] or m[3] or m[4] or "").lower()
        if kind in ("class", "id"):
            parts = sorted(value.split()) if kind == "class" else [value.strip()]
            names += [("." if kind == "class" else "#") + re.sub(r"\d+", "0", x)[:40] for x in parts if x]
        if kind in ("class", "id", "role"):
            for name in value.split():
                words = WORDS.findall(name)
                if any(w in STRONG_WORDS for w in words):
                    mark = "hard"
                elif any(w in DROP_WORDS for w in words) and all(w in DROP_WORDS or w in BOX_WORDS for w in words):
                    mark = mark or "soft"
        elif kind == "hidden" or (kind == "aria-hidden" and value == "true"):
            mark = "hard"
        elif kind == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            mark = "hard"
    return "".join(names), "" if tag in ("html", "body", "main", "article") else mark


def _dropped(node: Node) -> bool:
    """Clutter, unless it is a wrapper marked by class, or an article's own
    header, that holds the article or its headline."""
    if node.own:
        return not node.keeper
    return node.drop and (node.tag in DROP_TAGS or node.tag in EMBEDS or not node.keeper)


def measure(nodes: list[Node]) -> None:
    """Running text of every node.  A word in a name or a form around the page
    loses no article: as long as a softly marked element holds more than
    ``OUTWEIGH`` times the running text that is not marked, the largest stays."""
    _running(nodes, _dropped)
    if not any(x.soft and x.drop for x in nodes):
        return
    mass = _running([Node(x.tag, x.parent, "", x.drop and not x.soft, x.keeper, parts=x.parts, own=x.own) for x in nodes],
                    _dropped)
    while True:
        marked = [(mass[n], -n) for n, x in enumerate(nodes) if x.soft and _dropped(x) and mass[n] >= LEAST]
        largest, n = max(marked, default=(0, 0))
        if largest <= OUTWEIGH * nodes[0].running:
            return
        nodes[-n].drop = False
        _running(nodes, _dropped)


def _running(nodes: list[Node], dropped: Callable[[Node], bool]) -> list[int]:
    """Set and return the running text of every node: the text of blocks that are
    not mostly links.  One pass from the end, children before parents."""
    for n in range(len(nodes) - 1, -1, -1):
        node = nodes[n]
        node.running = node.inline = node.linked = 0
        if dropped(node):
            continue
        inline = linked = below = 0
        for part in node.parts:
            if isinstance(part, str):
                inline += len(part)
            elif part is not None:
                child = nodes[part]
                inline, linked, below = inline + child.inline, linked + child.linked, below + child.running
        if node.tag in BLOCKS:
            node.running = below + (inline - linked if inline > 2 * linked else 0)
        else:
            node.inline, node.running = inline, below
            node.linked = inline if node.tag == "a" else linked
    return [x.running for x in nodes]


def best_container(nodes: list[Node]) -> int:
    """The innermost container that holds most of the running text, widened to
    its article or main element, or to the outermost parent that holds more of
    the article beside it."""
    at = 0
    while True:
        children = [c for c in _children(nodes, at) if nodes[c].running >= COVER * max(1, nodes[at].running)]
        if not children:
            break
        at = children[0]
    up, seen = at, []
    while up > 0:
        seen.append(up)
        up = nodes[up].parent
    for tag in ("article", "main"):
        for n in seen:
            if nodes[n].tag == tag:
                return n
    for below, n in zip(seen, seen[1:]):
        if nodes[n].tag != "html" and _article_beside(nodes, n, below):
            at = n
    return at


def _article_beside(nodes: list[Node], n: int, below: int) -> bool:
    """Does ``n`` hold more of the article than the child ``below`` does: loose
    running text, a container like it, or a headline?  (h2 only before it or
    loose: boxes at the side have headings, too.)"""
    todo, before = [(p, False) for p in reversed(nodes[n].parts)], True
    while todo:
        part, boxed = todo.pop()
        if isinstance(part, str):
            if not boxed and any(map(str.isalnum, part)):
                return True
        elif part == below:
            before = False
        elif part is not None and not _dropped(nodes[part]):
            node = nodes[part]
            if node.tag == "h1" or (node.tag == "h2" and (before or not boxed)):
                return True
            if node.tag in CONTAINERS:
                if node.running and node.path == nodes[below].path:
                    return True
                todo += [(p, True) for p in reversed(node.parts)]
            elif node.tag in BLOCKS:
                if node.running and not boxed:
                    return True
                todo += [(p, True) for p in reversed(node.parts)]
            elif node.tag != "a":
                todo += [(p, boxed) for p in reversed(node.parts)]
    return False


def _children(nodes: list[Node], n: int) -> Iterator[int]:
    """Container children, also those inside inline or other block elements."""
    todo = list(nodes[n].parts)
    while todo:
        part = todo.pop()
        if isinstance(part, int) and not _dropped(nodes[part]):
            if nodes[part].tag in CONTAINERS:
                yield part
            else:
                todo.extend(nodes[part].parts)


def block_texts(nodes: list[Node], n: int) -> list[str]:
    """Texts of the blocks of a container in page order, white space folded."""
    blocks, piece = [], []

    def border() -> None:
        t = " ".join("".join(piece).split())
        if t:
            blocks.append(t)
        piece.clear()

    # An explicit stack: pages may nest deeper than the interpreter allows.
    todo: list = [iter(nodes[n].parts)]
    ends = [True]
    while todo:
        part = next(todo[-1], StopIteration)
        if part is StopIteration:
            todo.pop()
            if ends.pop():
                border()
        elif part is None:
            border()
        elif isinstance(part, str):
            piece.append(part)
        elif not _dropped(nodes[part]):
            is_block = nodes[part].tag in BLOCKS
            if is_block:
                border()
            todo.append(iter(nodes[part].parts))
            ends.append(is_block)
    return blocks


def extract(source: str, paths: list[str], beside: Collection[str] = ()) -> tuple[str, str]:
    """Text of a page given its host's winning paths and those that the host's
    pages leave out, and the path used."""
    nodes = parse(source)
    measure(nodes)
    total, best = nodes[0].running, best_container(nodes)
    for path in paths:
        match = _outermost(nodes, lambda x: x.path == path)
        held = sum(nodes[n].running for n in match)
        if match and held >= FAIR * total:
            inside = lambda n: best in _upward(nodes, n)       # noqa: E731
            out = sum(nodes[n].running for n in _outermost(nodes, lambda x: x.path in beside and x.path != path)
                      if inside(n) and not any(k in match for k in _upward(nodes, n))
                      and not any(n in _upward(nodes, k) for k in match))
            own = sum(nodes[n].running for n in match if inside(n)) if any(map(inside, match)) else held
            if own >= COVER * (nodes[best].running - out):
                return "\n\n".join(t for n in match for t in block_texts(nodes, n)), path
    return "\n\n".join(block_texts(nodes, best)), nodes[best].path


def _upward(nodes: list[Node], n: int) -> Iterator[int]:
    while n >= 0:
        yield n
        n = nodes[n].parent


def _outermost(nodes: list[Node], wanted: Callable[[Node], bool]) -> list[int]:
    """Visible containers that are wanted, in page order, none within another."""
    found: list[int] = []
    for n, x in enumerate(nodes):
        if x.tag in CONTAINERS and wanted(x) and _visible(nodes, n) and not any(k in found[-1:] for k in _upward(nodes, n)):
            found.append(n)
    return found


def _left_out(nodes: list[Node], best: int) -> set[str]:
    """Paths of the containers with running text beside the best one."""
    chain = list(_upward(nodes, best))
    paths = {nodes[c].path for n in chain[1:] for c in _children(nodes, n) if c not in chain and nodes[c].running}
    return paths - {nodes[best].path}


def _visible(nodes: list[Node], n: int) -> bool:
    while n > 0:
        if _dropped(nodes[n]):
            return False
        n = nodes[n].parent
    return True


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Votes of the pages of a partition, summed by host, path and whether it is
    that of a container left out."""
    votes: Counter = Counter()

    def flush() -> pa.RecordBatch:
        rows = [(*k, v) for k, v in votes.items()]
        votes.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.string(), pa.bool_(), pa.int64()))],
            names=["host", "path", "beside", "votes"])

    for batch in batches:
        for host, source in zip(*(batch.column(c).to_pylist() for c in ("host", "html"))):
            if source:
                nodes = parse(source)
                measure(nodes)
                best = best_container(nodes)
                vote = FULL_VOTE * min(nodes[best].running, FULL_TEXT) // FULL_TEXT
                if vote:
                    votes[host, nodes[best].path, False] += vote
                    for path in _left_out(nodes, best):
                        votes[host, path, True] += vote
        if len(votes) > 100_000:
            yield flush()
    if votes:
        yield flush()


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        # a few pages at a time: a batch may hold very long ones
        for part in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):
            rows = [extract(h or "", p or [], b or ()) for h, p, b in zip(*(
                part.column(c).to_pylist() for c in ("html", "paths", "beside")))]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id").cast(pa.int64()), part.column("url").cast(pa.string()),
                 pa.array([t for t, _ in rows], pa.string()), pa.array([p for _, p in rows], pa.string()),
                 pa.array([len(t) for t, _ in rows], pa.int64())],
                names=["page_id", "url", "text", "path", "n_chars"])


def host_of(url: Column) -> Column:
    """Lower-case host of a url; a null url or one without :// has host ''."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def host_paths(pages: DataFrame, paths: int = PATHS, beside: int = BESIDE) -> DataFrame:
    """host, paths: the winning container paths of every host, the best first;
    beside: paths of containers that more votes leave out than take."""
    votes = (pages.select("host", "html").mapInArrow(_vote, "host string, path string, beside boolean, votes bigint")
             .groupBy("host", "path").agg(F.sum(F.when(F.col("beside"), 0).otherwise(F.col("votes"))).alias("votes"),
                                          F.sum(F.when(F.col("beside"), F.col("votes")).otherwise(0)).alias("out")))
    votes = stage(votes, "host-votes")          # read twice; the pages are parsed once
    # Each rank is cut where it is made, so a host with very many paths ships few.
    def first(column: str, many: int) -> DataFrame:
        by = Window.partitionBy("host").orderBy(F.col(column).desc(), "path")
        return votes.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= many)

    none = F.lit(None)
    wins = first("votes", paths).where("votes > 0").select("host", F.struct("rank", "path").alias("p"), none.cast("string").alias("b"))
    loses = first("out", beside).where("out > votes").select("host", none.cast(wins.schema["p"].dataType).alias("p"),
                                                             F.col("path").alias("b"))
    return (wins.unionByName(loses).groupBy("host")
            .agg(F.array_sort(F.collect_list("p")).alias("p"), F.array_sort(F.collect_list("b")).alias("beside"))
            .select("host", F.col("p.path").alias("paths"), "beside"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """page_id, url, text, path (of the container used), n_chars of every page."""
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                         F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host"))
    winners = stage(host_paths(pages), "host-paths")
    return (pages.join(winners, "host", "left").select("page_id", "url", "html", "paths", "beside")
            .mapInArrow(_extract, "page_id bigint, url string, text string, path string, n_chars bigint"))
