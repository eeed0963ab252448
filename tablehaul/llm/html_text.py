"""Main text of web pages by wrapper induction.

A host's pages are of a few layouts: skeletons of their outer elements. Every layout that is frequent has a reference page, with
which its pages are aligned by simple tree matching (Yang, 1991): the heaviest order-keeping match of their block trees. Pages of rare
layouts are aligned with the host's most frequent one. A text slot whose text is the same on nearly all pages that differ is part of
the template; slots that vary are content. Counting is an aggregation over all pages of all hosts, so a host with a third
of all pages is like any other.

What HTML itself declares as not being content (menus, forms, scripts and so on) is left out before. Class names that only say so
are doubtful: their text counts where a page has no other content that varies.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import mapped, saved

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|svg|iframe|select)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<[!?][^>]*>|[^<]+|<", re.S | re.I)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_SPACE = re.compile(r"\s+")

_BLOCKS = frozenset("html body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
                    "blockquote pre figure figcaption header footer nav aside form fieldset address details summary hr "
                    "caption center menu dialog title head".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never main text; an article's own header is its title.
_NOT_CONTENT = frozenset("head title nav header footer aside form button menu dialog".split())
#: Words of a class, id or role that name such a part, if its other words are neutral. In an article some name its title or text.
_PART = frozenset("nav navbar navigation menu menus breadcrumb breadcrumbs header masthead footer sidebar sidebars widget widgets ad ads advert adverts "
                  "advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent notice notices alert alerts popup modal overlay "
                  "newsletter subscribe signup social share sharing related recommended comment comments disqus reply replies respond pagination pager "
                  "toolbar search searchbox login contentinfo complementary".split())
_TITLES = frozenset("header masthead banner search".split())
_NEUTRAL = frozenset("site page main top bottom global primary secondary left right side bar box area block container wrap wrapper inner outer list item items "
                     "section row col column unit slot button buttons icon icons link links form field input widget title label text toggle trigger posts "
                     "articles stories news more user reader js the and of no is has sticky fixed mobile desktop small large dark light thread count meta "
                     "policy banner bottom leaderboard rail zone".split())
_WORDS = re.compile(r"[a-z]+", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"[0-9]+")
_MAIN = frozenset(["article", "main"])
#: Outer elements, of which a page's skeleton is made.
_OUTER = frozenset("html body div section article main header footer nav aside table form ul ol".split())
#: What a start tag ends without an end tag of its own.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_HOLDS = frozenset("ul ol dl table article section main div body html blockquote header footer nav aside form".split())


#: Elements nested deeper keep their text and order but not their nesting. Lists whose alignment takes more cells are cut where rare
#: equal elements meet, or evenly. How many levels of outer elements a skeleton has.
DEPTH, CELLS, LEVELS = 200, 4_000_000, 4
#: Why a run of text may not be content: a name says so, or HTML does.
DOUBTFUL, DECLARED = 1, 2


class Node:
    """An element that starts a block, or a run of text (tag ``#``)."""

    __slots__ = ("tag", "names", "children", "text", "skipped", "shape", "slot")

    def __init__(self, tag: str, skipped: int, text: str = "", names: str = "") -> None:
        self.tag, self.names, self.children, self.text, self.skipped, self.shape, self.slot = tag, names, [], text, skipped, 0, -1


def is_part(names: str, in_article: bool) -> bool:
    """Whether one of the names says that an element is a menu, an advert or the like: a word of it does, and no other word says
    anything else. So ``site-header`` is a part, ``search-results`` and ``entry-header`` are not."""
    known = _PART - _TITLES if in_article else _PART
    for name in _CAMEL.sub("-", names).split():
        words = set(_WORDS.findall(name.lower()))
        if words & known and words <= known | _NEUTRAL:
            return True
    return False


def parse(page: str | None) -> Node:
    """The tree of blocks of a page; whatever is in the page, some tree comes of it."""
    root = Node("", 0)
    stack, run, inline, deeper = [root], [], [], 0

    def flush() -> None:
        if run:
            text = _SPACE.sub(" ", entities.unescape("".join(run))).strip()
            run.clear()
            if text:
                stack[-1].children.append(Node("#", DECLARED if inline else stack[-1].skipped, text))

    for token in _TOKEN.finditer(page or ""):
        tag = token.group(3)
        if tag is None:
            part = token.group(0)
            if not part.startswith("<") or part == "<":
                run.append(part)
            elif token.group(1) and part[1:4].lower() not in ("scr", "sty", "tem"):
                run.append(" ")
            continue
        tag, attributes = tag.lower(), token.group(4)
        if tag not in _BLOCKS:
            if tag in ("br", "img", "input", "wbr"):
                run.append(" " if tag != "wbr" else "")
            elif tag == "button":  # inline, but none of its text is content
                flush()
                inline.append(tag) if not token.group(2) else (inline.pop() if inline else None)
            continue
        flush()
        inline.clear()
        if token.group(2):
            if deeper:
                deeper -= 1
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
                if tag in ("p", "li") and stack[depth].tag in _HOLDS:
                    break
            continue
        ended = _ENDS.get(tag, ())
        for depth in range(len(stack) - 1, 0, -1):
            name = stack[depth].tag
            if name == "p" or name in ended:
                del stack[depth:]
            elif name in _HOLDS:
                break
        names = " ".join(next(filter(None, m.groups()), "") for m in _NAMES.finditer(attributes)) if attributes else ""
        in_article, skipped = any(n.tag in _MAIN for n in stack), stack[-1].skipped
        if tag in _NOT_CONTENT and not (tag == "header" and in_article) or attributes and tag not in ("html", "body") and _HIDDEN.search(attributes):
            skipped = DECLARED
        elif names and not skipped and tag not in ("html", "body") and tag not in _MAIN and is_part(names, in_article):
            skipped = DOUBTFUL
        node = Node(tag, skipped, names=_DIGITS.sub("", names))
        stack[-1].children.append(node)
        if tag not in _VOID and not attributes.endswith("/"):
            if len(stack) < DEPTH:
                stack.append(node)
            else:  # what lies deeper is read as if it lay here
                deeper += 1
    flush()
    shape(root)
    return root


def shape(node: Node) -> int:
    for child in node.children:
        shape(child)
    node.shape = hash((node.tag, node.names, tuple(c.shape for c in node.children)))
    return node.shape


def skeleton(node: Node, levels: int = LEVELS) -> str:
    """The outer elements of a page, neighbours that are alike taken as one, down to its article."""
    inside: list[str] = []
    for child in node.children:
        if child.tag in _OUTER:
            deeper = levels if child.tag in ("html", "body") else levels - 1
            found = child.tag if child.tag in _MAIN or not deeper else skeleton(child, deeper)
            if not inside or inside[-1] != found:
                inside.append(found)
    return f"{node.tag}({','.join(inside)})"


def texts(node: Node) -> list[Node]:
    """Runs of text in page order."""
    out, stack = [], [node]
    while stack:
        here = stack.pop()
        if here.tag == "#":
            out.append(here)
        stack.extend(reversed(here.children))
    return out


def _weight(a: Node, b: Node, known: dict) -> int:
    """Of two trees with the same root: a point for every matched element, and one more where it has the same names."""
    if a.tag != b.tag:
        return 0
    own = 2 if a.names and a.names == b.names else 1
    if not a.children or not b.children:
        return own
    found = known.get((id(a), id(b)))
    if found is None:
        found = known[id(a), id(b)] = own + _match(a.children, b.children, known, None)
    return found


def _rare_pairs(a: list[Node], b: list[Node]) -> list[tuple[int, int]]:
    """Places of equal elements that both lists hold just once, in an order that both share, as many as possible."""
    def once(nodes: list[Node]) -> dict:
        seen = Counter(n.shape for n in nodes)
        return {n.shape: i for i, n in enumerate(nodes) if seen[n.shape] == 1}

    there, chains, ends = once(b), [], []
    for shape_of, i in once(a).items():
        if shape_of in there:
            at = bisect_left(ends, there[shape_of])
            chain = (i, there[shape_of], chains[at - 1] if at else None)
            chains[at:at + 1], ends[at:at + 1] = [chain], [there[shape_of]]
    out, chain = [], chains[-1] if chains else None
    while chain:
        out.append(chain[:2])
        chain = chain[2]
    return out[::-1]


def _match(a: list[Node], b: list[Node], known: dict, pairs: list | None) -> int:
    """Weight of the heaviest order-keeping match of two lists of trees; the matched pairs go to ``pairs``.

    Equal shapes at either end match each other, which never loses weight; the rest is aligned by dynamic programming. Lists that
    are too long for that are cut into stretches, so that their match keeps the order but need not be the heaviest.
    """
    low, high_a, high_b, total = 0, len(a), len(b), 0
    while low < min(high_a, high_b) and a[low].shape == b[low].shape:
        total += _weight(a[low], b[low], known)
        if pairs is not None:
            pairs.append((a[low], b[low]))
        low += 1
    while high_a > low and high_b > low and a[high_a - 1].shape == b[high_b - 1].shape:
        high_a, high_b = high_a - 1, high_b - 1
        total += _weight(a[high_a], b[high_b], known)
        if pairs is not None:
            pairs.append((a[high_a], b[high_b]))
    if low == high_a or low == high_b:
        return total
    if (high_a - low) * (high_b - low) > CELLS:
        a, b = a[low:high_a], b[low:high_b]
        cuts = _rare_pairs(a, b)
        if not cuts:
            parts = -(-(len(a) * len(b)) // CELLS) + 1
            cuts = [(len(a) * k // parts, len(b) * k // parts) for k in range(1, parts)]
        for (i, j), (k, m) in zip([(0, 0), *cuts], [*cuts, (len(a), len(b))], strict=True):
            if (i, j) == (0, 0) == (k, m):
                continue
            total += _match(a[i:k], b[j:m], known, pairs)
        return total
    rows = [[0] * (high_b - low + 1)]
    for x in a[low:high_a]:
        above, row = rows[-1], [0]
        for j, y in enumerate(b[low:high_b]):
            row.append(max(above[j + 1], row[j], above[j] + _weight(x, y, known)))
        rows.append(row)
    if pairs is not None:
        i, j = high_a - low, high_b - low
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((a[low + i], b[low + j]))
    return total + rows[-1][-1]


def align(page: Node, reference: Node) -> list[tuple[Node, Node]]:
    """Matched runs of text of two trees, by simple tree matching from their roots."""
    known, open_, out = {}, [(page, reference)], []
    while open_:
        a, b = open_.pop()
        if a.tag == "#":
            out.append((a, b))
        elif a.children and b.children:
            _match(a.children, b.children, known, open_)
    return out


def pack_tree(node: Node) -> list:
    """A tree as nested lists, with checksums in place of texts."""
    if node.tag == "#":
        return [zlib.crc32(node.text.encode("utf-8", "surrogatepass"))]
    return [f"{node.tag} {node.names}", *map(pack_tree, node.children)]


def unpack_tree(packed: list, count: list[int]) -> Node:
    """The tree again; runs of text are numbered in order as slots and keep the checksum as their text."""
    if not isinstance(packed[0], str):
        node = Node("#", 0, packed[0])
        node.slot, count[0] = count[0], count[0] + 1
        return node
    tag, _, names = packed[0].partition(" ")
    node = Node(tag, 0, names=names)
    node.children = [unpack_tree(p, count) for p in packed[1:]]
    return node


_ALIGNED = ("page_id long, url string, host string, layout string, evidence boolean, slots array<int>, same array<boolean>, "
            "doubtful array<boolean>, texts array<string>")


def _aligned_page(tree: Node, reference: Node | None):
    """Of a page's runs that may be content: whether they say anything about the template, as they do when any is not the
    reference's; their slots in the reference (-1: none), whether the text is the reference's, whether they are doubtful, and the texts."""
    runs = [n for n in texts(tree) if n.skipped != DECLARED]
    same: dict[int, bool] = {}
    if reference is not None:
        for mine, there in align(tree, reference):
            mine.slot = there.slot
            same[there.slot] = zlib.crc32(mine.text.encode("utf-8", "surrogatepass")) == there.text
    alike = [n.slot >= 0 and same[n.slot] for n in runs]
    return reference is not None and not all(alike), [n.slot for n in runs], alike, [n.skipped == DOUBTFUL for n in runs], [n.text for n in runs]


def _align(shared):
    """Pages (page_id, url, host, html; unless ``shared`` has the host's references, the reference and its layout) to their runs."""
    def run(batches):
        trees: dict[tuple[str, str], Node] = {}

        def tree_of(host: str, layout: str, packed: str) -> Node:
            if (host, layout) not in trees:
                if len(trees) >= 500:
                    trees.clear()
                trees[host, layout] = unpack_tree(json.loads(packed), [0])
                shape(trees[host, layout])
            return trees[host, layout]

        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tree, host = parse(row[3]), row[2]
                if shared is None:
                    layout, packed = row[4], row[5]
                else:
                    known = shared.value.get(host)
                    layout = skeleton(tree) if known else None
                    if known and layout not in known[0]:
                        layout = known[1]
                    packed = known[0][layout] if known else None
                out.append((*row[:3], layout, *_aligned_page(tree, tree_of(host, layout, packed) if packed is not None else None)))
            columns = list(zip(*out, strict=True)) if out else [[]] * 9
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.list_(pa.bool_()), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in _ALIGNED.split(", ")])

    return run


def _laid_out(batches):
    """Pages (host, turn, html) with their skeleton and tree."""
    for batch in batches:
        trees = [parse(p) for p in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([skeleton(t) for t in trees], pa.string()),
             pa.array([json.dumps(pack_tree(t), separators=(",", ":")) for t in trees], pa.string())], ["host", "turn", "layout", "tree"])


def _with_layout(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([skeleton(parse(p)) for p in batch.column(3).to_pylist()], pa.string())],
                                         ["page_id", "url", "host", "html", "layout"])


def _references(rows: DataFrame, least_pages: int) -> DataFrame:
    """``host, layout, tree, n, is_main``: a reference page of every layout with ``least_pages`` pages, and of each host's most frequent
    one, of hosts with that many pages."""
    turn = F.xxhash64("page_id", "url", "html").alias("turn")
    laid = mapped(rows.filter("host != '' and html is not null").select("host", turn, "html"), _laid_out, "host string, turn long, layout string, tree string")
    each = saved(laid.groupBy("host", "layout").agg(F.min_by("tree", "turn").alias("tree"), F.count(F.lit(1)).alias("n")), "layouts")
    of_host = each.groupBy("host").agg(F.sum("n").alias("pages"), F.max_by("layout", F.struct("n", "layout")).alias("main")).filter(F.col("pages") >= least_pages)
    found = each.join(of_host, "host").withColumn("is_main", F.col("layout") == F.col("main"))
    return saved(found.filter(F.col("is_main") | (F.col("n") >= least_pages)).select("host", "layout", "tree", "n", "is_main"), "references")


def extract(pages: DataFrame, least_pages: int = 5, least_share: float = 0.8, hot_hosts: int = 1000,
            hot_tree_bytes: int = 20_000, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``key``, ``url``, text (blocks joined by one newline, empty if none) and n_chars (code points) for every page.

    A slot is template when at least ``least_pages`` pages that differ from their layout's reference page were aligned to it
    and at least ``least_share`` of them say the same there; pages with the same texts count as one page. References of the ``hot_hosts``
    hosts with the most pages are sent to all tasks, as far as those of a host have at most ``hot_tree_bytes`` (so at most
    20 MB in all); all other hosts get theirs by a join, which gives the same. Pages without a host have no template. Pages of any
    length are read as a whole. Null html gives an empty text, null keys and repeated rows are pages like others, an empty table gives
    no rows, and other columns are not read.
    """
    spark = pages.sparkSession
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][\w+.-]*://([^/?#]+)", 1))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), host.alias("host"),
                        F.col(html).cast("string").alias("html"))
    references = _references(rows, least_pages)
    light = references.groupBy("host").agg(F.sum("n").alias("pages"), F.sum(F.octet_length("tree") + F.octet_length("layout")).alias("bytes")).filter(
        F.col("bytes") <= hot_tree_bytes).orderBy(F.desc("pages"), "host").limit(hot_hosts).select("host")
    hot: dict[str, list] = {}
    for r in references.join(light, "host", "left_semi").collect():
        known = hot.setdefault(r["host"], [{}, None])
        known[0][r["layout"]] = r["tree"]
        known[1] = r["layout"] if r["is_main"] else known[1]
    shared = spark.sparkContext.broadcast(hot)
    names = F.broadcast(spark.createDataFrame([(h,) for h in hot], "host string"))  # at most hot_hosts
    cold = references.join(names, "host", "left_anti")
    if cold.isEmpty():
        aligned = mapped(rows, _align(shared), _ALIGNED)
    else:
        laid = mapped(rows.join(names, "host", "left_anti").select(rows.columns), _with_layout, "page_id long, url string, host string, html string, layout string")
        own = cold.select("host", "layout", F.col("tree").alias("own"))
        main = cold.filter("is_main").select("host", F.col("tree").alias("main"), F.col("layout").alias("main_layout"))
        far = laid.join(own, ["host", "layout"], "left").join(main, "host", "left").select(
            *rows.columns, F.when(F.col("own").isNotNull(), F.col("layout")).otherwise(F.col("main_layout")).alias("layout"), F.coalesce("own", "main").alias("tree"))
        aligned = mapped(rows.join(names, "host", "left_semi").select(rows.columns), _align(shared), _ALIGNED).unionByName(mapped(far, _align(None), _ALIGNED))
    aligned = saved(aligned, "aligned")
    # Pages that repeat each other vote once.
    voters = aligned.filter("evidence").select("host", "layout", F.xxhash64("texts").alias("content"), "slots", "same").distinct()
    votes = voters.select("host", "layout", F.explode(F.arrays_zip("slots", "same")).alias("v")).filter("v.slots >= 0")
    template = votes.groupBy("host", "layout", "v.slots").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v.same").cast("int")).alias("same"))
    template = saved(template.filter((F.col("n") >= least_pages) & (F.col("same") >= least_share * F.col("n")))
                     .groupBy("host", "layout").agg(F.collect_set("slots").alias("constant")), "template")
    varying = F.filter(F.arrays_zip("slots", "doubtful", "texts"),
                       lambda b: ~F.array_contains(F.coalesce("constant", F.array().cast("array<int>")), b["slots"]))
    content = F.transform(F.array(varying), lambda v: F.when(F.exists(v, lambda b: ~b["doubtful"]), F.filter(v, lambda b: ~b["doubtful"])).otherwise(v))
    text = F.array_join(F.transform(content[0], lambda b: b["texts"]), "\n")
    return aligned.join(template, ["host", "layout"], "left").select(
        F.col("page_id").alias(key), F.col("url").alias(url), text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
