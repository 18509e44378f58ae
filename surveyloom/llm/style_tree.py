"""Main-text extraction with a site style tree.

Each page is parsed once, into a written table of its elements and text
blocks. The pages of a host are merged into one tree: elements with the same
path of tags and classes are one node. From the ``m`` pages that have it each
node gets two importances between 0 and 1:

* layout: the entropy of the sequences of child tags, over its largest value,
* content: one minus the mean entropy of the node's text blocks; a block found
  on one page has entropy 0, a block found on all of them 1.

``m`` pages are evidence of weight ``1 - 1/m``: one page says nothing, and what
a host repeats loses its importance little by little as pages are added.

On a page a block is worth its node's content importance times the mean of 1
and the largest layout importance around it. A branch is worth the mean of what
is kept in it, times what its purpose gives it beforehand: 1, less for what
stands outside the page's articles and for what is named like a menu, advert,
comment and so on. In each element, what is worth less than ``RATIO`` of the
best that the element holds is removed. As branches are only compared with what
stands beside them, an element that wraps the whole page is never removed, by
whatever name, and pages that are all alike lose nothing.

Headings, labels and the parts of lists and tables are no branches of their own:
they stay or go with the list, table or element around them. All articles of a
page count, and so does the text of its main part beside them. A class or id
names noise only if it says nothing else: ``related-posts`` does, ``related-work``
doesn't.

Menus, footers, asides, dialogs, page headers and ARIA landmarks are worth
nothing by their tag or role, so they go on every page.

Edge cases: a null or empty html gives an empty text; a null url belongs to the
host ""; repeated rows give repeated rows; empty tables give empty results;
other columns are ignored. Whole pages are read, however long.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.tables import table, written

#: What is worth less than this part of the best beside it is removed; the best must hold this share of the text there.
RATIO, SHARE = 0.3, 0.05
#: Worth beforehand of what stands outside the article, and of an element named like noise on a page without an article.
OUTSIDE, NAMED = 0.2, 0.1
#: Nodes of all trees that are handed to every task; more are joined to the pages that have them.
BROADCAST_NODES = 100_000

TOKEN = re.compile(
    r"<!--.*?-->|<!\[CDATA\[.*?\]\]>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>|<[!?/][^>]*+>", re.S
)
#: One attribute, consumed whole; only the names that matter here are captured.
ATTRIBUTE = re.compile(r"""(?:(class|id|role|hidden)(?![^\s/>=])|[^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s"'>][^\s>]*)))?""", re.I)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Start tags that end an open paragraph, and those that end an open element of the same kind.
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LISTS = frozenset("ul ol dl table menu select".split())
#: Never text of the page; not the article by tag or role.
UNSEEN = RAW | frozenset("head svg math canvas object audio video datalist".split())
NOT_ARTICLE = frozenset("nav footer aside menu button select dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
#: Words of classes and ids that noise is named by, and those that turn such a name into something else (has-sidebar).
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright disclaimer"
    " disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification pagination pager popup promo promotion promoted"
    " recommended recommendations related replies respond search share sharing sidebar sidenav signup social sponsor sponsored subscribe tagcloud toolbar topbar widget widgets".split()
)
#: Words that may stand beside them in such a name; any other word makes it the name of something else (related-work, share-price).
PLACES = frozenset(
    "area bar block body bottom box btn button buttons center col column container content count form group head heading icon icons inner item items label left link links list"
    " main module outer panel post posts primary right row secondary section site slot text title top unit wrap wrapper".split()
)
TURNED = frozenset("no not non has with without open closed enabled disabled".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: No branches of their own: headings, labels, and the parts of lists and tables, which stay or go with what they belong to.
PARTS = HEADINGS | frozenset("caption dd dt figcaption label legend li summary tbody td tfoot th thead tr".split())


#: Kinds of elements: text, named like noise, noise by tag or role, never seen.
TEXT, LIKE_NOISE, NOISE, HIDDEN = range(4)


class Page:
    """Elements and text blocks of one page. Element 0 is the document."""

    __slots__ = ("blocks", "children", "kind", "parent", "path", "tag")

    def __init__(self) -> None:
        self.tag, self.parent, self.path, self.kind, self.children = [""], [-1], [0], [TEXT], [[]]
        self.blocks: list[tuple[int, str]] = []


def noise_words(value: str) -> set[str]:
    """Words of a class or id that name noise: those of names that say nothing else."""
    found: set[str] = set()
    for name in value.split():
        words = set(re.findall(r"[a-z]+", name))
        if words <= NAMES | PLACES and TURNED.isdisjoint(words):
            found |= words & NAMES
    return found


def purpose(tag: str, attributes: str, in_article: bool) -> tuple[int, str]:
    """(kind, class names) of an element."""
    if tag in UNSEEN:
        return HIDDEN, ""
    kind, names = TEXT, ""
    if tag in NOT_ARTICLE or tag == "header" and not in_article:
        kind = NOISE
    elif tag == "form":
        kind = LIKE_NOISE
    if attributes and not attributes.isspace():
        for m in ATTRIBUTE.finditer(attributes):
            if m[1] is None:
                continue
            key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if key == "hidden" and tag not in ("html", "body"):
                kind = HIDDEN
            elif key == "role":
                kind = max(kind, NOISE if value in ROLES else TEXT)
            elif value:
                if key == "class":
                    names = value
                if tag not in ("html", "body", "main") and tag not in HEADINGS:
                    words = noise_words(value)
                    # an article's own header names itself so, and stays
                    if words and not (in_article and words <= {"header", "byline"}):
                        kind = max(kind, LIKE_NOISE)
    return kind, names


def parse(text: str) -> Page:
    page = Page()
    tag, parent, path, kind, children, blocks = page.tag, page.parent, page.path, page.kind, page.children, page.blocks
    stack, buffer, at, articles = [0], [], 0, 0

    def flush() -> None:
        if buffer:
            block = " ".join("".join(buffer).split())
            buffer.clear()
            if block:
                blocks.append((stack[-1], block))

    def close(down_to: int) -> None:
        nonlocal articles
        for e in stack[down_to:]:
            articles -= tag[e] == "article"
        del stack[down_to:]

    def text_run(run: str) -> None:
        if run and kind[stack[-1]] != HIDDEN:
            buffer.append(entities.unescape(run) if "&" in run else run)

    while True:
        m = TOKEN.search(text, at)
        if m is None:
            text_run(text[at:])
            break
        text_run(text[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            if name not in INLINE:
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if tag[stack[k]] == name:
                    if kind[stack[k]]:
                        flush()
                    close(k)
                    break
                if tag[stack[k]] in ("article", "body", "html") and name in INLINE:
                    break
            continue
        if name in VOID:
            if name in ("br", "hr"):
                flush()
            continue
        if name in ENDS_P:
            flush()
            for k in range(len(stack) - 1, 0, -1):
                t = tag[stack[k]]
                if t == "p":
                    close(k)
                    break
                if t not in INLINE:
                    break
        elif name in ENDS:
            flush()
            for k in range(len(stack) - 1, 0, -1):
                if tag[stack[k]] in ENDS[name]:
                    close(k)
                    break
                if tag[stack[k]] in LISTS:
                    break
        why, names = purpose(name, m[3], articles > 0)
        up = stack[-1]
        if kind[up] == HIDDEN:
            why = HIDDEN
        if name not in INLINE or why:
            flush()
        tag.append(name)
        parent.append(up)
        kind.append(why)
        children.append([])
        children[up].append(name)
        path.append(path[up] if name in INLINE else hash_of(f"{path[up]}/{name}.{names}"))
        if not (m[3].endswith("/") and name in ("svg", "path")):
            stack.append(len(tag) - 1)
            articles += name == "article"
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(text, at)
            at = end.start() if end else len(text)
    flush()
    return page


def hash_of(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def observations(page: Page) -> set[tuple[int, int]]:
    """(node, value) of a page: 0 for its presence, odd values for layouts, other even values for text blocks."""
    out = set()
    for e, own in enumerate(page.children):
        if own and page.kind[e] != HIDDEN and page.tag[e] not in INLINE:
            out |= {(page.path[e], 0), (page.path[e], hash_of(" ".join(own)) | 1)}
    for e, block in page.blocks:
        out |= {(page.path[e], 0), (page.path[e], hash_of(block) & ~1 or 2)}
    return out


def worth_beforehand(page: Page) -> tuple[list[float], list[float]]:
    """What each element's branch, and its own text, is worth by its purpose."""
    n, parent, kind, tag = len(page.tag), page.parent, page.kind, page.tag
    noise, size, inner, plain = [TEXT] * n, [0] * n, [False] * n, [False] * n
    for e in range(1, n):
        noise[e] = max(kind[e], noise[parent[e]])
    for e, block in page.blocks:
        size[e] += len(block)
        # text of a block element of its own, not of the branch's top
        plain[e] = True
    for e in range(n - 1, 0, -1):
        up = parent[e]
        size[up] += size[e]
        inner[up] |= inner[e] or plain[e] and tag[e] not in INLINE
    # articles and main parts with text, unmarked and not in noise: all of them, however short
    found = [e for e in range(1, n) if tag[e] in ("article", "main") and kind[e] == TEXT and size[e]]
    own_worth = dict.fromkeys((e for e in found if noise[e] == TEXT), 1.0)
    if not own_worth:
        # else those in what is named like noise, by their share of the longest one's length
        found = [e for e in found if noise[e] == LIKE_NOISE]
        longest = max((size[e] for e in found), default=0)
        own_worth = {e: max(OUTSIDE, size[e] / longest) for e in found}
    mains = list(own_worth)
    holds = [False] * n
    for e in mains:
        up = parent[e]
        while up >= 0 and not holds[up]:
            holds[up] = True
            up = parent[up]
    branch, text, within = [1.0] * n, [1.0] * n, [False] * n
    for e in range(n):
        up = parent[e]
        within[e] = e in own_worth or e > 0 and within[up]
        if mains and not within[e]:
            text[e] = OUTSIDE if holds[e] else 1.0
        if kind[e] >= NOISE:
            branch[e] = 0.0
        elif kind[e] == LIKE_NOISE and not holds[e]:
            branch[e] = 0.0 if mains or not inner[e] else NAMED
        elif e in own_worth and not (e > 0 and within[up]):
            branch[e] = own_worth[e]
        elif mains and e > 0 and holds[up] and not holds[e] and not within[e]:
            branch[e] = OUTSIDE
    return branch, text


def main_text(row: dict, tree: dict[int, tuple[float, float]]) -> str:
    """Text of a parsed page without branches of low importance; ``tree`` has (content, layout) of the host's nodes."""
    parent, path, branch, own, heading = row["parent"], row["path"], row["branch"], row["own"], row["heading"]
    owner, blocks = row["owner"], row["block"]
    n = len(parent)
    layout, chars, worth = [0.0] * n, [0] * n, [0.0] * n
    for e in range(1, n):
        layout[e] = max(layout[parent[e]], tree.get(path[e], (1.0, 1.0))[1])
    for e, block in zip(owner, blocks, strict=True):
        chars[e] += len(block)
    # what each element holds: (worth, characters, element; its own text for the element itself)
    held: list[list[tuple[float, int, int]]] = [[] for _ in range(n)]
    gone, silent = [False] * n, [False] * n
    for e in range(n - 1, -1, -1):
        parts = held[e]
        if chars[e]:
            parts.append((own[e] * tree.get(path[e], (1.0, 1.0))[0] * (1 + layout[e]) / 2, chars[e], e))
        if len(parts) > 1:
            least = SHARE * sum(c for w, c, _ in parts if w)
            limit = RATIO * max((w for w, c, _ in parts if c >= least), default=0.0)
        else:
            limit = 0.0
        total = kept = 0.0
        for w, c, x in parts:
            if w == 0 or w < limit and not (heading[x] and x != e and branch[x] == 1):
                if x == e:
                    silent[e] = True
                else:
                    gone[x] = True
            else:
                total += w * c
                kept += c
        held[e] = []
        if kept and e:
            held[parent[e]].append((branch[e] * total / kept, int(kept), e))
    for e in range(1, n):
        gone[e] = gone[e] or gone[parent[e]]
    return " ".join(block for e, block in zip(owner, blocks, strict=True) if not gone[e] and not silent[e])


def parsed_row(text: str) -> dict:
    """What is kept of a page: its elements, blocks and observations."""
    page = parse(text)
    branch, own = worth_beforehand(page)
    seen = sorted(observations(page))
    return {
        "parent": page.parent, "path": page.path, "branch": branch, "own": own, "heading": [t in PARTS for t in page.tag],
        "owner": [e for e, _ in page.blocks], "block": [x for _, x in page.blocks], "node": [k for k, _ in seen], "value": [v for _, v in seen],
    }


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


PARSED = {
    "parent": pa.list_(pa.int32()), "path": pa.list_(pa.int64()), "branch": pa.list_(pa.float32()), "own": pa.list_(pa.float32()), "heading": pa.list_(pa.bool_()),
    "owner": pa.list_(pa.int32()), "block": pa.list_(pa.string()), "node": pa.list_(pa.int64()), "value": pa.list_(pa.int64()),
}
PAGE = ["parent", "path", "branch", "own", "heading", "owner", "block"]
ROWS = (
    "uid long, page_id long, url string, host long, parent array<int>, path array<long>, branch array<float>, own array<float>, heading array<boolean>,"
    " owner array<int>, block array<string>, node array<long>, value array<long>"
)
#: Pages parsed before they are handed on.
BATCH = 500


def parsed_pages(pages: DataFrame) -> DataFrame:
    """One row per page with all that is needed of it. ``uid`` numbers the rows once they are written."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 34
        for batch in (x.slice(k, BATCH) for x in batches for k in range(0, x.num_rows, BATCH)):
            rows = [parsed_row(text.as_py() or "") for text in batch.column(3)]
            found = [pa.array([r[c] for r in rows], t) for c, t in PARSED.items()]
            numbers = pa.array(range(uid, uid + len(rows)), pa.int64())
            uid += len(rows)
            yield pa.RecordBatch.from_arrays([numbers, *batch.columns[:3], *found], names=["uid", "page_id", "url", "host", *PARSED])

    own = pages.select(F.col("page_id").cast("long"), "url", F.xxhash64(host_of(F.col("url"))).alias("host"), "html")
    return own.mapInArrow(parsed, ROWS)


def node_importance(parsed: DataFrame) -> DataFrame:
    """(host, node, content, layout) of the nodes that two pages or more have."""
    seen = parsed.select("host", F.explode(F.arrays_zip("node", "value")).alias("x")).select("host", "x.node", "x.value")
    values = seen.groupBy("host", "node", "value").agg(F.count(F.lit(1)).alias("n"))
    n, nlogn = F.col("n"), F.col("n") * F.log(F.col("n").cast("double"))
    style = F.col("value").bitwiseAND(1) == 1
    text = ~style & (F.col("value") != 0)
    nodes = values.groupBy("host", "node").agg(
        F.sum(F.when(F.col("value") == 0, n)).alias("m"),
        F.sum(F.when(style, n)).alias("styles"), F.sum(F.when(style, nlogn)).alias("styles_log"),
        F.sum(F.when(text, n)).alias("blocks"), F.sum(F.when(text, nlogn)).alias("blocks_log"),
    )
    most, known = F.log(F.col("m").cast("double")), 1 - 1 / F.col("m")
    layout = F.coalesce((F.log(F.col("styles").cast("double")) - F.col("styles_log") / F.col("styles")) / most, F.lit(0.0))
    content = F.coalesce(1 - F.col("blocks_log") / F.col("blocks") / most, F.lit(1.0))
    weighed = lambda c: (1 - (1 - c) * known).cast("double")
    return nodes.where("m > 1").select("host", "node", weighed(content).alias("content"), weighed(layout).alias("layout"))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text): the main text of each page. ``pages`` is read once."""
    spark = pages.sparkSession
    parsed = written(parsed_pages(pages), "parsed-pages")
    tree = written(node_importance(parsed), "style-tree")
    rows = parsed.select("uid", "page_id", "url", "host", *PAGE)
    few = tree.count() <= BROADCAST_NODES
    if few:
        trees: dict[int, dict[int, tuple[float, float]]] = {}
        for r in tree.collect():
            trees.setdefault(r.host, {})[r.node] = r.content, r.layout
        handed = spark.sparkContext.broadcast(trees)
    else:
        # each page gets its own nodes, however many its host has
        own = rows.select("uid", "host", F.explode(F.array_distinct("path")).alias("node")).join(tree, ["host", "node"])
        own = own.groupBy("uid").agg(F.collect_list(F.struct("node", "content", "layout")).alias("nodes"))
        rows = rows.join(own, "uid", "left")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x.slice(k, BATCH) for x in batches for k in range(0, x.num_rows, BATCH)):
            texts = []
            hosts, columns = batch.column(3).to_pylist(), [batch.column(4 + k).to_pylist() for k in range(len(PAGE))]
            if few:
                own = [handed.value.get(h, {}) for h in hosts]
            else:
                own = [{x["node"]: (x["content"], x["layout"]) for x in r or ()} for r in batch.column(4 + len(PAGE)).to_pylist()]
            for nodes, *page in zip(own, *columns, strict=True):
                texts.append(main_text(dict(zip(PAGE, page, strict=True)), nodes))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:3], pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return rows.mapInArrow(extracted, "page_id long, url string, text string")


def op10_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
