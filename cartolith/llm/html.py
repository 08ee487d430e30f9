"""HTML extraction (operator 9): a site style tree over the pages of each host.

Every page is parsed, in workers, into a tree of its blocks.  Same-host trees are merged by path (tags, and classes without
longer numbers).  A node of the merged tree has two entropies, to the base of the number of pages that have it: that of its
presentations (the sequences of child tags) and that of its contents; and its mean share of a page's text.  Its importance
is share times the larger entropy: how much of a page it holds, and how much of that differs from page to page.

* A branch of which both entropies are below ``LOW`` looks and reads alike on most pages: it goes, inside an article too.
* The main branch is the ``article`` or ``main`` where these hold half of the text, on the page or on average of the host.
  Outside of it all goes but branches of importance ``LEAST`` or more.  Where articles are teasers or there are none, the branch
  with most text is followed down from the body, and branches beside it go that are of less importance and look alike.
* Elements whose role HTML itself defines (nav, footer, aside, form, header outside of an article ..) go.
* Class and id are hints where the tree has no judgement, as on hosts of few pages: there a branch named by such words alone
  (``cookie-notice``, ``site-header``) goes; ``post-header`` or ``menu-prices`` are no such names, and paragraphs, headings, cells and
  sections of an article with a heading of their own are never judged by name.  Readers' comments and adverts differ from page to page
  as the text does, so the tree cannot know them: they go by name everywhere, also nested articles of that name, and comments
  by a heading that says so.
* What holds the main branch never goes, nor does, where no such branch has text, a form, header or unnamed branch of more than half of a page.

Equal pages of a host count once; a path on fewer than ``LEAST_PAGES`` pages is judged by its own page alone.  Counts are gathered
by partial aggregation, so a hot host is no hot task; a host's paths are joined back, as many as its templates have.  Character
references are decoded, white space inside a block becomes one space, blocks are joined by an empty line.  Malformed pages
are read as browsers do where it matters: unclosed tags, stray end tags, attributes with ``>`` in quotes, a tag cut off by
the end of the page.

Null html is an empty page; a null or odd url is a host of its own; repeated rows get equal results; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Written, table

#: Entropy below which a branch is furniture, importance that a branch beside the main one needs, pages needed to judge.
LOW, LEAST, LEAST_PAGES = 0.3, 0.25, 8

# Element and attribute names with a meaning of their own.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes noscript xmp template".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINER = frozenset("article aside body details div dl fieldset figure footer form header main menu nav ol section table ul".split())
ROLE_TAG = frozenset("nav aside footer form dialog menu head".split())
MUTED = frozenset("button select svg object audio video canvas map datalist".split())
ROLE = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
# Words of class and id.
COMMENT_WORD = frozenset("comment comments commentlist disqus replies reply respond".split())
NOISE_WORD = COMMENT_WORD | frozenset(
    "ad ads adv advert advertisement advertising adverts banner banners breadcrumb breadcrumbs consent cookie cookies footer gdpr header masthead menu menus modal nav navbar navigation newsletter notice notices notification overlay pagination popup promo promoted promotion related share sharing sidebar sidebars signup social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
#: What the tree cannot tell from text.
VARIED_WORD = COMMENT_WORD | frozenset("ad ads adv advert advertisement advertising adverts sponsor sponsored promoted".split())
COMMENT_HEADING = re.compile(r"[\W\d]*(?:comments?|replies|responses|kommentare?|antworten|commentaires?|réponses|comentarios?|respuestas)[\W\d]*", re.I)
NEUTRAL_WORD = frozenset("area bar block bottom box container form global inner item items left link links list main outer page primary reader right secondary section site thread top user wrap wrapper".split())
UNNAMED = frozenset("body html main p h1 h2 h3 h4 h5 h6 hgroup td th tr tbody thead tfoot pre blockquote li dd dt".split())
ENDS_P = BLOCK - frozenset("body html head option".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
SIBLINGS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option", "tbody": "tbody thead tfoot tr td th", "thead": "tbody thead tfoot", "tfoot": "tbody thead tfoot tr td th"}

MARKUP = re.compile(r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|\Z)", re.I)
NAME = re.compile(r"[^\W\d_]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """A block: items are texts and blocks in page order; parents come before children in a page's list of nodes."""

    __slots__ = ("tag", "path", "parent", "items", "gone", "role", "named", "varied", "main", "under", "chars", "own", "digest", "holds")

    def __init__(self, tag: str, path: bytes, parent: "Node | None"):
        self.tag, self.path, self.parent = tag, path, parent
        self.items: list = []
        self.gone = self.role = self.named = self.varied = self.main = self.holds = False
        self.under = parent is not None and (parent.main or parent.under)  # inside a main branch
        self.chars = self.own = 0
        self.digest = b""


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(source)} if source and not source.isspace() else {}


def named(words: str) -> set[str]:
    """Noise words of class names and ids that consist of such words and neutral ones alone."""
    out: set[str] = set()
    for name in words.lower().split():
        parts = set(NAME.findall(name))
        if parts and parts <= NOISE_WORD | NEUTRAL_WORD:
            out |= parts & NOISE_WORD
    return out


def _judge(node: Node, a: dict[str, str]) -> None:
    tag, role = node.tag, a.get("role", "").lower() if a else ""
    node.main = tag in ("article", "main") or role in ("main", "article")
    node.role = tag in ROLE_TAG or (tag == "header" and not node.under) or role in ROLE
    if a:
        node.gone = "hidden" in a or a.get("aria-hidden", "").lower() == "true" or bool(HIDDEN.search(a.get("style", "")))
        if tag not in UNNAMED:
            words = named(f"{a.get('class', '')} {a.get('id', '')}")
            node.named = bool(words if tag != "article" else words & COMMENT_WORD)
            node.varied = bool(words & VARIED_WORD)
            node.main &= not node.named


def parse(page: str) -> list[Node]:
    """The blocks of a page, the root first."""
    root = Node("#", b"", None)
    nodes = [root]
    stack: list[tuple[str, Node, bool]] = [("#", root, False)]  # open elements, their block, and whether they are muted
    opened: Counter[str] = Counter()
    buffer: list[str] = []
    at, end = 0, len(page)

    def push(tag: str, node: Node, muted: bool) -> None:
        stack.append((tag, node, muted))
        opened[tag] += 1

    def flush() -> None:
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                stack[-1][1].items.append(text)

    def close(depth: int) -> None:
        while len(stack) > depth:
            if stack[-1][0] in BLOCK:
                flush()
            opened[stack.pop()[0]] -= 1

    for m in MARKUP.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at and not stack[-1][2]:
            buffer.append(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag = name.lower()
        if m[1] or m[4]:
            if tag == "br":
                buffer.append(" ")
                continue
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i][0] == tag:
                    close(i)
                    break
                if tag not in BLOCK and stack[i][0] in BLOCK:
                    break
            if tag in BLOCK:
                flush()
            continue
        if tag in RAW:
            if tag not in ("script", "style"):
                flush()
            stop = re.compile(rf"</{re.escape(tag)}\s*/?>", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        if tag in VOID:
            if tag in ("br", "img", "input"):
                buffer.append(" ")
            elif tag == "hr":
                flush()
            continue
        a = _attributes(m[3] if m[2] else m[6])
        if tag not in BLOCK:
            hidden = bool(a) and ("hidden" in a or a.get("aria-hidden", "").lower() == "true" or bool(HIDDEN.search(a.get("style", ""))))
            push(tag, stack[-1][1], stack[-1][2] or hidden or tag in MUTED)
            continue
        if tag in ENDS_P and opened["p"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] in BLOCK:
                    break
        if tag in SIBLINGS:
            also = SIBLINGS[tag].split()
            for i in range(len(stack) - 1, 0, -1) if any(opened[k] for k in also) else ():
                if stack[i][0] in also:
                    close(i)
                    if tag not in ("tr", "tbody", "tfoot"):
                        break
                elif stack[i][0] in ("ul", "ol", "dl", "table", "select", "div", "section", "article", "menu"):
                    break
        flush()
        above = stack[-1][1]
        label = tag + ("." + ".".join(sorted(re.sub(r"\d{2,}", "", a["class"].lower()).split())) if a.get("class") else "")
        node = Node(tag, blake2b(above.path + label.encode("utf-8", "replace"), digest_size=8).digest(), above)
        _judge(node, a)
        if tag in HEADING and above.tag == "section" and above.under and not above.varied:
            above.named = False
        above.items.append(node)
        nodes.append(node)
        push(tag, node, stack[-1][2])
    if at < end and not stack[-1][2]:
        buffer.append(page[at:])
    flush()
    return measured(nodes)


def measured(nodes: list[Node]) -> list[Node]:
    """Sets of each block its characters (of all text, and of what no role or name takes out), digest, and whether it holds the main branch."""
    for x in nodes:
        above = x.parent
        if x.tag in HEADING and above.tag in ("section", "div") and above.items[0] is x and COMMENT_HEADING.fullmatch(" ".join(y for y in x.items if isinstance(y, str))):
            above.named = above.varied = True
    barred: set[int] = set()
    for x in nodes:
        if x.parent is not None and (id(x.parent) in barred or x.gone or x.named or (x.role and x.tag not in ("form", "header"))):
            barred.add(id(x))
        elif x.main:
            y = x
            while y is not None and not y.holds:
                y.holds, y = True, y.parent
    for x in reversed(nodes):
        h = blake2b(digest_size=8)
        for item in x.items:
            if isinstance(item, str):
                x.chars += len(item)
                x.own += len(item)
                h.update(item.encode("utf-8", "replace") + b"\n")
            else:
                x.chars += 0 if item.gone else item.chars
                x.own += 0 if item.gone or ((item.role or item.named) and not item.holds) else item.own
                h.update(item.digest)
        x.digest = h.digest()
    return nodes


def branches(nodes: list[Node]) -> dict[bytes, tuple[bytes, bytes, float]]:
    """Of the containers of a page by path: presentation, content and share of text."""
    whole, out = max(nodes[0].own, 1), {}
    for x in nodes:
        if x.tag in CONTAINER:
            tags = [item.tag for item in x.items if not isinstance(item, str)]
            style = " ".join(t for i, t in enumerate(tags) if i == 0 or t != tags[i - 1]).encode()
            before = out.get(x.path, (b"", b"", 0.0))
            out[x.path] = (blake2b(before[0] + style, digest_size=8).digest(), blake2b(before[1] + x.digest, digest_size=8).digest(), before[2] + min(x.own / whole, 1.0))
    return out


def extract(page: str, tree: dict[int, tuple[float, float, float]] | None = None, hints: bool = True) -> str:
    """The main text of a page; tree: style entropy, content entropy and mean share of the host's paths; hints: whether names of classes count."""
    nodes = parse(page)
    root, whole = nodes[0], max(nodes[0].own, 1)
    mains = [x for x in nodes if x.main and x.holds and not x.under]
    said = any(x.own for x in mains)
    of = lambda x: (tree or {}).get(int.from_bytes(x.path, "little", signed=True))

    def weighed(x: Node) -> tuple[float, float, bool]:
        """Share, importance, and whether all pages show it alike."""
        t = of(x)
        return (t[2], t[2] * max(t[0], t[1]), t[0] < LOW) if t else (x.own / whole, x.own / whole, False)

    def taken(x: Node) -> bool:
        if x.gone:
            return True
        if x.holds:
            return False
        if x.named and hints and x.chars < root.chars and (x.varied or of(x) is None):
            return True
        if not said and (2 * x.chars > root.chars and x.tag in ("form", "header", "div", "section") or 2 * x.own > whole and not x.role):
            return False
        return x.role or ((t := of(x)) is not None and x.tag in CONTAINER and max(t[:2]) < LOW)

    beside: set[int] = set()
    if mains and (2 * sum(x.own for x in mains) >= whole or 2 * sum({x.path: weighed(x)[0] for x in mains}.values()) >= 1):
        titled = any(h.tag in ("h1", "h2") for x in mains for h in below(x))
        for x in nodes:
            if x.parent is not None and x.parent.holds and not x.holds and not x.under:
                if weighed(x)[1] < LEAST and (titled or x.tag != "h1") or x.tag not in CONTAINER | {"h1"}:
                    beside.add(id(x))
        only = True
    else:
        only, x = False, next((x for x in nodes if x.tag == "body"), root)
        while True:
            inner = [y for y in x.items if not isinstance(y, str) and y.tag in CONTAINER and not taken(y)]
            best = max(inner, key=lambda y: weighed(y)[0], default=None)
            if best is None or weighed(best)[0] < 0.6:
                break
            beside |= {id(y) for y in inner if y is not best and weighed(y)[1] < LEAST and weighed(y)[2] and not y.holds}
            x = best

    def told(beside: set[int], only: bool) -> list[str]:
        out: list[str] = []
        todo: list = [(root, False)]
        while todo:
            x, inside = todo.pop()
            if isinstance(x, str):
                out.append(x)
                continue
            if x.parent is not None and (id(x) in beside or taken(x)):
                continue
            inside = inside or not only or (x.main and x.holds) or not x.holds
            todo += [(y, inside) for y in reversed(x.items) if inside or not isinstance(y, str)]
        return out

    return "\n\n".join(told(beside, only) or told(set(), False))


def below(x: Node):
    todo = [x]
    while todo:
        y = todo.pop()
        yield y
        todo += [z for z in y.items if not isinstance(z, str)]


def _counted(batches):
    whole = lambda x: int.from_bytes(x, "little", signed=True)
    for b in batches:
        rows = set()
        for host, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            key = blake2b((page or "").encode("utf-8", "replace"), digest_size=16).hexdigest()
            rows |= {(host, whole(path), key, whole(style), whole(content), share) for path, (style, content, share) in branches(parse(page or "")).items()}
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["host", "path", "page", "s", "c", "share"])


def _extracted(batches):
    for b in batches:
        texts = []
        for page, paths in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            texts.append(extract(page or "", {x["path"]: (x["style"], x["content"], x["share"]) for x in paths or ()}))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def style_tree(pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, html) -> host, path, pages, style, content, share: one row per node of each host's tree that enough pages have."""
    seen = pages.mapInArrow(_counted, "host string, path bigint, page string, s bigint, c bigint, share double").distinct()
    values = seen.select("host", "path", "share", F.expr("stack(2, 's', s, 'c', c) as (kind, value)"))
    values = values.groupBy("host", "path", "kind", "value").agg(F.count("*").alias("n"), F.sum("share").alias("share"))
    kinds = values.groupBy("host", "path", "kind").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("nlogn"), F.sum("share").alias("share"))
    bits = F.when(F.col("m") > 1, (F.log("m") - F.col("nlogn") / F.col("m")) / F.log("m")).otherwise(1.0)
    of = lambda k: F.max(F.when(F.col("kind") == k, bits))
    tree = kinds.groupBy("host", "path").agg(F.max("m").alias("pages"), of("s").alias("style"), of("c").alias("content"), (F.max("share") / F.max("m")).alias("share"))
    return tree.where(F.col("pages") >= least_pages)


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, html) -> page_id, url, text."""
    p = pages.select("page_id", "url", "html", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#:]*)", 1)).alias("host"))
    tree = style_tree(p.select("host", "html")).groupBy(F.col("host").alias("__host")).agg(F.collect_list(F.struct("path", *(F.round(k, 6).alias(k) for k in ("style", "content", "share")))).alias("tree"))
    tree = Written(tree, "styles").sized()
    x = p.join(tree, p["host"] == tree["__host"], "left").select("page_id", "url", "html", "tree")
    kind = dict(pages.dtypes)
    return x.mapInArrow(_extracted, f"page_id {kind['page_id']}, url string, text string")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
