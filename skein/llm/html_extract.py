"""HTML extraction by site template removal.

A page is parsed into elements; each element's subtree gets a hash of its tags, attributes and text. Spark counts for each
host on how many pages a subtree occurs, pages of the same text being one; those on at least MIN_PAGES pages and SHARE of the host's pages are the site's
template and are deleted, together with elements whose tag, role or class says that they are not main text. What is left
of the article (or the body, where a page marks no article) is the text, a line a block.

Plain paragraphs, headings and other prose elements inside a marked article are never taken for template: pages with copied
articles repeat them too, and they are the main text.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.chunks import arrow_map
from skein.storage import materialize

MIN_PAGES, SHARE = 5, 0.2
BROADCAST_BYTES = 8 << 20

# No pattern below can go back over what it has read (possessive repeats), so that broken markup costs linear time.
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/][^>]*+>""", re.S)
#: After a quote that never ends: a tag ends at the next `>`, quoted or not.
_TAG_UNQUOTED = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>", re.S)
_OPENS = re.compile(r"<[a-zA-Z/!?]")
_ATTR = re.compile(r"""([^\s=/>"']++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?+""")
_RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+>", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
_DROP = frozenset("head script style noscript template nav header footer aside form button select option textarea input iframe object svg canvas audio video dialog menu title".split())
_DROP_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Classes and ids, whole names, that mark what is not main text, wherever they stand.
_DROP_NAME = frozenset("ad ads advert adverts advertisement sponsor sponsored promo promotion cookie cookies consent gdpr popup modal newsletter subscribe navbar breadcrumb breadcrumbs comment comments commentlist disqus replies pagination pager cookie-banner cookie-notice cookie-consent comment-list site-header site-footer".split())
#: Names that mean it outside an article, and inside only with a second sign: that most of the text is links, or that the host repeats the subtree.
_WEAK_NAME = frozenset("banner notice sidebar menu nav navigation header footer masthead share sharing social related widget".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre b i em strong a span br code ul ol li table thead tbody tr td th figure figcaption dl dt dd".split())
#: Opening one of these ends an open element of the set, up to the nearest of the bounds.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select"})}
_P_BOUNDS = frozenset("table td th caption button object".split())


class Node:
    __slots__ = ("tag", "attrs", "items")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.items = tag, attrs, []


def parse(text: str) -> Node:
    """Tree of elements and raw strings; broken, truncated and wrongly nested markup gives the nearest tree.

    A tag that the text's end cuts off is markup and goes. A tag whose quote never ends stops at its first `>`, as all after
    it do. Time is linear in the text, however it is broken: places of open elements are kept by tag.
    """
    root = Node("#root")
    stack, at, size = [root], 0, len(text)
    places: dict[str, list[int]] = defaultdict(list)  # where in the stack each tag is open
    final, tags = text.rfind(">") + 1, _TAG

    def close(upto: int) -> None:
        for node in stack[max(1, upto) :]:
            places[node.tag].pop()
        del stack[max(1, upto) :]

    def nearest(of: frozenset[str] | set[str]) -> int:
        return max((places[t][-1] for t in of if places[t]), default=-1)

    while at < size:
        opens = _OPENS.search(text, at)
        upto = opens.start() if opens else size
        if upto > at:
            stack[-1].items.append(text[at:upto])
        if not opens:
            break
        m = tags.match(text, upto)
        if m is None and upto < final:  # a quote that never ends
            tags = _TAG_UNQUOTED
            m = tags.match(text, upto)
        if m is None:  # cut off by the text's end
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if places[tag]:
                close(places[tag][-1])
            elif tag == "br":
                stack[-1].items.append(Node("br"))
            continue
        if tag in _BLOCK and places["p"] and places["p"][-1] > nearest(_P_BOUNDS):
            close(places["p"][-1])
        if tag in _ENDS:
            ends, bounds = _ENDS[tag]
            k = nearest(ends)
            if k > nearest(bounds):
                close(k)
        node = Node(tag, m[3].strip())
        stack[-1].items.append(node)
        if tag in _RAW and not m[3].endswith("/"):
            end = _RAW[tag].search(text, at, final) if at < final else None
            node.items.append(text[at : end.start() if end else size])
            at = end.end() if end else size
        elif tag not in _VOID:
            places[tag].append(len(stack))
            stack.append(node)
    return root


def _attributes(node: Node) -> dict[str, str]:
    return {k.lower(): entities.unescape(v.strip("\"'")) for k, v in _ATTR.findall(node.attrs)} if node.attrs else {}


def _link_share(node: Node) -> float:
    """Share of a subtree's characters, white space aside, that stand in links."""
    total, linked, todo = 0, 0, [(node, False)]
    while todo:
        x, inside = todo.pop()
        for y in x.items:
            if isinstance(y, str):
                n = len("".join(y.split()))
                total, linked = total + n, linked + n * inside
            else:
                todo.append((y, inside or y.tag == "a"))
    return linked / total if total else 1.0


def _dropped(node: Node, inside: bool = False) -> bool:
    """Whether tag, role, class or id say that an element is not main text; articles are judged as well, main and body never.

    inside: it lies in an article. There a header is the article's own, and a weak name needs a second sign; what the host
    repeats goes as template. Headings aren't judged by name.
    """
    if node.tag in _DROP and not (inside and node.tag == "header"):
        return True
    if not node.attrs or node.tag in ("html", "body", "main"):
        return False
    a = _attributes(node)
    if "hidden" in a or a.get("aria-hidden") == "true" or a.get("role") in _DROP_ROLE or a.get("itemprop") == "comment":
        return True
    if node.tag in _HEADINGS:
        return False
    names = {x.lower() for k in ("class", "id") if k in a for x in a[k].split()}
    return bool(names & _DROP_NAME) or bool(names & _WEAK_NAME) and (not inside or _link_share(node) > 0.5)


def _walk(root: Node, out: dict[int, int]) -> None:
    """out gets id(element) -> hash of its subtree, for those that may be template."""
    order, todo = [], [(root, False)]
    while todo:
        node, inside = todo.pop()
        inside = inside or node.tag in ("article", "main")
        order.append((node, inside))
        todo += [(x, inside) for x in node.items if not isinstance(x, str)]
    hashes: dict[int, int] = {}
    for node, inside in reversed(order):  # an element comes after all it contains
        parts = [node.tag, node.attrs, *(x if isinstance(x, str) else f"{hashes[id(x)]:x}" for x in node.items)]
        h = hashes[id(node)] = xxhash.xxh64_intdigest("\x00".join(parts)) - (1 << 63)
        if node.tag[0] != "#" and node.tag not in ("html", "head", "body", "article", "main") and not (inside and node.tag in _PROSE and not node.attrs) and node.items:
            out[id(node)] = h


def subtree_hashes(root: Node) -> dict[int, int]:
    out: dict[int, int] = {}
    _walk(root, out)
    return out


def main_text(root: Node, template: frozenset[int] | set[int] = frozenset()) -> str:
    """Text of what is left when template subtrees and elements that are not main text go."""
    hashes = subtree_hashes(root) if template else {}

    def find() -> list[Node]:
        """The outermost articles and mains: those that are not dropped, or else (a class that misleads) all of them."""
        out, rest, todo = [], [], [root]
        while todo:
            node = todo.pop()
            if node.tag in ("article", "main"):
                (rest if _dropped(node) else out).append(node)
            else:
                todo += [x for x in reversed(node.items) if not isinstance(x, str) and (x.tag == "article" or not _dropped(x)) and hashes.get(id(x)) not in template]
        return out or rest

    blocks: list[str] = []
    buffer: list[str] = []

    def flush() -> None:
        line = " ".join(entities.unescape("".join(buffer)).split())
        buffer.clear()
        if line:
            blocks.append(line)

    def gather(node: Node) -> None:
        inside = node.tag in ("article", "main")
        todo: list[Node | str | None] = list(reversed(node.items))  # None ends a block
        while todo:
            x = todo.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                buffer.append(x)
            elif x.tag == "br":
                buffer.append(" ")
            elif not _dropped(x, inside) and hashes.get(id(x)) not in template:
                if x.tag in _BLOCK:
                    flush()
                    todo.append(None)
                todo += reversed(x.items)

    for node in find() or [root]:
        gather(node)
        flush()
    return "\n".join(blocks)


def host_of(url):
    """Host of a URL column in lower case; the empty string for null and for what is no URL."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def site_templates(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """(host, hash) of the subtrees that are a host's template. As each takes a share of the pages, a host has at most subtrees a page / share of them. Pages of a host that have the same text without templates count once."""
    rows = pages.select(host_of(F.col(f"`{url_col}`")).alias("host"), F.col(f"`{html_col}`").cast("string").alias("html"))

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, found = [], []
            for x in b.column(1):
                root = parse(x.as_py() or "")
                text.append(xxhash.xxh64_intdigest(main_text(root)) - (1 << 63))
                found.append(sorted(set(subtree_hashes(root).values())))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["host", "content", "hashes"])

    # Copies differ at most in what is dropped anyway; the one whose subtrees come first in order stands for them.
    distinct = arrow_map(rows, contents, "host string, content long, hashes array<long>").groupBy("host", "content").agg(F.min("hashes").alias("hashes"))
    hashes = F.explode(F.concat(F.array(F.lit(None).cast("long")), "hashes"))  # null stands for the page
    counts = materialize(distinct.select("host", hashes.alias("hash")).groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") >= min_pages) | F.col("hash").isNull()), "subtrees")
    total = counts.filter("hash is null").select("host", F.col("n").alias("pages"))
    return counts.filter("hash is not null").join(total, "host").filter(F.col("n") >= share * F.col("pages")).select("host", "hash")


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES, share: float = SHARE, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(id_col, url_col, text, n_chars) of each page; the text is empty if there is none.

    A null html is empty; an empty table gives an empty one; a very long page is parsed in one task, in linear time; repeated rows
    and ties need no care. Pages without a host (or a null url) are one site. Copies of a page count once for the template. White space
    in a block becomes one space, blocks are joined by a newline. Other columns take no part. Templates are broadcast if
    they are measured to be below broadcast_bytes; else each host's list is joined to its pages, where AQE splits a hot host's.
    """
    spark = pages.sparkSession
    templates = materialize(site_templates(pages, url_col, html_col, min_pages, share), "templates")
    size = templates.agg(F.sum(F.length("host") + 16)).first()[0] or 0
    kind, url_kind = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))
    rows = pages.select(F.col(f"`{id_col}`").alias("k"), F.col(f"`{url_col}`").alias("u"), F.col(f"`{html_col}`").cast("string").alias("h"), host_of(F.col(f"`{url_col}`")).alias("host"))
    small = size < broadcast_bytes
    by_host: dict[str, list[int]] = defaultdict(list)
    if small:
        for r in templates.collect():  # below broadcast_bytes
            by_host[r["host"]].append(r["hash"])
    shared = spark.sparkContext.broadcast({h: frozenset(x) for h, x in by_host.items()})
    if not small:
        rows = rows.join(templates.groupBy("host").agg(F.sort_array(F.collect_list("hash")).alias("hashes")), "host", "left").select("k", "u", "h", "host", "hashes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, frozenset[int]] = dict(shared.value)

        def of(b: pa.RecordBatch, i: int) -> frozenset[int]:
            host = b.column(3)[i].as_py()
            if not small and host not in known:
                if len(known) >= 64:
                    known.clear()
                known[host] = frozenset(b.column(4)[i].as_py() or ())
            return known.get(host, frozenset())

        for b in batches:
            texts = [main_text(parse(h.as_py()), of(b, i)) if h.is_valid else "" for i, h in enumerate(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["k", "u", "text", "n_chars"])

    return arrow_map(rows, run, f"k {kind}, u {url_kind}, text string, n_chars long").toDF(id_col, url_col, "text", "n_chars")
