"""Main text of web pages by wrapper induction.

Pages of one host come from one template. Every page is parsed into a DOM tree; equal siblings
are folded into one, which leaves the page's skeleton. The most frequent skeleton of a host is
its wrapper, and every page's skeleton is aligned with it by simple tree matching (the order
preserving alignment of most nodes whose parents are aligned); what is not aligned is known by
its aligned ancestor and the labels below. Over all pages of the host it is counted for each node
in how many different pages the same text stands there. Nodes of the same text in most pages are
template, unless HTML marks them as article or main part; so are the parts that HTML itself marks
as no content (menus, forms, scripts, notices and so on, by element or by name). A name counts
if all its words say so (``related-posts``, not ``related-work``); in a marked article it drops
no heading, paragraph or table, and a name that may be content's too (``WEAK_NAMES``) drops a
part only if links outweigh its text, or the text there is the same in most pages. A form that
holds the article or most of the paragraphs is a container. The varying slots
remain. Those that are bare text of plain containers and short in every page (``SIDE_CHARS``: ids,
dates, counters) are side parts; the lowest node that covers all others, and no node inside a
marked article, is where the article is. The page's text there, and marked text wherever it
stands, is its main text: only template and side parts outside the article are dropped. A page
that has none, or whose host has fewer than ``LEAST_PAGES`` different pages, is read by the marks
alone.

Defined results: null and empty html give an empty text, as do pages without content. A null
url is a host of its own. Repeated rows count as one page for the template and give a row each.
Broken markup is read as far as it goes: an element ends with its parent; an unclosed comment,
script or style swallows the rest.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loopcount.llm.common import prepare, sliced, stored

#: A text that stands in this share of a host's different pages (and in LEAST_PAGES) is template.
CONSTANT_SHARE = 0.5
LEAST_PAGES = 4
#: Characters that a side part has in a page at most.
SIDE_CHARS = 16
#: Ends the name of a node in a part of an article that a weak name doubts: there, constant text is template.
DOUBT = "~"
#: Depth to which trees are aligned.
DEPTH = 200
#: What all hosts' wrappers may take to be broadcast; else pages are joined with them in a shuffle.
BROADCAST_BYTES = 16 << 20

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noframes xmp".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul""".split())
ENDS_P = BLOCK - frozenset("body html caption td th tr tbody thead tfoot option legend summary".split())
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
#: Elements and names (words of class, id and role) that are no content.
NO_CONTENT = frozenset("""head title script style noscript template nav menu footer aside form button select textarea input iframe noframes object embed
svg canvas dialog audio video math""".split())
#: Words of names of such parts; a name counts only if all its words are of these or of ANY_PART.
SURE_NAMES = frozenset("""ad ads advert adverts advertisement advertising advertorial sponsor sponsors sponsored promo promos promotion promotions cookie
cookies consent gdpr comment comments disqus respond share sharing social newsletter subscribe subscription signup breadcrumb breadcrumbs pagination
pager popup modal overlay navbar nav navigation sidebar masthead""".split())
#: In a marked article these need more evidence: only links, or the same text in most pages of the host.
WEAK_NAMES = frozenset("""banner menu side footer header notice alert related login search skip copyright legal toolbar widget""".split())
ANY_PART = frozenset("""bar box area block list links link container wrapper wrap inner outer slot unit section content post posts article articles page site
main top bottom left right buttons button icons media form item items group panel column col row module region and to by the in text label policy
message messages primary secondary global local mobile desktop""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold text of their own: a name alone doesn't drop them from a marked article.
TEXTS = HEADINGS | frozenset("p blockquote pre figure figcaption dl dt dd table td th tr tbody thead tfoot caption address".split())
CONTROLS = frozenset("input select textarea button label fieldset legend option".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*+|[^>]*)>|<[!?][^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WHITE = re.compile(r"\s+")
_WORDS = re.compile(r"[^\s_-]+")
_MARKED = r"(^|>)(article|main)([.>]|$)"
#: Nodes in a part that has more of a meaning than to hold others.
_TEXT_PART = "(^|>)(" + "|".join(sorted(BLOCK - {"html", "body", "center", "div", "section"})) + ")([.>]|$)"
_DIGITS = re.compile(r"\d+")


@lru_cache(maxsize=4096)
def named(name: str) -> int:
    """2: a name of a part that is no content; 1: one that needs more evidence in an article; 0: none.
    Every word of the name has to say so: ``related-posts`` does, ``related-work`` does not."""
    words = [w for w in _WORDS.findall(name) if not w.isdigit()]
    if not words or not all(w in SURE_NAMES or w in WEAK_NAMES or w in ANY_PART for w in words):
        return 0
    return 2 if not SURE_NAMES.isdisjoint(words) else 1 if not WEAK_NAMES.isdisjoint(words) else 0


class Element:
    """``no_content``: by its tag; ``by_name``: what ``named`` says of its class, id or role."""
    __slots__ = ("tag", "label", "no_content", "by_name", "children")

    def __init__(self, tag: str, attributes: str):
        found = [(m[1].lower(), (m[2] or m[3] or m[4] or "").strip().lower()) for m in _ATTRIBUTE.finditer(attributes)] if attributes else []
        names = " ".join(value for _, value in found)
        self.tag = tag
        self.label = tag + ("." + _DIGITS.sub("", names.split()[0]) if names.strip() else "")
        self.no_content = tag in NO_CONTENT
        self.by_name = 0
        if found and tag not in ("html", "body", "article", "main"):
            # The id of a heading is an anchor to it, no name of a part.
            self.by_name = max((named(n) for kind, value in found if kind != "id" or tag not in HEADINGS for n in value.split()), default=0)
        self.children: list[Element | str] = []


def parse(source: str) -> Element:
    """The DOM tree of a page; texts keep their character references."""
    root = Element("#page", "")
    stack, at = [root], 0
    end = len(source)
    while at < end:
        m = _TOKEN.search(source, at)
        if m is None:
            stack[-1].children.append(source[at:])
            break
        if m.start() > at:
            stack[-1].children.append(source[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            else:
                if tag == "p":  # ends nothing, and stands for an empty paragraph
                    stack[-1].children.append(Element("p", ""))
            continue
        if tag in ENDS_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in BLOCK:
                    break
        if tag in ENDS:
            closes, within = ENDS[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in within:
                    break
                if stack[i].tag in closes:
                    del stack[i:]
                    break
        element = Element(tag, m[3])
        stack[-1].children.append(element)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
            element.children.append(source[at:close.start() if close else end])
            at = close.start() if close else end
            stack.append(element)
        elif tag not in VOID and (tag in BLOCK or not m[3].endswith("/")):
            stack.append(element)
    return root


# --- skeletons and their alignment ------------------------------------------------------

#: A skeleton is (label, children): equal siblings folded, in the order of their first.
Skeleton = tuple


def skeleton(element: Element) -> Skeleton:
    """The page's tree without texts, every path of labels once."""
    top: dict = {}
    todo = [(element, top)]
    while todo:
        node, place = todo.pop()
        for child in node.children:
            if not isinstance(child, str):
                todo.append((child, place.setdefault(child.label, {})))
    # Iteratively, as trees may be deeper than Python's stack.
    return _frozen(element.label, top)


def _frozen(label: str, top: dict) -> Skeleton:
    out: dict[int, Skeleton] = {}
    todo = [(label, top, False)]
    while todo:
        name, place, ready = todo.pop()
        if ready:
            out[id(place)] = (name, tuple(out[id(v)] for v in place.values()))
        else:
            todo.append((name, place, True))
            todo += [(k, v, False) for k, v in place.items()]
    return out[id(top)]


def write_skeleton(s: Skeleton) -> str:
    parts, todo = [], [s]
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            parts.append(node)
            continue
        parts.append(_safe(node[0]))
        if node[1]:
            parts.append("(")
            todo.append(")")
            todo += reversed(node[1])
        else:
            parts.append(",")
    return "".join(parts)


def _safe(label: str) -> str:
    return re.sub(r"[(),]", "_", label)


def read_skeleton(text: str) -> Skeleton:
    stack: list[tuple[str, list]] = [("", [])]
    for m in re.finditer(r"([^(),]+)([(,])|\)", text):
        if m[1] is None:
            label, children = stack.pop()
            stack[-1][1].append((label, tuple(children)))
        elif m[2] == "(":
            stack.append((m[1], []))
        else:
            stack[-1][1].append((m[1], ()))
    return stack[0][1][0]


def simple_tree_matching(a: Skeleton, b: Skeleton) -> tuple[int, list[tuple[tuple, tuple]]]:
    """Size of the largest order-preserving alignment of two trees, and its pairs of label paths."""
    return _match(a, b, (a[0],), (b[0],), 0)


def _match(a, b, path_a, path_b, depth):
    if a[0] != b[0]:
        return 0, []
    if depth > DEPTH:
        return 1, [(path_a, path_b)]
    x, y = a[1], b[1]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    pairs: dict[tuple[int, int], tuple[int, list]] = {}
    for i, u in enumerate(x):
        for j, v in enumerate(y):
            if u[0] == v[0]:
                pairs[i, j] = _match(u, v, path_a + (u[0],), path_b + (v[0],), depth + 1)
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + (pairs[i, j][0] if (i, j) in pairs else 0))
    found, i, j = [(path_a, path_b)], len(x), len(y)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            found += pairs[i, j][1]
    return 1 + best[-1][-1], found


@lru_cache(maxsize=512)
def aligned(page: str, wrapper: str) -> dict[tuple, str]:
    """The wrapper's node (its labels joined by ``>``) of each of the page's label paths."""
    _, pairs = simple_tree_matching(read_skeleton(page), read_skeleton(wrapper))
    return {a: ">".join(b) for a, b in pairs}


def node_of(path: tuple, nodes: dict[tuple, str]) -> str:
    """The wrapper's node of a label path, or that of its lowest aligned ancestor and the labels below."""
    if path in nodes:
        return nodes[path]
    n = next((n for n in range(min(len(path), DEPTH + 2), 0, -1) if path[:n] in nodes), 0)
    return ">".join(([nodes[path[:n]]] if n else []) + list(path[n:]))


# --- texts ------------------------------------------------------------------------------


def _chars(element: Element) -> tuple[int, int]:
    """Characters of an element's text that are no white space, and those of them in links."""
    total = linked = 0
    todo: list = [(element, False)]
    while todo:
        node, link = todo.pop()
        if isinstance(node, str):
            n = len("".join(node.split()))
            total, linked = total + n, linked + n * link
        elif not node.no_content:
            todo += [(child, link or node.tag == "a") for child in node.children]
    return total, linked


def containing_forms(root: Element) -> set[int]:
    """The forms (by ``id``) that are containers of a page: they hold a marked article, or more than
    half of the characters of its headings and paragraphs without controls."""
    total, held, marked = 0, {}, set()
    todo: list = [(root, ())]
    while todo:
        node, forms = todo.pop()
        if isinstance(node, str) or (node.no_content and node.tag != "form"):
            continue
        if node.tag == "form":
            forms = (*forms, id(node))
        if node.tag in ("article", "main"):
            marked.update(forms)
        if node.tag == "p" or node.tag in HEADINGS:
            if not _has_control(node):
                n = _chars(node)[0]
                total += n
                for form in forms:
                    held[form] = held.get(form, 0) + n
            continue
        todo += [(child, forms) for child in node.children]
    return marked | {form for form, n in held.items() if 2 * n > total}


def _has_control(element: Element) -> bool:
    todo = list(element.children)
    while todo:
        node = todo.pop()
        if not isinstance(node, str):
            if node.tag in CONTROLS:
                return True
            todo += node.children
    return False


def blocks(root: Element) -> Iterator[tuple[tuple, bool, str, bool]]:
    """(label path of its first text, whether it lies in a part that is no content, text, whether it
    lies in a part of an article that a weak name doubts) of each block in page order: references
    decoded, white space turned into one space, trimmed."""
    parts: list[str] = []
    where: list = [None, False, False]
    forms: set[int] | None = None

    def close():
        text = _WHITE.sub(" ", entities.unescape("".join(parts))).strip()
        parts.clear()
        out = (where[0], where[1], text, where[2])
        where[0] = None
        return out if text else None

    todo: list = [("open", root, (root.label,), False, False, False)]
    while todo:
        step, node, path, hidden, article, doubt = todo.pop()
        if step == "close":
            if done := close():
                yield done
            continue
        if isinstance(node, str):
            if where[0] is not None and (where[1], where[2]) != (hidden, doubt):
                if done := close():
                    yield done
            if where[0] is None and not node.isspace():
                where[:] = path, hidden, doubt
            parts.append(node)
            continue
        if node.tag == "br":
            parts.append(" ")
            continue
        article = article or node.tag in ("article", "main")
        no_content = node.no_content
        if node.tag == "form":
            forms = containing_forms(root) if forms is None else forms
            no_content = id(node) not in forms
        if node.tag == "header":
            no_content = not article
        if node.by_name and not hidden:
            if not article:
                no_content = no_content or node.tag not in HEADINGS
            elif node.tag not in TEXTS:
                if node.by_name == 2:
                    no_content = True
                else:
                    total, linked = _chars(node)
                    no_content = no_content or 2 * linked > total
                    doubt = True
        hidden = hidden or no_content
        if node.tag in BLOCK or node.tag in NO_CONTENT:
            if done := close():
                yield done
            todo.append(("close", None, None, False, False, False))
        for child in reversed(node.children):
            todo.append(("open", child, path if isinstance(child, str) else path + (child.label,), hidden, article, doubt))
    if done := close():
        yield done


def _text_hash(text: str) -> int:
    raw = text.encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "big", signed=True)


# --- on Spark ---------------------------------------------------------------------------


def host_of(url) -> F.Column:
    """The url's host in lower case; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _skeletons(batches) -> Iterator[pa.RecordBatch]:
    """(host, skeleton, n) of each task's pages, added up."""
    count: dict[tuple[str, str], int] = {}
    for batch in sliced(batches):
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            key = (host, write_skeleton(skeleton(parse(source))))
            count[key] = count.get(key, 0) + 1
        if len(count) > 20_000:
            yield _counted(count)
            count.clear()
    yield _counted(count)


def _counted(count) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k in count], pa.string()), pa.array([k[1] for k in count], pa.string()),
                                       pa.array(list(count.values()), pa.int64())], names=["host", "skeleton", "n"])


def _slots(batches) -> Iterator[pa.RecordBatch]:
    """(host, node, text hash, page hash, the node's characters in the page) of each visible block."""
    for batch in sliced(batches):
        rows = []
        for host, source, page, wrapper in zip(*(batch.column(i).to_pylist() for i in range(4))):
            root = parse(source)
            nodes = aligned(write_skeleton(skeleton(root)), wrapper)
            shown = [(node_of(path, nodes) + DOUBT * doubt, text) for path, hidden, text, doubt in blocks(root) if not hidden]
            chars: dict[str, int] = {}
            for node, text in shown:
                chars[node] = chars.get(node, 0) + len(text)
            rows += [(host, node, _text_hash(text), page, chars[node]) for node, text in shown]
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["host", "node", "text", "page", "chars"])


def article_node(low: str, high: str) -> str:
    """The lowest container that covers all nodes between ``low`` and ``high``, the first and the
    last of them in the order of their names with ``>`` at the end; no node inside a marked one."""
    path = []
    for a, b in zip(low.split(">")[:-1], high.split(">")[:-1]):
        if a != b:
            break
        path.append(a)
        if a.partition(".")[0] in ("article", "main"):
            return ">".join(path)
    # A lone paragraph or inline element is no place for an article: its blocks have siblings.
    while len(path) > 1 and path[-1].partition(".")[0] not in ("html", "body", "div", "section", "td", "table", "tr", "tbody", "center", "dl", "ul", "ol",
                                                               "blockquote"):
        path.pop()
    return ">".join(path)


def _is_marked(path: tuple) -> bool:
    return any(x.partition(".")[0] in ("article", "main") for x in path)


def main_text(source: str, wrapper: str | None = None, article: str | None = None, constants: frozenset = frozenset()) -> str:
    """The main text of a page, by its host's wrapper if there is one."""
    root = parse(source)
    shown = [(path, text, doubt) for path, hidden, text, doubt in blocks(root) if not hidden]
    if wrapper is not None:
        nodes = aligned(write_skeleton(skeleton(root)), wrapper)
        kept, inside = [], []
        for path, text, doubt in shown:
            node = node_of(path, nodes)
            if (node + DOUBT * doubt, _text_hash(text)) in constants:
                continue
            kept.append((path, text, doubt))
            if article is None or node == article or node.startswith(article + ">") or _is_marked(path):
                inside.append(text)
        if inside:
            return "\n".join(inside)
        shown = kept
    marked = [text for path, text, _ in shown if _is_marked(path)]
    return "\n".join(marked or [text for _, text, _ in shown])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
                        F.col("url").cast("string").alias("url")).withColumn("host", host_of(F.col("url")))
    skeletons = rows.select("host", "html").mapInArrow(_skeletons, "host string, skeleton string, n long").groupBy("host", "skeleton").agg(F.sum("n").alias("n"))
    wrappers = stored(skeletons.groupBy("host").agg(F.max(F.struct("n", "skeleton")).alias("best")).select("host", F.col("best.skeleton").alias("wrapper")), "html-wrappers")
    size = wrappers.agg(F.coalesce(F.sum(F.octet_length("wrapper") + F.octet_length("host") + 64), F.lit(0))).first()[0]
    hint = F.broadcast if size <= BROADCAST_BYTES else (lambda df: df)

    paged = rows.select("host", "html", F.xxhash64("html").alias("page")).join(hint(wrappers), "host")
    slots = paged.select("host", "html", "page", "wrapper").mapInArrow(_slots, "host string, node string, text long, page long, chars long")
    texts = slots.groupBy("host", "node", "text", "page").agg(F.max("chars").alias("chars")).groupBy("host", "node", "text").agg(
        F.count("*").alias("pages"), F.max("chars").alias("chars"))
    n_pages = rows.select("host", F.xxhash64("html").alias("page")).distinct().groupBy("host").agg(F.count("*").alias("n_pages"))
    constant = (F.col("pages") >= LEAST_PAGES) & (F.col("pages") >= CONSTANT_SHARE * F.col("n_pages")) & (~F.col("node").rlike(_MARKED) | F.col("node").endswith(DOUBT))
    judged = texts.join(hint(n_pages), "host").withColumn("constant", constant)
    by_node = judged.groupBy("host", "node").agg(F.max("chars").alias("chars"), F.min("constant").alias("template"), F.first("n_pages").alias("n_pages"),
                                                 F.collect_list(F.when(F.col("constant"), F.concat_ws(" ", F.col("text").cast("string"), "node"))).alias("texts"))
    side = F.col("node").endswith(DOUBT) | ((F.col("chars") <= SIDE_CHARS) & ~F.col("node").rlike(_TEXT_PART))
    varying = F.when(~F.col("template"), F.concat("node", F.lit(">")))
    article = F.when(~side, varying)
    # The first and the last name have the same ancestors in common as all between; of a host with side parts only, these are the article.
    learned = by_node.groupBy("host").agg(F.coalesce(F.min(article), F.min(varying)).alias("low"), F.coalesce(F.max(article), F.max(varying)).alias("high"),
                                          F.flatten(F.collect_list("texts")).alias("constants"), F.first("n_pages").alias("n_pages"))
    learned = learned.select("host", "constants", *[F.when(F.col("n_pages") >= LEAST_PAGES, F.col(c)).alias(c) for c in ("low", "high")])
    known = stored(wrappers.join(learned, "host", "left"), "html-learned")
    # Measured with all that it carries; constants are as many as the templates' texts.
    carried = F.octet_length("wrapper") + F.octet_length("host") + F.coalesce(F.aggregate("constants", F.lit(0), lambda n, x: n + F.octet_length(x) + 16), F.lit(0))
    size = known.agg(F.coalesce(F.sum(carried + 256), F.lit(0))).first()[0]
    hint_known = F.broadcast if size <= BROADCAST_BYTES else (lambda df: df)

    def run(batches) -> Iterator[pa.RecordBatch]:
        ready: dict[str, tuple[str | None, frozenset]] = {}
        for batch in sliced(batches):
            texts = []
            for source, host, wrapper, low, high, constants in zip(*(batch.column(i).to_pylist() for i in range(1, 7))):
                if host not in ready:
                    if len(ready) > 1000:
                        ready.clear()
                    ready[host] = (article_node(low, high) if low else None,
                                   frozenset((node, int(t)) for t, _, node in (c.partition(" ") for c in constants or [])))
                article, template = ready[host]
                texts.append(main_text(source, wrapper if article else None, article, template))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(7), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return (rows.join(hint_known(known), "host", "left").select("page_id", "html", "host", "wrapper", "low", "high", "constants", "url")
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
