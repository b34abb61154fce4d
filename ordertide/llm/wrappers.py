"""Main text of web pages by wrappers inferred per host.

A page becomes a stream of tokens: opened and closed elements and runs of text. The
pages of a host are aligned one after another, level by level. Where the streams of a
level differ, the mismatch is resolved: an element that only one side has becomes
optional; elements that come again, or in another order, become one repeated group; a
text that differs becomes a slot. The result is a union-free regular expression, the
host's wrapper: every element key stands at one place of its level, whatever the order
in which pages come, so wrappers of parts of a host align to one in the same way and
counts add up.

The wrapper decides once for all pages of its host which slots are the article: not
those in furniture (elements and names that say so), not texts that stay the same on
pages that differ. If the host marks its article, slots outside the mark go; if not, the
element whose direct blocks hold most varying text that isn't links is taken for it.
Applied to a page, the wrapper gives its slots' texts in page order.
"""

from __future__ import annotations

import hashlib
import html as references
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.arrow import record_batch
from ordertide.llm.stored import stored

#: Tags: comments, declarations, and elements with quoted attributes. A "<" that starts
#: none of these is text.
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
#: Elements left out whole: to the end of the page where they don't end, and those that then only lose their tag.
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
_SKIPPED = _RAW | {"noscript", "template", "svg", "math", "canvas", "object", "video", "audio"}
#: Elements nested deeper become siblings, as in browsers.
DEPTH = 200
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img nobr".split())
#: An opened element ends these if open nearest.
_BLOCKS = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
         "thead": {"tbody", "thead", "tr", "td", "th"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "option": {"option"}, "body": {"head"}}
_WITHIN = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "thead": {"table"}, "tbody": {"table"}}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Furniture: by element, by role, and by words of class and id names.
_FURNITURE = set("nav footer aside form button select dialog menu head title input label fieldset".split())
_FURNITURE_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar tablist".split())
_FURNITURE_WORDS = set("""ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion promoted banner banners
    nav navbar navigation menu menus breadcrumb breadcrumbs crumbs pager pagination toolbar topbar
    masthead footer sidebar side aside rail
    cookie cookies consent gdpr notice notices alert alerts popup modal overlay toast paywall
    comment comments commentlist discussion disqus replies reply respond
    share sharing social follow related recommended recommendations recirc teaser teasers trending popular
    newsletter subscribe subscription signup login signin search copyright legal disclaimer skip hidden""".split())
#: Words that mark the article, most telling first.
_MARKS = ({"article", "post", "entry", "story"}, {"main", "content"})
#: Elements that an article's text stands in, when nameless.
_PLAIN = set("p li blockquote pre td th dd dt figcaption article main".split())


class Element:
    __slots__ = ("children", "key", "tag", "words")

    def __init__(self, tag: str, words: tuple[str, ...] = ()):
        self.tag, self.words, self.key = tag, words, ""
        self.children: list[Element | tuple[str, int]] = []  # elements, and texts with the length of their links


def _names(attributes: str) -> tuple[str, ...]:
    """Words of class, id, role and itemprop; of a name's parts those without digits."""
    found: list[str] = []
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id"):
            found += [part.lower() for part in re.split(r"[\s_.:-]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", a or b or c)) if part.isalpha()]
        elif name == "itemprop":
            found += [part.lower() for part in (a or b or c).split() if part.isalpha()]
        elif name == "role":
            found.append("role=" + (a or b or c).lower())
        elif name == "hidden" or (name == "aria-hidden" and "true" in (a or b or c)) or (name == "style" and "display:none" in (a or b or c).replace(" ", "")):
            found.append("hidden")
    return tuple(sorted(set(found)))


def parse(page: str) -> Element:
    """The page's block elements as a tree. Inline elements only add to the text around
    them, unless named as furniture. End tags may be missing."""
    root = Element("")
    stack = [root]
    text: list[str] = []
    links = in_link = 0
    at, last = 0, page.rfind(">") + 1

    def flush():
        nonlocal links
        if text:
            shown = " ".join(references.unescape("".join(text)).split())
            if shown:
                stack[-1].children.append((shown, links))
            text.clear()
        links = 0

    def say(piece: str):
        nonlocal links
        text.append(piece)
        if in_link:
            links += len(piece.strip())

    while True:
        m = _TAG.search(page, at, last)
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                say(references.escape(m[0][9:-3]))
            continue
        if m[1] or m[4]:  # an end tag
            if tag == "a":
                in_link = 0
            if tag == "p" or len(stack) > DEPTH:
                flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    flush()
                    del stack[i:]
                    break
            continue
        attributes = m[3] or m[6] or ""
        if tag in _SKIPPED:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            if end and (tag in _RAW or not attributes.endswith("/")):
                at = end.end()
            elif tag in _RAW:
                at = len(page)
            continue
        if tag in _INLINE:
            words = _names(attributes) if attributes else ()
            if tag == "a":
                in_link = 1
            if tag == "label" or _is_furniture(tag, words):
                flush()
                stack.append(Element(tag, words))
            continue
        flush()
        if tag in _VOID or len(stack) > DEPTH:
            continue
        if tag in _BLOCKS:
            for i in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in _BLOCKS or stack[i].tag in ("td", "th", "li", "dd"):
                    break
        ends, bound = _ENDS.get(tag, ()), _WITHIN.get(tag, ())
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in bound:
                break
            if stack[i].tag in ends:
                del stack[i:]
                break
        words = _names(attributes) if attributes else ()
        new = Element(tag, words)
        stack[-1].children.append(new)
        stack.append(new)
    flush()
    _name_keys(root)
    return root


def _name_keys(root: Element) -> None:
    """Keys of elements: the tag with its names; a nameless container also says what it holds."""
    todo, order = [root], []
    while todo:
        e = todo.pop()
        order.append(e)
        todo += [c for c in e.children if isinstance(c, Element)]
    for e in order:
        e.key = ".".join((e.tag, *e.words))
        if not e.words and e.tag in ("div", "section", "table", "td", "center", "span"):
            e.key += "(" + " ".join(sorted({c.tag if isinstance(c, Element) else "#" for c in e.children})) + ")"


def _is_furniture(tag: str, words: tuple[str, ...]) -> bool:
    return tag in _FURNITURE or any(w in _FURNITURE_WORDS or w.startswith("role=") and w[5:] in _FURNITURE_ROLES for w in words)


# A wrapper's node: {"n": pages, "parts": [[repeated, [key, ...]], ...], "of": {key: node}},
# and where texts stand directly in it {"chars", "links", "text", "first", "last"}: sums of
# characters and of those in links, the texts' digest (None: a slot), least and greatest
# digest of the pages that have it.

def _level(children: list) -> list:
    """A level of one page as parts: keys that come again make a repeated group of all from
    their first to their last."""
    parts: list = []
    for c in children:
        _put(parts, [False, [c.key if isinstance(c, Element) else "#"]], 0, True)
    return parts


def _put(parts: list, part: list, at: int, again: bool) -> int:
    """Aligns one part with a level from its part ``at`` on; where the next one goes."""
    same = [i for i, p in enumerate(parts) if not set(p[1]).isdisjoint(part[1])]
    if not same:
        at = len(parts) if again else at
        parts.insert(at, [part[0], list(part[1])])
        return at + 1
    lo, hi = min(same), max(same)
    if again:
        hi = len(parts) - 1  # it repeats: all since then is one group
    elif lo < at - 1:
        hi = max(hi, at - 1)  # another order than before
    if lo < hi or again or part[0]:
        keys = dict.fromkeys(k for p in parts[lo:hi + 1] for k in p[1]) | dict.fromkeys(part[1])
        parts[lo:hi + 1] = [[True, list(keys)]]
    return lo + 1


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def page_wrapper(page: str) -> dict:
    """The wrapper of one page."""
    root = parse(page)
    whole = _digest("\n".join(t for _, t, _ in slots(root)))

    def node(elements: list[Element]) -> dict:
        made: dict = {"n": 1, "parts": [], "of": {}}
        inner: dict[str, list[Element]] = {}
        texts = []
        for e in elements:
            at = 0
            for p in _level(e.children):
                at = _put(made["parts"], p, at, False)
            for c in e.children:
                if isinstance(c, Element):
                    inner.setdefault(c.key, []).append(c)
                else:
                    texts.append(c)
        if texts:
            made |= {"chars": sum(len(t) for t, _ in texts), "links": sum(n for _, n in texts),
                     "text": _digest("\n".join(t for t, _ in texts)), "first": whole, "last": whole}
        made["of"] = {k: node(v) for k, v in inner.items()}
        return made
    return node([root])


def align(a: dict, b: dict) -> dict:
    """The wrapper of all pages of both. Neither the order nor the grouping of pages
    changes its slots, counts and sums."""
    made: dict = {"n": a["n"] + b["n"], "parts": [[r, list(k)] for r, k in a["parts"]], "of": {}}
    at = 0
    for part in b["parts"]:
        at = _put(made["parts"], part, at, False)
    if "chars" in a and "chars" in b:
        made |= {"chars": a["chars"] + b["chars"], "links": a["links"] + b["links"], "text": a["text"] if a["text"] == b["text"] else None,
                 "first": min(a["first"], b["first"]), "last": max(a["last"], b["last"])}
    else:
        made |= {k: v for x in (a, b) if "chars" in x for k, v in x.items() if k in ("chars", "links", "text", "first", "last")}
    for k in a["of"].keys() | b["of"].keys():
        made["of"][k] = align(a["of"][k], b["of"][k]) if k in a["of"] and k in b["of"] else a["of"].get(k) or b["of"][k]
    return made


def slots(root: Element) -> list[tuple[tuple[str, ...], str, int]]:
    """(path of keys, text, length of links) of each text of a page, in page order."""
    out = []

    def walk(e: Element, path: tuple[str, ...]):
        todo = [(e, path, iter(e.children))]
        while todo:
            e, path, left = todo[-1]
            for c in left:
                if isinstance(c, Element):
                    todo.append((c, (*path, c.key), iter(c.children)))
                    break
                out.append((path, c[0], c[1]))
            else:
                todo.pop()
    walk(root, ())
    return out


def expression(wrapper: dict) -> str:
    """The wrapper as a union-free regular expression: ``<key>...</>`` for elements, ``#``
    for a slot, ``"..."`` for a text that stays the same, ``?`` and ``+`` for optional and
    repeated ones."""
    def level(node: dict) -> str:
        out = []
        for repeated, keys in node["parts"]:
            one = []
            for k in keys:
                if k == "#":
                    one.append("#" if node["text"] is None else f'"{node["text"]}"')
                else:
                    one.append(f"<{k}>{level(node['of'][k])}</>")
                if len(keys) > 1 or k != "#" and node["of"][k]["n"] < node["n"]:
                    one[-1] = f"({one[-1]})?"
            out.append(f"({' '.join(one)})+" if repeated else " ".join(one))
        return " ".join(out)
    return level(wrapper)


def _parts_of(key: str) -> tuple[str, tuple[str, ...]]:
    tag, *words = key.split("(")[0].split(".")
    return tag, tuple(words)


def _banned(path: tuple[str, ...]) -> bool:
    """Within furniture. Of a header within an article the headings stay; names of the
    whole page (html, body) say nothing."""
    article = False
    for i, key in enumerate(path):
        tag, words = _parts_of(key)
        if tag in ("html", "body"):
            continue
        if _is_furniture(tag, words):
            return True
        if (tag == "header" or "header" in words) and tag not in _HEADINGS and not (article and any(_parts_of(k)[0] in _HEADINGS for k in path[i + 1:])):
            return True
        article = article or _mark(key) < UNMARKED
    return False


#: Of an element that doesn't mark the article.
UNMARKED = 9


def _mark(key: str) -> int:
    """How plainly an element's key marks the article: the lower, the plainer."""
    tag, words = _parts_of(key)
    if tag == "article" or "articlebody" in words:
        return 0
    if tag in ("div", "section", "main", "td"):
        for i, marks in enumerate(_MARKS, 1):
            if not marks.isdisjoint(words):
                return i
    return 3 if tag == "main" or "role=main" in words else UNMARKED


def article_slots(wrapper: dict) -> tuple[set[tuple[str, ...]], set[tuple[str, ...]]]:
    """Paths of the wrapper whose texts belong to the article: by the host's marks, and
    without them, for those of its pages that don't have the mark."""
    found: list[tuple[tuple[str, ...], dict]] = []
    todo: list[tuple[tuple[str, ...], dict]] = [((), wrapper)]
    while todo:
        path, node = todo.pop()
        if "chars" in node and not _banned(path):
            found.append((path, node))
        todo += [((*path, k), v) for k, v in node["of"].items()]

    def fixed(node: dict) -> bool:
        """The same on at least three pages that differ, and on half of all."""
        return node["text"] is not None and node["first"] != node["last"] and node["n"] >= 3 and 2 * node["n"] >= wrapper["n"]

    def shown(node: dict) -> int:
        return max(node["chars"] - 2 * node["links"], 0)

    def plain(key: str) -> bool:
        tag, words = _parts_of(key)
        return not words and (tag in _HEADINGS or tag in _PLAIN)
    varying = [(p, node) for p, node in found if not fixed(node)]
    total = sum(shown(node) for _, node in varying)
    marked: set[tuple[str, ...]] = set()
    for mark in range(UNMARKED):
        inside = [(p, node) for p, node in found if any(_mark(k) == mark for k in p)]
        # a mark of little text is that of something else, like an article's date line
        if inside and 10 * sum(shown(node) for _, node in inside) >= 3 * total:
            marked = {p for p, node in inside if not fixed(node) or plain(p[-1])}
            break
    mass: dict[tuple[str, ...], int] = {}
    for p, node in varying:
        for up in (1, 2):  # blocks of text count for what they stand in, and half for what that stands in
            if len(p) >= up:
                mass[p[:-up]] = mass.get(p[:-up], 0) + shown(node) * (3 - up)
    top = max(mass, key=lambda p: (mass[p], len(p), p), default=())
    unmarked = {p for p, node in varying if 2 * node["links"] <= node["chars"]
                and (p[:len(top)] == top or (_parts_of(p[-1])[0] == "h1" and p[:-1] == top[:len(p) - 1]))}
    return marked, unmarked


def _host(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _batch_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's wrapper of each of its hosts. When they grow large, they leave early."""
    schema = pa.schema([("host", pa.string()), ("wrapper", pa.string())])
    held: dict[str, dict] = {}
    seen = 0
    for batch in batches:
        for host, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            now = page_wrapper(page or "")
            held[host] = align(held[host], now) if host in held else now
            seen += 1
        if len(held) > HELD_HOSTS:
            yield record_batch([list(held), [json.dumps(w) for w in held.values()]], schema)
            held = {}
    if held:
        yield record_batch([list(held), [json.dumps(w) for w in held.values()]], schema)


#: Hosts whose wrappers a task holds at once.
HELD_HOSTS = 2_000


def _aligned_wrappers(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made = None
    for batch in batches:
        for w in batch.column(batch.schema.get_field_index("wrapper")).to_pylist():
            now = json.loads(w)
            made = align(made, now) if made else now
    yield pa.record_batch({"host": pa.array([key[0].as_py()], pa.string()), "wrapper": pa.array([json.dumps(made)], pa.string())})


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) of each host of ``pages`` (url, html; other columns are ignored), as
    JSON for ``align``, ``expression`` and ``article_slots``.

    Tasks align the pages they read; their wrappers of one host meet in two steps, so that
    no task gets more than a sixteenth of them before the last. A null url has host ''."""
    parts = pages.select(_host(F.col("url")).alias("host"), "html").mapInArrow(_batch_wrappers, "host string, wrapper string")
    some = parts.groupBy("host", (F.xxhash64("wrapper") % 16).alias("some")).applyInArrow(_aligned_wrappers, "host string, wrapper string")
    return some.groupBy("host").applyInArrow(_aligned_wrappers, "host string, wrapper string")


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("host", pa.string()), ("wrapper", pa.string()), ("slots", pa.string())])
    for batch in batches:
        hosts, found = (c.to_pylist() for c in batch.columns)
        yield record_batch([hosts, found, [json.dumps([sorted(s) for s in article_slots(json.loads(w))]) for w in found]], schema)


RESULT = "page_id long, url string, text string, n_chars long"


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
    known: dict[str, list[set]] = {}
    for batch in batches:
        out = []
        for page_id, url, page, decided in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if decided not in known:
                if len(known) >= HELD_HOSTS:
                    known.clear()
                known[decided] = [set(map(tuple, s)) for s in json.loads(decided)]
            texts = slots(parse(page or ""))
            text = next(filter(None, (" ".join(t for path, t, _ in texts if path in s) for s in known[decided])), "")
            out.append((page_id, url, text, len(text)))
        if out:
            yield record_batch(list(zip(*out, strict=True)), schema)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html; other columns are ignored): page_id, url,
    the main text and its length in code points.

    Null or empty html: ''. A null url is a host of its own, ''. Null page_ids stay null;
    repeated rows give repeated rows; a page alone on its host is its own wrapper; pages
    of any length are read whole; empty table: no rows. Wrappers are joined by host as a
    stored table, so that Spark broadcasts it only if its files are small."""
    pages = pages.select(F.col("page_id").cast("long"), "url", "html")
    wrappers = stored(infer_wrappers(pages).mapInArrow(_decided, "host string, wrapper string, slots string"), "wrappers").select("host", "slots")
    return pages.withColumn("host", _host(F.col("url"))).join(wrappers, "host").select("page_id", "url", "html", "slots").mapInArrow(_extracted, RESULT)


def op11_wrappers(spark, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
