"""HTML main text by equivalence-class template deduction.

The tokens of a page are its block tags, each named by the path of open elements with
their classes and ids, and the words of its text, each named by the path it stands at. Over the pages of one host, tags with equal
occurrence vectors form a class. A class is valid if it has at least ``LEAST_TOKENS``
tags, is found in half of the pages, and its tags alternate in one order in every page.
The class that every page has once is the template's root; valid classes that stay within
one gap of a larger class nest there. The gaps (slots) between the root's tags hold what
the template leaves open. Slots are weighed over all pages by their words outside links,
nested link lists and boilerplate elements; the enclosing element of the heaviest slot
(the closest with most of the weight, no paragraph or heading) holds the main text.

Words that every page has equally often at a path are template. A block is template if every
page repeats it at its path, or if its words are for the most part template words (three or
more) that every page has there in the same order: a notice with a number or a name in it.
The words between them are a slot of the notice, not text of the article. Titles (h1) are
never template, and a page whose article would mostly go is a copy of its neighbours: its
article stays. Deduction needs ``LEAST_PAGES`` pages; smaller groups drop no text for it.

A page with text in article or main elements gives all of it but boilerplate. Of several
article elements, those at the place whose single elements are the longest over the pages
hold the main text; article elements elsewhere or nested in it go if some page repeats them
there (teasers, readers' posts). Other pages give the blocks of the main text's element and,
links apart, all blocks around it that are no template.

The words of a class, id or role mark boilerplate by themselves only if nothing else is in
the name (comments, sidebar-left). Other names that begin or end with such a word
(social-history) are confirmed by the pages: what they hold there has to be links or template
for the most part.

A host's pages are dealt into groups of about ``GROUP`` by a hash, so that a host of any
size is many tasks; a group deduces its own template. A page alone is a group of one.

Defined cases: a null or empty page, or one without text, gives the empty string; a null
url is the host ''; repeated rows each give a row; unclosed or unmatched tags end with
their parent or are ignored, cut-off markup at the end is dropped; past ``DEEPEST`` open
elements paths grow no longer and no marks are added, and the text stays; an empty table
gives an empty result; columns other than ``page_id``, ``url`` and ``html`` are ignored.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.operators.joins import bounded_broadcast

GROUP = 64
LEAST_TOKENS = 3
#: Pages of a group from which on repeated text blocks count as template.
LEAST_PAGES = 4
#: How much more a slot inside an article or main element weighs.
ARTICLE_WEIGHT = 10
#: Elements open at once from which on paths grow no longer.
DEEPEST = 256
#: Share of the weight that the main text's element must hold.
MAIN_SHARE = 0.8

#: Elements by kind, and the words of class, id and role that mark boilerplate.
RAW = ("script", "style", "noscript", "template", "iframe", "textarea", "svg", "title",
       "select", "object", "canvas", "audio", "video")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn",
          "em", "font", "i", "ins", "kbd", "label", "mark", "q", "ruby", "rp", "rt", "s", "samp",
          "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "math"}
#: Elements of formulas; their texts are words of their own.
MATH = {"annotation", "annotation-xml", "maction", "menclose", "merror", "mfenced", "mfrac", "mi", "mlabeledtr",
        "mmultiscripts", "mn", "mo", "mover", "mpadded", "mphantom", "mprescripts", "mroot", "mrow", "ms",
        "mspace", "msqrt", "mstyle", "msub", "msubsup", "msup", "mtable", "mtd", "mtext", "mtr", "munder",
        "munderover", "none", "semantics"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
TEXT_TAGS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "pre",
             "blockquote", "figure", "figcaption", "header", "hgroup"}
NOISE_TAGS = {"nav", "footer", "aside", "form", "button", "dialog", "menu", "head", "fieldset"}
ARTICLE_TAGS = {"article", "main"}
#: Elements that the words never mark.
NEVER_NOISE = {"html", "body"} | ARTICLE_TAGS
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense alert banner breadcrumb breadcrumbs "
    "comment comments commentlist consent contentinfo complementary cookie cookies copyright "
    "dialog discussion disqus feedback footer form header login masthead menu modal nav navbar "
    "navigation newsletter notice notices outbrain pager pagination popup promo promotion "
    "recommended related replies reply respond search share sharing sidebar sidebars signup skip "
    "social sponsor sponsored subscribe taboola toolbar widget widgets".split())

#: Words after which a name's main word is looked for before them; words that make a name tell
#: of a state of its element; boilerplate that may be longer than the main text.
PLACE_WORDS = frozenset("area bar block bottom box container content inner left main outer "
                        "panel right section top wrap wrapper".split())
STATE_WORDS = frozenset("active allowed closed disabled enabled free has hidden hide is no off on "
                        "open show with without".split())
#: Words that say nothing beside one that marks boilerplate.
GENERIC_WORDS = frozenset("a ad all body element footer global group header holder in item items "
                          "link links list lists menu of on page post site the this to unit us".split())
READER_WORDS = frozenset("comment comments commentlist discussion disqus replies reply respond".split())

_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<svg(?=[\s/])[^>]*+(?<=/)>|<(?P<raw>{'|'.join(RAW)})(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)"""
    r"""|<[!?][^>]*+(?:>|\Z)|</(?P<end>[a-z][^\s/>]*)[^>]*+(?:>|\Z)"""
    r"""|<(?P<open>[a-z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"""|<[a-z/][^>]*+(?:>|\Z)""", re.S | re.I)
_ATTR = re.compile(r"""([a-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Block(NamedTuple):
    at: int
    text: str
    path: str
    noise: bool
    article: bool
    linked: int
    marks: tuple[int, ...] = ()  # elements around it that the words mark, by number
    element: tuple[str, int, bool] | None = None  # its article: place, number, in another


class Page(NamedTuple):
    tags: list[str]  # tokens in order; a token's place is its index
    blocks: list[Block]
    marks: list[tuple[set[str], str, bool]]  # words, path, whether the name has others


class _Open(NamedTuple):
    name: str
    path: str
    noise: bool
    article: bool
    marks: tuple[int, ...] = ()
    element: tuple[str, int, bool] | None = None


def _marking(value: str) -> tuple[set[str], set[str]]:
    """Words of a class, id or role that mark boilerplate: the first and the last of each
    name, without places at its end; a name that tells of a state has none. Those of names
    with other words in them come apart."""
    sure: set[str] = set()
    doubtful: set[str] = set()
    for name in value.split():
        words = [w.lower() for w in _WORD.findall(name)]
        if STATE_WORDS.isdisjoint(words):
            found = NOISE_WORDS.intersection(words[:1])
            while words and words[-1] in PLACE_WORDS:
                words.pop()
            found |= NOISE_WORDS.intersection(words[-1:])
            other = set(words) - NOISE_WORDS - PLACE_WORDS - GENERIC_WORDS
            (doubtful if other else sure).update(found)
    return sure, doubtful - sure


def _described(name: str, attrs: str) -> tuple[str, bool, set[str], set[str]]:
    """(label of an element, whether its attributes hide it, their words for boilerplate,
    such words of names with others in them)."""
    label, noise, words, doubtful = name, False, set(), set()
    for m in _ATTR.finditer(attrs) if attrs.strip() else ():
        key, value = (m[1] or m[5]).lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id", "role"):
            label += "." + re.sub(r"[\d\s/]+", "-", value)
            if name not in NEVER_NOISE:
                sure, unsure = _marking(value)
                words |= sure
                doubtful |= unsure
        elif key == "hidden" or key == "aria-hidden" and value == "true" or (
                key == "style" and re.search(r"display\s*:\s*none", value)):
            noise = True
    return label, noise, words, doubtful


def _judged(blocks: list[Block], marks: list[tuple[set[str], str, bool]], confirmed=frozenset()) -> list[Block]:
    """The blocks, with those as noise that a marked element holds. An element with most of
    the words that are left is none, unless it holds what readers wrote beside other text;
    one whose name has other words is none unless the pages ``confirmed`` its path."""
    words = [0 if b.noise else len(b.text.split()) for b in blocks]
    total, held = sum(words), Counter()
    for b, n in zip(blocks, words):
        for m in b.marks:
            held[m] += n
    real = {m for m, n in held.items() if (not marks[m][2] or marks[m][1] in confirmed)
            and (2 * n <= total or n < total and marks[m][0] <= READER_WORDS)}
    return [b._replace(noise=b.noise or not real.isdisjoint(b.marks)) if b.marks else b for b in blocks]


def parse(html: str) -> Page:
    """Tag tokens and text blocks of a page."""
    tags: list[str] = []
    blocks: list[Block] = []
    marks: list[tuple[set[str], str, bool]] = []
    articles = 0
    stack = [_Open("", "", False, False)]
    parts: list[str] = []
    linked = last = 0
    in_link = False

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                top = stack[-1]
                blocks.append(Block(len(tags), text, top.path, top.noise, top.article, linked, top.marks,
                                    top.element))
            parts.clear()
        linked = 0

    def close(to: int):
        while len(stack) > to:
            tags.append("/" + stack.pop().path)

    def add(text: str):
        nonlocal linked
        parts.append(text)
        if in_link:
            linked += len(text.split())

    for m in _TOKEN.finditer(html):
        if m.start() > last:
            add(html[last:m.start()])
        last = m.end()
        if m["end"]:
            name = m["end"].lower()
            if name == "a":
                in_link = False
            if name in INLINE or name in MATH:
                continue
            flush()
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].name == name), 0)
            if k:
                close(k)
        elif m["open"]:
            name, attrs = m["open"].lower(), m["attrs"]
            if name == "a":
                in_link = True
            if name in MATH and parts:
                parts.append(" ")
            if name in INLINE or name in MATH:
                continue
            flush()
            if name in VOID or attrs.endswith("/"):
                continue
            in_link = in_link and name not in CLOSES
            shut = CLOSES.get(name, set()) | {"p"}
            while stack[-1].name in shut:
                close(len(stack) - 1)
            top = stack[-1]
            label, noise, words, doubtful = _described(name, attrs)
            noise |= name in NOISE_TAGS or name == "header" and not top.article
            path = f"{top.path}/{label}" if len(stack) < DEEPEST else top.path
            around = top.marks
            # past DEEPEST, elements add no marks either, as these are kept per block
            for found in (words, doubtful):
                if found and len(around) < DEEPEST:
                    around += (len(marks),)
                    marks.append((found, path, found is doubtful))
            element = top.element
            if name == "article":
                articles += 1
                element = f"{top.path}/article", articles, element is not None
            stack.append(_Open(name, path, top.noise or noise, top.article or name in ARTICLE_TAGS, around,
                               element))
            tags.append(path)
        elif m["raw"] is None and not m[0].startswith(("<!", "<?", "</")) and m.end() == len(html):
            break  # markup cut off by the end of the page
    if last < len(html):
        add(html[last:])
    flush()
    return Page(tags, blocks, marks)


def _ordered(tokens: list[str], places: list[dict[str, list[int]]]) -> list[str]:
    """The tokens in their order, without those that break it in some page: each turn of
    a class has every token once, and the next turn begins after it."""
    first = next(p for p in places if tokens[0] in p)
    tokens = sorted(tokens, key=lambda t: first[t][0])
    kept: list[str] = []
    for t in tokens:
        good = all(
            t not in p or not kept or (
                all(a < b for a, b in zip(p[kept[-1]], p[t]))
                and all(b < a for b, a in zip(p[t], p[kept[0]][1:])))
            for p in places)
        if good:
            kept.append(t)
    return kept


def classes(pages: list[Page]) -> tuple[list[str], dict[int, list[list[str]]]]:
    """(root class in order, classes nested in each of its slots). Slot k lies before the
    root's k-th tag."""
    counts = [Counter(p.tags) for p in pages]
    vectors: dict[tuple, list[str]] = defaultdict(list)
    for token in dict.fromkeys(t for p in pages for t in p.tags):
        vectors[tuple(c[token] for c in counts)].append(token)
    places: list[dict[str, list[int]]] = []
    for p in pages:
        where = defaultdict(list)
        for k, t in enumerate(p.tags):
            where[t].append(k)
        places.append(dict(where))
    once = tuple([1] * len(pages))
    root = _ordered(vectors.pop(once), places) if once in vectors else []
    nested: dict[int, list[list[str]]] = defaultdict(list)
    bounds = [[p[t][0] for t in root] for p in places]
    for vector, tokens in vectors.items():
        if len(tokens) < LEAST_TOKENS or 2 * sum(map(bool, vector)) < len(pages):
            continue
        tokens = _ordered(tokens, places)
        if len(tokens) < LEAST_TOKENS:
            continue
        slots = {bisect_right(b, k) for b, p in zip(bounds, places) for t in tokens for k in p.get(t, ())}
        if len(slots) == 1:  # within one gap everywhere
            nested[slots.pop()].append(tokens)
    return root, nested


def _template(pages: list[Page]) -> list[list[bool]]:
    """For each block of each page whether it is template: every page repeats it at its path,
    or most of its words are words that every page has equally often at this path, and every
    page has these words in this order in a block there."""
    if len(pages) < LEAST_PAGES:
        return [[False] * len(p.blocks) for p in pages]
    words = [[b.text.split() for b in p.blocks] for p in pages]
    texts = [{(b.path, b.text) for b in p.blocks} for p in pages]
    counts = [Counter((b.path, w) for b, ws in zip(p.blocks, wss) for w in ws) for p, wss in zip(pages, words)]
    alike = set.intersection(*texts)
    fixed = {token for token, n in min(counts, key=len).items() if all(c[token] == n for c in counts)}

    def frame(block: Block, ws: list[str]) -> tuple:
        own = tuple(w for w in ws if (block.path, w) in fixed)
        return (block.path, own) if len(own) >= LEAST_TOKENS and 2 * len(own) >= len(ws) else ()

    frames = [[frame(b, ws) for b, ws in zip(p.blocks, wss)] for p, wss in zip(pages, words)]
    everywhere = set.intersection(*map(set, frames)) - {()}
    return [[_names(b.path)[-1:] != ["h1"] and ((b.path, b.text) in alike or f in everywhere)
             for b, f in zip(p.blocks, fs)] for p, fs in zip(pages, frames)]


def _confirmed(pages: list[Page], template: list[list[bool]]) -> set[str]:
    """Paths of marked elements with other words in their names that hold links or template
    for the most part, over all pages that have them."""
    words, proved = Counter(), Counter()
    for page, fixed in zip(pages, template):
        for b, t in zip(page.blocks, fixed):
            n = len(b.text.split())
            for m in b.marks:
                _, path, doubtful = page.marks[m]
                if doubtful:
                    words[path] += n
                    proved[path] += n if t else b.linked
    return {path for path, n in words.items() if 2 * proved[path] >= n}


def _own_articles(pages: list[list[Block]]) -> list[list[Block]]:
    """The blocks in article and main elements without article elements that stand elsewhere
    than the main text's, or within it, and that some page repeats there."""
    longest: Counter = Counter()
    repeated = set()
    sizes = []
    for blocks in pages:
        size = Counter()
        for b in blocks:
            if b.element:
                size[b.element] += max(0, len(b.text.split()) - 2 * b.linked)
        most, times = Counter(), Counter(place for place, _, _ in size)
        for (place, _, inside), n in size.items():
            if not inside:
                most[place] = max(most[place], n)
        longest.update(most)
        repeated |= {place for place, n in times.items() if n > 1}
        sizes.append(most)
    out = []
    for blocks, most in zip(pages, sizes):
        place = max(most, key=lambda x: (longest[x], most[x]), default=None)
        out.append([b for b in blocks if b.article and not (
            b.element and most[place] and b.element[0] in repeated
            and (b.element[2] or b.element[0] != place))])
    return out


def _main_path(pages: list[Page], root: list[str], nested, stale) -> str:
    """Path of the element that encloses the heaviest slot."""
    weight: Counter = Counter()
    under: Counter = Counter()
    inside = {k: {t for c in cs for t in c} for k, cs in nested.items()}
    for page, fixed in zip(pages, stale):
        where = {t: k for k, t in enumerate(page.tags)}
        bounds = [where[t] for t in root]
        words, links = Counter(), Counter()
        for b, gone in zip(page.blocks, fixed):
            if b.noise or gone:
                continue
            slot = bisect_right(bounds, b.at - 1)
            n, more = len(b.text.split()), ARTICLE_WEIGHT if b.article else 1
            if b.path in inside.get(slot, ()) and 2 * b.linked > n:
                continue  # an entry of a repeated list of links
            words[slot] += n * more
            links[slot] += b.linked * more
            under[b.path] += max(0, n - 2 * b.linked) * more
        for slot, n in words.items():
            weight[slot] += max(0, n - 2 * links[slot])
    if not weight:
        return ""
    best = max(weight, key=lambda s: (weight[s], -s))
    open_now: list[str] = []
    for t in root[:best]:
        if t.startswith("//"):
            if t[1:] in open_now:
                del open_now[open_now.index(t[1:]):]
        else:
            open_now.append(t)
    total = sum(under.values())
    for path in reversed(open_now):
        held = sum(n for p, n in under.items() if p == path or p.startswith(path + "/"))
        if path.rpartition("/")[2].partition(".")[0] not in TEXT_TAGS and held >= MAIN_SHARE * total:
            return path
    return ""


def _names(path: str) -> list[str]:
    return [x.partition(".")[0] for x in path.split("/")[1:]]


def _within(path: str, element: str) -> bool:
    return not element or path == element or path.startswith(element + "/")


def _around(good: list[Block], main: str) -> list[Block]:
    """The blocks of the main text's element and, links apart, those around it."""
    core = [_within(b.path, main) for b in good]
    if not any(core):
        return good
    return [b for b, c in zip(good, core)
            if c or 2 * b.linked <= len(b.text.split()) or _names(b.path)[-1:] == ["h1"]]


def _words(blocks: list[Block]) -> int:
    return sum(len(b.text.split()) for b in blocks)


def extract(htmls: list[str | None]) -> list[str]:
    """Main texts of pages of one host."""
    pages = [parse(h or "") for h in htmls]
    template = _template(pages)
    confirmed = _confirmed(pages, template)
    pages = [p._replace(blocks=_judged(p.blocks, p.marks, confirmed)) for p in pages]
    root, nested = classes(pages)
    stale = [[t and not b.article for b, t in zip(p.blocks, fixed)] for p, fixed in zip(pages, template)]
    main = _main_path(pages, root, nested, stale)
    said = [[b for b in p.blocks if not b.noise] for p in pages]
    left = [[b for b, t in zip(p.blocks, fixed) if not b.noise and not t] for p, fixed in zip(pages, template)]
    own_said, own_left = _own_articles(said), _own_articles(left)
    out = []
    for whole, rest, article, article_left in zip(said, left, own_said, own_left):
        # a page of which most would go is a copy of its neighbours
        own = article_left if 2 * _words(article_left) >= _words(article) else article
        own = own or _around(rest, main) or _around(whole, main)
        out.append(" ".join(b.text for b in own))
    return out


def _extracted(key, table):
    texts = extract(table.column("html").to_pylist())
    return pa.table([table.column("page_id"), table.column("url"), pa.array(texts, pa.string()),
                     pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame, group: int = GROUP) -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row of ``pages(page_id, url, html)``."""
    kind = pages.schema["page_id"].dataType.simpleString()
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    rows = pages.select("page_id", "url", "html", host.alias("host"))
    large = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group).select(
        "host", F.ceil(F.col("n") / group).alias("groups"))
    dealt = rows.join(bounded_broadcast(large), "host", "left").withColumn(
        "part", F.pmod(F.xxhash64("page_id", "url"), F.coalesce("groups", F.lit(1))).cast("int"))
    return dealt.select("host", "part", "page_id", "url", "html").groupBy("host", "part").applyInArrow(
        _extracted, f"page_id {kind}, url string, text string, n_chars bigint")
