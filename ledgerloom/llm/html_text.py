"""Main text of web pages by wrapper induction.

Pages of a host with the same containers are a layout. Over all pages it is counted on how many each
text stands at each path (copies of a page count once); what stands on nearly all pages of a layout
or of a host (`TEMPLATE_SHARE`, at least `LEAST_PAGES`) is template, all other text is a slot. To align
structures, a few pages of each layout (`SAMPLE`, chosen by hash) are parsed and their trees of block
elements matched one after another by simple tree matching; runs of like siblings count as one node.
The merged tree is the layout's wrapper. The wrapper's content region is its main element, or the articles in it
if all varying text in it is theirs; without main its articles and all slots beside them; without
either the smallest node that holds all varying text. A page is aligned with the wrapper of its layout,
the region's counterpart and parts that the wrapper does not know are read, and template nodes with
the wrapper's text are left out. What markup declares as no main text (navigation, footers, forms, adverts, comments ...) is
never a slot; class and id names count only as whole tokens, and never drop an article, what is
around it, or what holds most of the text. Where a page does not fit its wrapper, or its host has a single page, the page is its
own wrapper.

Blocks are the runs of text between block-level tags; character references are decoded, white space
in a block becomes one space, blank blocks go, blocks are joined by line ends in page order.

Defined cases: null and blank pages give empty text; a null address or one without a host belongs to
the host ''; repeated rows each keep a row; unclosed, stray and cut tags never fail; an empty frame
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import with_small, written

SAMPLE = 8                 # pages of a host's layout whose trees are aligned
LEAST_PAGES = 3            # pages on which a text must stand to be template, and that a host needs to tell
TEMPLATE_SHARE = 0.9       # of all pages of a layout or a host, on which a template text stands
FLUSH = 200_000            # counts a task holds before it hands them on
REGION_SHARE = 0.7         # of the varying text, held by the node by which copies are told; all of it is read
FIXED_SHARE = 0.3          # of the region's text; if more is the same on all pages, they are copies
DEPTH = 150                # of the tree; blocks nested deeper become siblings, no text is lost
BROADCAST_BYTES = 32 << 20  # all wrappers together, below which they are broadcast

# Element kinds of the HTML standard.
BODIES = {"article", "main"}
TEXT_TAGS = set("blockquote caption dd dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr li ol p pre table tbody td tfoot th thead tr ul".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript object ol option "
    "p pre search section select summary svg table tbody td template textarea tfoot th thead title tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
CLOSES_P = BLOCKS - set("body caption dd dt head html iframe legend li noscript object option p select svg tbody td template tfoot th thead title tr textarea".split()) | {"p", "li", "dd", "dt"}
CLOSED_BY_LIKE = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "option": {"select"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}}

# What markup declares not to be main text.
NO_TEXT_TAGS = set("aside button dialog footer form head iframe menu nav noscript object script search select style svg template textarea".split())
NO_TEXT_NAMES = set(
    "ad adbox ads adsense adslot adunit advert adverts advertisement advertising alert banner banners breadcrumb breadcrumbs "
    "comment commentform commentlist comments consent cookie cookies copyright disclaimer discussion footer gdpr login masthead "
    "menu menus modal nav navbar navigation newsletter notice notices overlay pager pagination popup popups promo promotion "
    "recommended related replies reply respond share sharing sidebar sidebars signup skip social sponsor sponsored sponsors "
    "subscribe subscription toast toolbar trending widget widgets".split())
# Names that text of an article may have too: they count only outside of article and main.
MAYBE_TEXT_NAMES = set("alert banner copyright disclaimer discussion notice notices overlay promo promotion related respond skip social widget widgets".split())
# Words of place and form: a class token is such a name if it has no other words beside it.
PLACE_NAMES = set("area bar block bottom box button buttons container group inner item items left link links list main outer panel right section side site top wrapper".split())
NO_TEXT_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>?|<[a-zA-Z/][^>]*$", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    """A block element: its items are texts and block elements in page order."""

    __slots__ = ("tag", "sign", "declared", "named", "dropped", "items", "parent", "depth")

    def __init__(self, tag: str, sign: str, declared: str, parent):
        self.tag, self.sign, self.items, self.parent = tag, sign, [], parent
        self.declared, self.named = bool(declared), declared == "name"
        self.dropped, self.depth = False, parent.depth + 1 if parent else 0

    def blocks(self) -> list:
        return [x for x in self.items if isinstance(x, Node)]

    def unname(self) -> None:
        """No name drops what is around this element."""
        for node in _above(self):
            node.declared = node.declared and not node.named

    def under_declared(self) -> bool:
        node = self.parent
        while node:
            if node.declared:
                return True
            node = node.parent
        return False

    def within(self, tags: set[str]) -> bool:
        node = self
        while node:
            if node.tag in tags:
                return True
            node = node.parent
        return False


def _declared(tag: str, names: str, role: str, parent: Node) -> str:
    """Whether markup says that an element is no main text: by its "kind", only by a "name", or not ("")."""
    if tag == "form":
        return "name"  # a page may lie in one form as a whole
    if tag in NO_TEXT_TAGS or role in NO_TEXT_ROLES:
        return "kind"
    if tag == "header" and not parent.within(BODIES):
        return "kind"
    if not names or tag in ("html", "body", "main", "article"):
        return ""
    telling = NO_TEXT_NAMES - MAYBE_TEXT_NAMES if parent.within(BODIES) else NO_TEXT_NAMES | {"header"}
    for token in names.split():
        parts = {p.lower() for p in _NAME_PART.findall(token)}
        if parts & telling and parts <= telling | PLACE_NAMES:
            return "name"
    return ""


def parse(page: str, inline_names: bool = True) -> Node:
    """The tree of a page's block elements. Inline tags only leave their text."""
    root = here = Node("#page", "#page", "", None)
    inline_skip: list[str] = []  # open inline elements that hold no main text, such as a button
    skipped = 0                  # letters in them
    at, length = 0, len(page)
    while at < length:
        token = _TOKEN.search(page, at)
        text = page[at : token.start() if token else length]
        if text and not inline_skip:
            here.items.append(text)
        skipped += len(text.strip()) if inline_skip else 0
        if not token:
            break
        at = token.end()
        tag = token["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if token["end"]:
            if inline_skip and tag in inline_skip:
                del inline_skip[inline_skip.index(tag):]
            elif tag in BLOCKS:
                node = here
                while node is not root and node.tag != tag:
                    node = node.parent
                if node is not root:
                    here = node.parent
                    inline_skip.clear()
            continue
        if tag in RAW:
            close = re.compile(f"</{tag}[\\s/>]", re.I).search(page, at)
            end = close.start() if close else length
            at = page.find(">", end) + 1 or length if close else length
            continue
        if tag == "br":
            here.items.append(" ")
            continue
        if tag in VOID and tag != "hr":
            continue
        attributes = {}
        if token["rest"]:
            attributes = {a.lower(): v or w or x for a, v, w, x in _ATTRIBUTE.findall(token["rest"])}
        names = f"{attributes.get('class', '')} {attributes.get('id', '')}".strip()
        if tag not in BLOCKS:
            said = "" if token["rest"].endswith("/") else _declared(tag, names, attributes.get("role", ""), here)
            if said == "kind" or said and inline_names:
                inline_skip.append(tag)
            continue
        inline_skip.clear()
        if tag in CLOSES_P:
            here = _closed(here, {"p"}, BLOCKS - {"p"})
        if tag in CLOSED_BY_LIKE:
            here = _closed(here, CLOSED_BY_LIKE[tag], SCOPES[tag])
        # classes of these say what a page is about; pages that differ in them are of one layout
        sign = tag + "." + re.sub(r"\d+", "", names) if names and tag not in ("html", "body", "main", "article") else tag
        node = Node(tag, sign, _declared(tag, names, attributes.get("role", ""), here), here)
        here.items.append(node)
        if tag != "hr" and node.depth < DEPTH:
            here = node
    _settle(root)
    if inline_names and skipped and skipped > sum(_letters(n) for n in _nodes(root) if not n.dropped):
        return parse(page, False)  # inline elements of telling names hold most of the text
    return root


def _letters(node: Node) -> int:
    return sum(len(x.strip()) for x in node.items if isinstance(x, str))


def _settle(root: Node) -> None:
    """Marks what lies in declared elements.

    If all articles lie in such, names drop none of them, and the first is kept whatever it lies in.
    Names never drop an element around main, or with most of the text of its article or, if there
    is none outside of it, of the page; likewise a form that is not in an article.
    """
    nodes = list(_nodes(root))
    bodies = [n for n in nodes if n.tag in BODIES and not n.declared]
    for body in bodies:
        if body.tag == "main":
            body.unname()
    if bodies and all(n.under_declared() for n in bodies):
        for body in bodies:
            body.unname()
        if all(n.under_declared() for n in bodies):
            node = bodies[0]
            while node:
                node.declared, node = False, node.parent
    if any(n.declared and n.named for n in nodes):
        held: dict[int, int] = {}
        for node in reversed(nodes):  # children come first
            held[id(node)] = _letters(node) + sum(held[id(c)] for c in node.blocks() if not c.declared or c.named)
        kept = [n for n in bodies if held[id(n)] and not n.under_declared()]
        for node in nodes:
            if node.declared and node.named:
                inside = [n for n in _above(node) if n.tag in BODIES]
                around = [] if inside and node.tag == "form" else inside or ([] if kept else [root])
                if around and 2 * held[id(node)] > held[id(around[-1])]:
                    node.declared = False
    for node in nodes:  # parents come first
        node.dropped = node.declared or node.parent is not None and node.parent.dropped


def _above(node: Node) -> Iterator[Node]:
    while node.parent:
        node = node.parent
        yield node


def _nodes(node: Node) -> Iterator[Node]:
    yield node
    for child in node.blocks():
        yield from _nodes(child)


def _closed(here: Node, tags: set[str], stop: set[str]) -> Node:
    """The parent of the nearest open element of `tags`, if none of `stop` lies between."""
    node = here
    while node.parent is not None:
        if node.tag in tags:
            return _closed(node.parent, tags, stop)
        if node.tag in stop:
            return here
        node = node.parent
    return here


def words(node: Node) -> str:
    """A node's own text, without its block children, as it would be written."""
    return " ".join(html.unescape(" ".join(x for x in node.items if isinstance(x, str))).split())


def digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def layout(root: Node) -> tuple[int, set[tuple[int, int]]]:
    """A page's layout, which is the set of its containers, and the texts at each path of signs."""
    places, texts, known = set(), set(), {}
    for node in _nodes(root):
        if not node.dropped:
            key = (known[id(node.parent)] if node.parent else 0, node.sign)
            path = known[id(node)] = known.get(key) or known.setdefault(key, digest(f"{key[0]}/{key[1]}"))
            if node.sign not in TEXT_TAGS:
                places.add(path)
            if text := words(node):
                texts.add((path, digest(text)))
    return digest(" ".join(map(str, sorted(places)))), texts


class Shape:
    """A node of an alignment tree: a run of like siblings of a page."""

    __slots__ = ("sign", "tag", "nodes", "children")

    def __init__(self, nodes: list[Node]):
        self.nodes, self.sign, self.tag = nodes, nodes[0].sign, nodes[0].tag
        runs: list[list[Node]] = []
        places: dict[str, int] = {}  # with several nodes, children of one sign are one run
        for node in nodes:
            for child in node.blocks():
                if child.dropped:
                    continue
                if len(nodes) > 1 and child.sign in places:
                    runs[places[child.sign]].append(child)
                elif runs and runs[-1][0].sign == child.sign:
                    runs[-1].append(child)
                else:
                    places[child.sign] = len(runs)
                    runs.append([child])
        self.children = [Shape(run) for run in runs]

    def texts(self) -> list[str]:
        return list(filter(None, map(words, self.nodes)))


class Wrapper:
    """A node of a layout's wrapper: a run of like siblings, and the texts that the aligned pages have in it."""

    __slots__ = ("sign", "tag", "path", "templates", "children", "pages", "seen", "letters", "region", "keep", "judged")

    def __init__(self, sign: str, tag: str, above: int = 0, templates: set = frozenset()):
        self.sign, self.tag, self.path, self.templates, self.children = sign, tag, digest(f"{above}/{sign}"), templates, []
        self.pages, self.seen, self.letters, self.region, self.keep = 0, Counter(), 0, False, False
        self.judged = False  # of a whole wrapper: whether its host has enough pages to tell template from content

    def add(self, part: Shape) -> None:
        texts = part.texts()
        self.seen.update(texts)
        self.pages += 1
        self.letters += sum(map(len, texts))

    def fixed(self) -> list[str]:
        """The texts seen here that are template."""
        return [] if self.keep else sorted(t for t in self.seen if (self.path, digest(t)) in self.templates)

    def fixed_letters(self) -> int:
        return sum(len(t) * self.seen[t] for t in self.fixed())


class Kinds:
    """Numbers the structures of the trees that are matched: nodes of one structure score alike, so
    scores are computed once per pair of structures and not per pair of nodes."""

    def __init__(self):
        self.of: dict[int, int] = {}                   # structure of a node by its identity
        self.number: dict[tuple, int] = {}
        self.signs: list[str] = []
        self.below: list[tuple[int, ...]] = []
        self.sizes: list[int] = []
        self.scores: dict[tuple[int, int], int] = {}

    def kind(self, node) -> int:
        found = self.of.get(id(node))
        if found is None:
            key = (node.sign, tuple(map(self.kind, node.children)))
            found = self.number.get(key)
            if found is None:
                found = self.number[key] = len(self.signs)
                self.signs.append(node.sign)
                self.below.append(key[1])
                self.sizes.append(1 + sum(self.sizes[k] for k in key[1]))
            self.of[id(node)] = found
        return found

    def score(self, a: int, b: int) -> int:
        if a == b:
            return self.sizes[a]
        if self.signs[a] != self.signs[b]:
            return 0
        if (a, b) not in self.scores:
            left, right = self.below[a], self.below[b]
            same = _like(left, right)
            self.scores[a, b] = 1 + sum(self.sizes[k] for k in left[:same]) + self.best(left[same:], right[same:])[0]
        return self.scores[a, b]

    def best(self, left: tuple[int, ...], right: tuple[int, ...], ways: bool = False) -> tuple[int, list]:
        """The best score of two lists of structures paired in order, and, if asked for, per row the places
        (packed bits) where leaving out the last of `left`, or of `right`, loses nothing."""
        if not left or not right:
            return 0, []
        columns, back = np.unique(np.array(right, dtype=np.int64), return_inverse=True)
        gains: dict[int, np.ndarray] = {}
        above, rows = np.zeros(len(right) + 1, dtype=np.int64), []
        for x in left:
            if x not in gains:
                gains[x] = np.array([self.score(x, y) for y in columns.tolist()], dtype=np.int64)[back]
            row = np.zeros_like(above)
            np.maximum.accumulate(np.maximum(above[1:], above[:-1] + gains[x]), out=row[1:])
            if ways:
                rows.append((np.packbits(row[1:] == above[1:]), np.packbits(row[1:] == row[:-1])))
            above = row
        return int(above[-1]), rows


def _like(left: tuple[int, ...], right: tuple[int, ...]) -> int:
    """How many structures two lists begin with alike. Some best matching pairs all of these: a structure
    gains with its like as much as it can gain at all."""
    same = 0
    for x, y in zip(left, right):
        if x != y:
            break
        same += 1
    return same


def match(a, b, scores: dict) -> int:
    """Simple tree matching: the most nodes of two trees that can be paired in order, below like roots."""
    kinds = scores.setdefault("kinds", Kinds())
    return kinds.score(kinds.kind(a), kinds.kind(b))


def paired(a, b, scores: dict) -> list[tuple]:
    """The pairs of children of two matched nodes in one best matching.

    Time is in proportion to the children while both sides begin alike, and to the product of what is
    left, a row at a time, beyond; a quarter byte is held for each pair of what is left.
    """
    kinds = scores.setdefault("kinds", Kinds())
    left, right = tuple(map(kinds.kind, a.children)), tuple(map(kinds.kind, b.children))
    same = _like(left, right)
    rows = kinds.best(left[same:], right[same:], True)[1]
    out, i, j = [], len(left) - same, len(right) - same
    while i and j:
        over, beside = (bits[(j - 1) >> 3] >> (7 - ((j - 1) & 7)) & 1 for bits in rows[i - 1])
        if over:
            i -= 1
        elif beside:
            j -= 1
        else:
            out.append((a.children[same + i - 1], b.children[same + j - 1]))
            i, j = i - 1, j - 1
    return list(zip(a.children[:same], b.children[:same])) + out[::-1]


def absorb(wrapper: Wrapper, part: Shape, scores: dict) -> None:
    """Adds a page's tree to the wrapper; nodes without a counterpart go in beside their neighbours."""
    wrapper.add(part)
    partner = {id(y): x for x, y in paired(wrapper, part, scores)}
    at = 0
    for child in part.children:
        own = partner.get(id(child))
        if own is None:
            own = Wrapper(child.sign, child.tag, wrapper.path, wrapper.templates)
            wrapper.children.insert(at, own)
        at = wrapper.children.index(own, at) + 1
        absorb(own, child, scores if id(child) in partner else {})


def templates_of(pages: list[str]) -> set[tuple[int, int]]:
    """The template texts, with their paths, of a layout that has just these pages."""
    n = Counter(t for page in set(pages) for t in layout(parse(page))[1])
    return {t for t, k in n.items() if k >= max(LEAST_PAGES, TEMPLATE_SHARE * len(set(pages)))}


def induce(pages: list[str], templates: set[tuple[int, int]] | None = None, host_pages: int | None = None) -> Wrapper:
    """The wrapper of some pages of a layout with known template texts, with its content region marked;
    `host_pages` are the pages of its host, these alone unless given."""
    wrapper = Wrapper("#page", "#page", 0, templates_of(pages) if templates is None else templates)
    wrapper.judged = (len(set(pages)) if host_pages is None else host_pages) >= LEAST_PAGES
    for page in pages:
        absorb(wrapper, Shape([parse(page)]), {})
    _mark_region(wrapper)
    return wrapper


def _varying(node: Wrapper) -> int:
    return node.letters - node.fixed_letters() + sum(_varying(c) for c in node.children)


def _bodies(node: Wrapper) -> list[Wrapper]:
    """The outermost article and main elements with text; a main element whose varying text is all in its articles counts as these."""
    if node.tag not in BODIES or not sum(n.letters for n in _walk(node)):
        return [b for c in node.children for b in _bodies(c)]
    inner = [b for c in node.children for b in _bodies(c)] if node.tag == "main" else []
    return inner if inner and _varying(node) == sum(map(_varying, inner)) else [node]


def _beside(node: Wrapper, bodies: list[Wrapper]) -> list[Wrapper]:
    """The bodies, and nodes beside or around them with text that is not template."""
    if node in bodies or node.letters > node.fixed_letters():
        return [node]
    return [n for c in node.children for n in _beside(c, bodies)]


def _narrowed(node: Wrapper, share: float) -> Wrapper:
    """The smallest node that holds a share of the varying text."""
    least = share * _varying(node)
    while inner := next((c for c in node.children if _varying(c) >= least > 0), None):
        if re.fullmatch("p|li|h[1-6]|td|pre|blockquote", inner.tag):
            break
        node = inner
    return node


def _mark_region(wrapper: Wrapper) -> None:
    bodies = _bodies(wrapper)
    regions = cores = bodies or [_narrowed(wrapper, 1)]
    if not bodies:
        cores = [_narrowed(wrapper, REGION_SHARE)]
    elif wrapper.judged and not any(n.tag == "main" for n in _walk(wrapper)):
        regions = _beside(wrapper, bodies)
    for region in regions:
        region.region = True
    for core in cores:
        parts = list(_walk(core))
        if sum(n.fixed_letters() for n in parts) > FIXED_SHARE * sum(n.letters for n in parts):
            for n in parts if bodies else _walk(regions[0]):  # the sampled pages are copies of one article
                n.keep = True


def _walk(node) -> Iterator:
    yield node
    for child in node.children:
        yield from _walk(child)


def to_text(wrapper: Wrapper) -> str:
    """A wrapper as JSON: sign, tag, template texts, region, children, whether it is judged."""
    def plain(n):
        return [n.sign, n.tag, n.fixed(), n.region, [plain(c) for c in n.children], int(n.judged)]
    return json.dumps(plain(wrapper), ensure_ascii=False, separators=(",", ":"))


class Fitted:
    """A wrapper as read back: what extraction needs. It is free if no article or main element says where the text is."""

    __slots__ = ("sign", "tag", "texts", "region", "children", "free", "judged")

    def __init__(self, plain: list):
        self.sign, self.tag, texts, self.region, children, self.judged = plain
        self.texts = set(texts)
        self.children = [Fitted(c) for c in children]
        self.free = not (self.region and self.tag in BODIES) and all(c.free for c in self.children)


def _strays(part: Shape, free: bool) -> Iterator[Shape]:
    """What counts as content of a part that the wrapper does not know."""
    if free or part.tag in BODIES:
        yield part
    else:
        for child in part.children:
            yield from _strays(child, False)


def _located(fitted: Fitted, part: Shape, scores: dict, regions: list[Shape], fixed: set[int], free: bool, inside: bool = False) -> None:
    """Collects the counterparts of content regions, unknown parts beside them, and nodes that have a template text.

    `free`: whether an unknown part counts as content if no article or main element is in it.
    """
    if fitted.region and not inside:
        regions.append(part)
        inside = True
    if fitted.texts:
        fixed.update(id(n) for n in part.nodes if words(n) in fitted.texts)
    known = {id(y): x for x, y in paired(fitted, part, scores)}
    for child in part.children:
        if id(child) in known:
            _located(known[id(child)], child, scores, regions, fixed, free or part.tag == "main", inside)
        elif not inside:
            regions.extend(_strays(child, free or part.tag == "main"))


def _has_text(node: Node) -> bool:
    return any(words(n) for n in _nodes(node) if not n.dropped)


def read_blocks(node: Node, fixed: set[int], top: bool = True) -> Iterator[str]:
    """The text blocks of a node, without template and declared nodes."""
    run: list[str] = []
    for item in node.items:
        if isinstance(item, str):
            if id(node) not in fixed:
                run.append(item)
        else:
            yield "".join(run)
            run = []
            if not item.dropped:
                yield from read_blocks(item, fixed, False)
    yield "".join(run)


def extract(page: str, fitted: Fitted | None) -> str:
    """A page's main text, by its host's wrapper or else by itself."""
    if not page.strip():
        return ""
    part = Shape([parse(page)])
    regions: list[Shape] = []
    fixed: set[int] = set()
    if fitted is not None:
        # what stands on none of the aligned pages cannot be template
        _located(fitted, part, {}, regions, fixed, fitted.free or bool(fitted.judged))
    bodies = [r for r in regions if fitted.free or any(n.tag in BODIES for n in _nodes(r.nodes[0]))]
    if not any(_has_text(n) for r in bodies for n in r.nodes):
        own = Wrapper("#page", "#page")
        absorb(own, part, {})
        _mark_region(own)
        regions, fixed = [], set()
        alone = Fitted(json.loads(to_text(own)))
        _located(alone, part, {}, regions, fixed, alone.free)
    found = (" ".join(html.unescape(b).split()) for r in regions for n in r.nodes for b in read_blocks(n, fixed))
    return "\n".join(b for b in found if b)


def _induced(pages: pd.DataFrame) -> pd.DataFrame:
    ordered = pages.sort_values(["place", "html"])
    first = pages.iloc[0]
    known = {(t["path"], t["hash"]) for of in ("of_layout", "of_host") if first[of] is not None for t in first[of]}
    return pd.DataFrame({"host": [first["host"]], "layout": [first["layout"]], "wrapper": [
        to_text(induce(ordered["html"].tolist(), known, 0 if pd.isna(first["host_pages"]) else int(first["host_pages"])))]})


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """On how many of a task's pages each text stands, by host, path and layout; path null counts the pages."""
    sums: Counter = Counter()

    def handed() -> pd.DataFrame:
        out = pd.DataFrame([(*k, n) for k, n in sums.items()], columns=["host", "layout", "path", "hash", "n"], dtype=object)
        out = out.astype({"layout": "int64", "path": "Int64", "hash": "Int64", "n": "int64"})
        sums.clear()
        return out

    for batch in batches:
        for host, page in zip(batch["host"], batch["html"]):
            kind, texts = layout(parse(page))
            sums[host, kind, None, None] += 1
            sums.update((host, kind, *t) for t in texts)
            if len(sums) > FLUSH:
                yield handed()
    if sums:
        yield handed()


def template_texts(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Template texts by layout (host, layout, of_layout) and by host (host, of_host), and the pages of each
    host (host, host_pages), from all pages; copies count once."""
    marked = rows.select("host", "html", F.xxhash64("html").alias("content"), F.xxhash64("page_id", "url").alias("by"))
    copies = written(marked.groupBy("host", "content").agg(F.min("by").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "copies")
    own = with_small(marked, copies, ["host", "content"], "left").where("first IS NULL OR first = by")
    # one exchange, of counts; what follows keeps its partitioning
    partial = own.select("host", "html").mapInPandas(_counted, "host string, layout long, path long, hash long, n long")
    by_layout = partial.repartition("host", "path", "hash").groupBy("host", "path", "hash", "layout").agg(F.sum("n").alias("n"))
    grouped = by_layout.groupBy("host", "path", "hash").agg(F.sum("n").alias("all"), F.collect_list(F.struct("layout", "n")).alias("in"))
    counts = written(grouped.where(F.col("path").isNull() | (F.col("all") >= LEAST_PAGES)), "block-texts")
    split = counts.select("host", "path", "hash", F.explode("in").alias("l")).select("host", "path", "hash", "l.layout", "l.n")
    whole = counts.select("host", "path", "hash", F.col("all").alias("n"))

    def found(table: DataFrame, keys: list[str], name: str) -> DataFrame:
        pages = table.where("path IS NULL").select(*keys, F.col("n").alias("pages"))
        often = table.where(F.col("path").isNotNull() & (F.col("n") >= LEAST_PAGES)).join(pages, keys)
        return often.where(F.col("n") >= TEMPLATE_SHARE * F.col("pages")).groupBy(*keys).agg(F.collect_list(F.struct("path", "hash")).alias(name))

    pages = whole.where("path IS NULL").select("host", F.col("n").alias("host_pages"))
    return found(split, ["host", "layout"], "of_layout"), found(whole, ["host"], "of_host"), pages


def main_texts(pages: DataFrame, key: str, url: str, page: str) -> DataFrame:
    """Per row of `pages`: the key (as `page_id`), url, text and n_chars, its code points."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), host.alias("host"),
                        F.coalesce(F.col(page), F.lit("")).alias("html"))
    of_layout, of_host, host_pages = template_texts(rows)

    @F.pandas_udf("long")
    def layout_of(texts: pd.Series) -> pd.Series:
        return pd.Series([layout(parse(t))[0] for t in texts], dtype="int64")

    rows = rows.withColumn("layout", layout_of("html"))
    by_hash = Window.partitionBy("host", "layout").orderBy(F.xxhash64("page_id", "url"))
    sample = rows.withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= SAMPLE)
    known = sample.join(of_layout, ["host", "layout"], "left").join(of_host, "host", "left").join(host_pages, "host", "left")
    wrappers = written(known.groupBy("host", "layout").applyInPandas(_induced, "host string, layout long, wrapper string"), "wrappers")
    total = wrappers.agg(F.sum(F.octet_length("wrapper"))).first()[0] or 0

    @F.pandas_udf("string")
    def extracted(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known: dict[str, Fitted] = {}
        for pages_, plans in batches:
            out = []
            for text, plan in zip(pages_, plans):
                if plan is not None and plan not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[plan] = Fitted(json.loads(plan))
                out.append(extract(text, known.get(plan)))
            yield pd.Series(out, dtype=object)

    fitted = rows.join(F.broadcast(wrappers) if total <= BROADCAST_BYTES else wrappers, ["host", "layout"], "left")
    return fitted.select("page_id", "url", extracted("html", "wrapper").alias("text")).withColumn(
        "n_chars", F.length("text").cast("long"))

