"""Main text of web pages by wrappers learned per host.

Learning: every page is parsed, and of each element its path of labels and its text are
hashed. Pages of a host whose path sets of containers are equal have one layout. Per layout,
and per host for layouts of a single page, the texts are counted over all pages: a text that
most pages with its path show there is template. Pages with equal main text count once, so
copies teach nothing; two differing pages are enough. The slots, elements whose text varies,
come from simple tree matching of all these pages: the largest set of node pairs with equal
labels that keeps parents and the order of siblings. The pages of a layout lie in buckets of
about ``BUCKET``; of each path, each page of a bucket that shows it is matched with the next
one that does, and the first one of a bucket with the first of the next bucket that has one. So
n pages with a path are joined by n - 1 matchings, however rare it is. Only trees of hashes
and lengths are sent to them.

Extraction: each whole page is parsed and walked. Template elements are dropped at any
length, and the slot with the most varying text is the article. Inside it, what is
no block is article text; so are headings, paragraphs and all blocks but containers
(``LOOSE``) unless nearly all pages with their path, and three at least, show the same: near
copies and articles that share a headline or a passage keep it. A host without two differing
pages has no alignment: there the article is where the page marks it (article, main), else
the body. Elements whose tag, role or whole class or id says menu, header, footer, sidebar,
notice, advert, form, script, style or reader comments are dropped too, as their text may
vary; on aligned hosts none that holds the slot. Block elements become lines: references
decoded, white space made one space, trimmed, empty ones left out.

Nulls and odd input: a null or empty page has empty text; broken markup is read on, to the
end; a null url is a host of its own, the empty one. Repeated rows give equal rows, an empty
table none, other columns are not read.
"""

from __future__ import annotations

import html as references
import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brightloom.llm.urlrules import host_and_path
from brightloom.session import stage

#: Pages of a layout in one bucket, about; all are aligned.
BUCKET = 32
#: Runs of siblings from which a row of a matching is an array.
WIDE = 32
#: Levels of the tree; what is nested deeper is kept flat, but for what is dropped.
DEPTH = 250
#: Layout that stands for all pages of a host.
WHOLE = 0

# HTML's void elements, raw text elements and blocks.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe noembed noframes template xmp".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
_P, _P_SCOPE = {"p"}, set("article aside body div section td th li main nav footer header form blockquote button table".split())
# Elements that make a layout.
CONTAINERS = set("article aside body div footer form header main nav section".split())
# What is never main text, by tag, role and whole class or id.
DROPPED_TAGS = set("head nav footer aside form menu dialog button select datalist object canvas svg math audio video".split()) | RAW
DROPPED_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
DROPPED_WORDS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer discussion disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices "
    "notification overlay pagination paywall popup promo promoted recommended related replies reply respond responses search "
    "share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
ARTICLE_WORDS = set("comment comments reply replies related promo sponsored ad advert advertisement".split())
CONTENT_TAGS = {"article", "main"}
# Elements that can be a slot, and those that make their parent one.
SLOTS = CONTAINERS | {"html", "table", "tbody", "tr", "td"}
HEADS = {"p", "h1"}
#: An element of a sketch's tree: twice its depth, plus one if it is of HEADS; path, key, length of its text.
ELEMENT = np.dtype([("kind", "<u2"), ("place", "<i8"), ("key", "<i8"), ("chars", "<u4")])
# Inside a slot, what most pages share is boilerplate in these alone.
LOOSE = set("address details div dl fieldset figure footer header hgroup section table ul ol".split())

_MARK = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden)\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""", re.I)


@dataclass(slots=True)
class Node:
    tag: str
    label: str | int
    words: frozenset[str] = frozenset()
    role: str = ""
    children: list[Node | str] = field(default_factory=list)
    shape: int = 0  # equal for trees of equal labels; 0: not known


@dataclass(slots=True)
class Spot(Node):
    """An element of a sketch: its label is its path's hash, its key 0 if it has no text."""

    key: int = 0
    chars: int = 0
    depth: int = 0
    head: bool = False
    above: int = 0


@lru_cache(4096)
def _attributes(tag: str, raw: str) -> tuple[str, frozenset[str], str]:
    """Label (tag and classes), classes and id, role."""
    classes, words, role = "", set(), ""
    for m in _ATTRIBUTE.finditer(raw):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if m.start() and not raw[m.start() - 1].isspace():
            continue  # the tail of another attribute's name
        if name == "role":
            role = value.lower().strip()
        elif name != "hidden":
            words |= set(value.lower().split())
            classes = " ".join(sorted(value.split())) if name == "class" else classes
    return f"{tag}.{classes}" if classes else tag, frozenset(words), role


def parse(page: str) -> Node:
    """The page's tree; end tags that are missing are implied, stray ones ignored. Below
    ``DEPTH`` levels contents go to the element of that level, blocks marked at both ends; a
    dropped element there still holds its own."""
    root = Node("", "")
    stack, tags, opened = [root], [""], defaultdict(int)
    at, size = 0, len(page)

    def end(i: int) -> None:
        flat = stack[i] is stack[i - 1] and tags[i] in BLOCKS
        edge = tags[i]
        for tag in tags[i:]:
            opened[tag] -= 1
        del stack[i:], tags[i:]
        if flat:
            stack[-1].children.append(Node(edge, edge))

    def close(ended: set[str], scope: set[str]) -> None:
        """End the innermost open element of ``ended`` unless one of ``scope`` lies within."""
        for i in range(len(stack) - 1, 0, -1):
            if tags[i] in ended:
                end(i)
                return
            if tags[i] in scope:
                return

    while at < size:
        m = _MARK.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            stack[-1].children.append(references.unescape(text))
        if not m:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag = name.lower()
        if m[1] or m[4]:
            if opened[tag]:
                end(len(tags) - 1 - tags[::-1].index(tag) if tags[-1] != tag else len(tags) - 1)
            continue
        attributes = m[3] if m[2] else m[6]
        if opened["p"] and tag in BLOCKS:
            close(_P, _P_SCOPE)
        if tag in CLOSES and any(opened[t] for t in CLOSES[tag]):
            close(CLOSES[tag], SCOPES[tag])
        node = Node(tag, *_attributes(tag, attributes.rstrip("/")))
        stack[-1].children.append(node)
        if tag in RAW:
            found = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            at = size if not found else page.find(">", found.start()) + 1 or size
        elif tag not in VOID and not (attributes.endswith("/") and tag not in BLOCKS):
            own = len(stack) < DEPTH or (stack[-1] is stack[DEPTH - 1] and _is_dropped(node, True))
            stack.append(node if own else stack[-1])
            tags.append(tag)
            opened[tag] += 1
    return root


def _elements(node: Node) -> list[Node]:
    return [c for c in node.children if not isinstance(c, str) and c.tag not in RAW]


def simple_tree_matching(one: Node, two: Node) -> list[tuple[Node, Node]]:
    """Pairs of the largest top-down matching that keeps the order of siblings. Runs of
    siblings with one label are lists: their members are matched one to one in order. Trees
    of one shape match whole."""
    known: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    def table(a: Node, b: Node) -> tuple[int, list[tuple[int, int]]]:
        """Pairs of two elements of one label and, unless of one shape, the steps of ``_row`` for each run of a."""
        both = a.shape or id(a), b.shape or id(b)
        if both in known:
            return known[both]
        if both[0] == both[1]:
            known[both] = len(_below(a)), []
            return known[both]
        xs, ys = _runs(a), _runs(b)
        kinds: dict[tuple[int, ...], int] = {}
        one, two = ([kinds.setdefault(tuple([n.shape or id(n) for n in run]), len(kinds)) for run in runs] for runs in (xs, ys))
        repeats, gains = Counter(one), {}
        best: list[int] | np.ndarray = [0] * (len(ys) + 1)
        steps = []
        for x, kind in zip(xs, one):
            gain = gains.get(kind)
            if gain is None:
                inner: dict[int, int] = {}
                for y, k in zip(ys, two):
                    if k not in inner:
                        inner[k] = sum([table(p, q)[0] for p, q in zip(x, y)]) if x[0].label == y[0].label else 0
                gain = [inner[k] for k in two]
                if len(gain) > WIDE:
                    gain = np.array(gain, np.int32)
                if repeats[kind] > 1:
                    gains[kind] = gain
            best, *step = _row(best, gain)
            steps.append(step)
        known[both] = int(best[-1]) + 1, steps
        return known[both]

    def match(a: Node, b: Node) -> list[tuple[Node, Node]]:
        if a.label != b.label:
            return []
        if a.shape and a.shape == b.shape:
            return list(zip(_below(a), _below(b)))
        xs, ys = _runs(a), _runs(b)
        steps, found, i, j = table(a, b)[1], [(a, b)], len(xs), len(ys)
        while i and j:
            without_x, without_y = steps[i - 1]
            if without_x >> j - 1 & 1:
                i -= 1
            elif without_y >> j - 1 & 1:
                j -= 1
            else:
                i, j = i - 1, j - 1
                for p, q in zip(xs[i], ys[j]):
                    found += match(p, q)
        return found

    return match(one, two)


def _row(best: list[int] | np.ndarray, gain: list[int] | np.ndarray) -> tuple[list[int] | np.ndarray, int, int]:
    """The next row of the most pairs two lists of runs can have, and the bits of the columns where
    it is no more than without this run and than without the column's."""
    if len(gain) > WIDE:
        row = np.zeros(len(gain) + 1, np.int64)
        above = np.asarray(best)
        np.maximum.accumulate(np.maximum(above[1:], above[:-1] + gain), out=row[1:])
        return row, *[int.from_bytes(np.packbits(same, bitorder="little").tobytes(), "little") for same in (row[1:] == above[1:], row[1:] == row[:-1])]
    row, without_x, without_y = [0], 0, 0
    for j, n in enumerate(gain):
        most = max(best[j] + n, best[j + 1], row[j])
        without_x |= (most == best[j + 1]) << j
        without_y |= (most == row[j]) << j
        row.append(most)
    return row, without_x, without_y


def _below(node: Node) -> list[Node]:
    """The element and all within it."""
    out = [node]
    for n in out:
        out += _elements(n)
    return out


def _runs(node: Node) -> list[list[Node]]:
    runs: list[list[Node]] = []
    for c in _elements(node):
        if runs and runs[-1][0].label == c.label:
            runs[-1].append(c)
        else:
            runs.append([c])
    return runs


def _hash(*parts: str) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest("\n".join(parts)), "big", signed=True)


def _survey(root: Node) -> tuple[dict[int, str], dict[int, str], int, list[tuple[int, str]]]:
    """Of each element, by its identity and inner ones first, the path and the raw text with
    blocks set apart; the page's layout; and the depth and tag of each element."""
    paths: dict[int, str] = {}
    raw: dict[int, str] = {}
    containers: set[str] = set()
    found: list[tuple[int, str]] = []

    def walk(n: Node, path: str, depth: int) -> str:
        parts = []
        for c in n.children:
            if isinstance(c, str):
                parts.append(c)
            elif c.tag not in RAW:
                if c.tag in BLOCKS or c.tag == "br":
                    parts.append(" ")
                parts.append(walk(c, f"{path}/{c.label}", depth + 1))
        if n.tag in CONTAINERS:
            containers.add(path)
        found.append((depth, n.tag))
        paths[id(n)], raw[id(n)] = path, "".join(parts)
        return raw[id(n)]

    walk(root, "", 0)
    return paths, raw, _hash(*sorted(containers)) or 1, found


@dataclass(frozen=True)
class Sketch:
    """What a page teaches: its layout, its main text by marks alone, the place (path) and
    key (path and text) of each element with text, and the tree of all elements."""

    layout: int
    main: int
    places: list[int]
    keys: list[int]
    tree: bytes


def sketch(page: str) -> Sketch:
    root = parse(page)
    paths, raw, layout, elements = _survey(root)
    hashes = {path: _hash(path) for path in set(paths.values())}
    found: dict[int, int] = {}
    tree = []
    for (depth, tag), path, text in zip(elements, paths.values(), raw.values()):
        text, key = " ".join(text.split()), 0
        if path and text:
            key = _hash(path, text)
            found[key] = hashes[path]
        tree.append((2 * depth + (tag in HEADS), hashes[path], key, len(text)))
    return Sketch(layout, _hash(_main(root, Wrapper())), list(found.values()), list(found), np.array(tree, ELEMENT).tobytes())


def _tree(packed: bytes) -> Spot:
    below: dict[int, list[Spot]] = {}
    for kind, place, key, chars in np.frombuffer(packed, ELEMENT).tolist():
        inner = below.pop(kind // 2 + 1, [])
        shape = hash((place, *[c.shape for c in inner])) or 1
        for c in inner:
            c.above = place
        below.setdefault(kind // 2, []).append(Spot("", place, children=inner, shape=shape, key=key, chars=chars, depth=kind // 2, head=kind % 2 == 1))
    return below[0][0]


@dataclass(slots=True)
class Slot:
    """A place of a layout, the page that shows it first, and how many characters vary there."""

    place: int
    above: int
    head: bool
    top: bool
    first: int
    chars: int = 0


def _vary(one: Spot, two: Spot, places: set[int], found: dict[int, Slot]) -> None:
    """Add the characters of matched elements of these places whose text varies."""
    for a, b in simple_tree_matching(one, two):
        if a.key != b.key and a.key and b.key and a.label in places:
            found[a.label].chars += a.chars + b.chars


def _known(main: int, tree: Spot) -> dict[int, Slot]:
    return {n.label: Slot(n.label, n.above, n.head, n.depth == 1, main) for n in _below(tree) if n.key}


def slots(pages: list[tuple[int, bytes]]) -> dict[int, Slot]:
    """All places of a bucket's pages (main text and tree); for each, every page that shows
    it is matched with the next one that does, in the order of main texts."""
    found: dict[int, Slot] = {}
    last: dict[int, int] = {}
    trees: list[Spot] = []
    for i, (main, packed) in enumerate(sorted(pages)):
        trees.append(_tree(packed))
        links: dict[int, set[int]] = defaultdict(set)
        for place, slot in _known(main, trees[i]).items():
            if place in last:
                links[last[place]].add(place)
            last[place] = i
            found.setdefault(place, slot)
        for before, places in links.items():
            _vary(trees[before], trees[i], places, found)
    return found


def link(one: tuple[int, bytes], two: tuple[int, bytes], places: set[int]) -> dict[int, Slot]:
    """The same of these places for the first pages of two buckets."""
    a, b = _tree(one[1]), _tree(two[1])
    found = {place: slot for place, slot in _known(one[0], a).items() if place in places}
    _vary(a, b, places, found)
    return found


@dataclass(frozen=True)
class Wrapper:
    template: frozenset[int] = frozenset()
    firm: frozenset[int] = frozenset()
    slots: dict[int, int] = field(default_factory=dict)  # place, varying characters
    own: frozenset[int] = frozenset()  # places whose own paragraphs or head vary
    total: int = 0


def _is_firm(n, pages):
    """Whether n of the pages with an element are nearly all (numbers or columns)."""
    return (n > 2) & (10 * n >= 9 * pages)


def induce(pages: list[str]) -> str:
    """The wrappers of one host, as ``learn`` makes them, from all its pages."""
    known: dict[int, Sketch] = {}
    for page in pages:
        s = sketch(page)
        known.setdefault(s.main, s)
    scopes: dict[int, list[Sketch]] = {}
    for s in known.values():
        for scope in (WHOLE, s.layout):
            scopes.setdefault(scope, []).append(s)
    out = []
    for scope, own in scopes.items():
        if len(own) > 1:
            at = Counter(p for s in own for p in set(s.places))
            held = Counter(k for s in own for k in s.keys)
            place = {k: p for s in own for p, k in zip(s.places, s.keys)}
            template = [k for k, n in held.items() if n > 1 and 2 * n > at[place[k]]]
            firm = [k for k in template if _is_firm(held[k], at[place[k]])]
            found = _slots(own)
            out.append({
                "layout": scope, "template": template, "firm": firm, "slots": [{"place": f.place, "chars": f.chars} for f in found if f.chars],
                "own": [f.above for f in found if f.head and f.chars], "total": sum(f.chars for f in found if f.top),
            })
    return json.dumps(out)


def _slots(own: list[Sketch]) -> list[Slot]:
    """The slots of one layout, its buckets put together."""
    trees = {s.main: s.tree for s in own}
    buckets: dict[int, list[int]] = defaultdict(list)
    for main in trees:
        buckets[main % -(-len(own) // BUCKET)].append(main)
    out: dict[int, Slot] = {}
    first: dict[int, int] = {}
    for _, mains in sorted(buckets.items()):
        links: dict[int, set[int]] = defaultdict(set)
        for place, slot in slots([(m, trees[m]) for m in mains]).items():
            out.setdefault(place, Slot(place, slot.above, slot.head, slot.top, slot.first)).chars += slot.chars
            if place in first:
                links[first[place], slot.first].add(place)
            first[place] = slot.first
        for (a, b), places in links.items():
            for place, slot in link((a, trees[a]), (b, trees[b]), places).items():
                out[place].chars += slot.chars
    return list(out.values())


@lru_cache(256)
def _wrappers(text: str) -> dict[int, Wrapper]:
    return {
        w["layout"]: Wrapper(
            frozenset(w.get("template") or ()), frozenset(w.get("firm") or ()), {s["place"]: s["chars"] for s in w.get("slots") or ()},
            frozenset(w.get("own") or ()), w.get("total") or 0,
        )
        for w in json.loads(text)
    }


def _is_dropped(node: Node, inside: bool) -> bool:
    if node.tag in ("html", "body", ""):
        return False
    if node.tag in DROPPED_TAGS or node.role in DROPPED_ROLES or (node.tag == "header" and not inside):
        return True
    if node.tag in CONTENT_TAGS:
        return bool(node.words & ARTICLE_WORDS)
    return bool(node.words & DROPPED_WORDS) or ("header" in node.words and not inside)


def extract(page: str | None, wrappers: str) -> str:
    """The page's main text."""
    if not page:
        return ""
    root = parse(page)
    known = _wrappers(wrappers)
    if not known:
        return _main(root, Wrapper())
    paths, raw, layout, _ = _survey(root)
    return _main(root, known.get(layout) or known.get(WHOLE) or Wrapper(), paths, raw)


def _main(root: Node, w: Wrapper, paths: dict[int, str] = {}, raw: dict[int, str] = {}) -> str:
    """Text of the article: the slot of aligned pages, else what the page marks, else the body.
    A wrapper asks for the paths and raw texts of the page."""
    lines: list[str] = []
    line: list[str] = []

    def flush() -> None:
        if text := " ".join("".join(line).split()):
            lines.append(text)
        line.clear()

    def marked(n: Node) -> bool:
        for c in _elements(n):
            if not _is_dropped(c, False) and (c.tag in CONTENT_TAGS or marked(c)):
                return True
        return False

    chosen = _slot(set(paths.values()), w) if w.slots else ""
    has_article = not chosen and marked(root)
    chosen = chosen or "/html"

    def walk(n: Node, path: str, inside: bool) -> None:
        for c in n.children:
            if isinstance(c, str):
                if inside:
                    line.append(c)
                continue
            if c.tag == "br":
                line.append(" ")
                continue
            if c.tag in BLOCKS:
                flush()
            here = f"{path}/{c.label}"
            holds = bool(w.slots) and c.tag not in RAW and f"{chosen}/".startswith(f"{here}/")
            if holds or not (_is_dropped(c, inside) or _is_template(c, here, w, inside, raw)):
                walk(c, here, inside or (c.tag in CONTENT_TAGS if has_article else here == chosen))
            if c.tag in BLOCKS:
                flush()

    walk(root, "", False)
    flush()
    return "\n".join(lines)


def _is_template(node: Node, path: str, w: Wrapper, inside: bool, raw: dict[int, str]) -> bool:
    if inside and node.tag not in BLOCKS:  # a word in bold is no boilerplate, on however many pages
        return False
    known = w.firm if inside and node.tag not in LOOSE else w.template
    if not known or node.tag in ("html", "body"):
        return False
    text = " ".join(raw.get(id(node), "").split())
    return bool(text) and _hash(path, text) in known


def _slot(here: set[str], w: Wrapper) -> str:
    """Path of the deepest slot on the page that still holds most of the varying text, or the
    first whose own paragraphs or head vary; empty if the page has none."""
    best = ""
    for path in sorted(here, key=lambda p: (p.count("/"), p)):
        label = path.rpartition("/")[2].split(".")[0]
        if label in SLOTS and path.startswith(f"{best}/") and w.slots.get(place := _hash(path), 0) * 2 > w.total:
            best = path
            if place in w.own or label in CONTENT_TAGS:
                break
    return best


SKETCH = "page_id long, url string, host string, layout long, main long, places array<long>, keys array<long>, tree binary"
SLOT = "host string, layout long, bucket long, place long, above long, head boolean, top boolean, first long, chars long"


def _sketches(named: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sketch(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array([s.layout for s in found], pa.int64()),
                    pa.array([s.main for s in found], pa.int64()), pa.array([s.places for s in found], pa.list_(pa.int64())),
                    pa.array([s.keys for s in found], pa.list_(pa.int64())), pa.array([s.tree for s in found], pa.binary()),
                ],
                names=["page_id", "url", "host", "layout", "main", "places", "keys", "tree"],
            )

    return named.select("page_id", "url", "host", "html").mapInArrow(run, SKETCH)


def _slot_rows(host: str, layout: int, bucket: int | None, found: dict[int, Slot]) -> list[dict]:
    return [
        {"host": host, "layout": layout, "bucket": bucket, "place": s.place, "above": s.above, "head": s.head, "top": s.top, "first": s.first, "chars": s.chars}
        for s in found.values()
    ]


SLOT_ARROW = pa.schema([
    ("host", pa.string()), ("layout", pa.int64()), ("bucket", pa.int64()), ("place", pa.int64()), ("above", pa.int64()),
    ("head", pa.bool_()), ("top", pa.bool_()), ("first", pa.int64()), ("chars", pa.int64()),
])


def _all_slots(trees: DataFrame) -> DataFrame:
    """The rows of ``SLOT`` of all buckets and of the matchings between them. ``trees`` has
    host, layout, the layout's number of buckets, main and tree."""

    def run(some: pa.Table) -> pa.Table:
        host, layout, bucket = (some.column(c)[0].as_py() for c in ("host", "layout", "bucket"))
        found = slots(list(zip(some.column("main").to_pylist(), some.column("tree").to_pylist())))
        return pa.Table.from_pylist(_slot_rows(host, layout, bucket, found), SLOT_ARROW)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                out += _slot_rows(r["host"], r["layout"], None, link((r["first"], r["tree"]), (r["next"], r["next_tree"]), set(r["places"])))
            yield pa.RecordBatch.from_pylist(out, SLOT_ARROW)

    bucketed = trees.withColumn("bucket", F.pmod("main", "buckets"))
    inner = stage(bucketed.select("host", "layout", "bucket", "main", "tree").groupBy("host", "layout", "bucket").applyInArrow(run, SLOT))
    follow = inner.withColumn("next", F.lead("first").over(Window.partitionBy("host", "layout", "place").orderBy("bucket"))).filter("next is not null")
    links = follow.groupBy("host", "layout", "first", "next").agg(F.collect_list("place").alias("places"))
    several = trees.filter("buckets > 1").select("host", "layout", "main", "tree")
    both = links.join(several.withColumnRenamed("main", "first"), ["host", "layout", "first"])
    both = both.join(several.withColumnsRenamed({"main": "next", "tree": "next_tree"}), ["host", "layout", "next"])
    both = both.select("host", "layout", "first", "tree", "next", "next_tree", "places")
    return inner.unionByName(both.mapInArrow(join, SLOT))


def learn(pages: DataFrame) -> DataFrame:
    """(host, wrapper): the wrappers of each host with two differing pages, per layout."""
    named = pages.withColumn("host", host_and_path(F.col("url"))[0]).filter("html is not null")
    rows = _sketches(named).groupBy("host", "main").agg(
        F.min(F.struct("page_id", "url", "layout", "places", "keys", "tree")).alias("s"), (F.min("layout") != F.max("layout")).alias("mixed"))
    rows = stage(rows.select("host", "main", "s.*", "mixed"))
    # everything is counted for the layout, and for the whole host if a page needs it: one alone in its layout, or
    # one whose layout only copies have
    sizes = stage(rows.groupBy("host", "layout").agg(F.count(F.lit(1)).alias("n"), F.max("mixed").alias("mixed")))
    whole = sizes.groupBy("host").agg(F.sum("n").alias("n"), F.max(F.col("mixed") | (F.col("n") == 1)).alias("needed")).filter("needed")
    sizes = sizes.select("host", "layout", "n").unionByName(whole.select("host", F.lit(WHOLE).cast("long").alias("layout"), "n")).filter("n > 1")
    sizes = stage(sizes.select("host", "layout", F.ceil(F.col("n") / BUCKET).alias("buckets")))
    scopes = F.explode(F.array(F.lit(WHOLE).cast("long"), "layout")).alias("layout")
    scoped = rows.select("host", scopes, "main", "places", "keys", "tree").join(sizes, ["host", "layout"])
    pairs = scoped.select("host", "layout", F.explode(F.arrays_zip("places", "keys")).alias("e"))
    held = pairs.groupBy("host", "layout", "e.places", "e.keys").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    spots = scoped.select("host", "layout", F.explode(F.array_distinct("places")).alias("places"))
    at = spots.groupBy("host", "layout", "places").agg(F.count(F.lit(1)).alias("pages"))
    same = held.join(at, ["host", "layout", "places"]).filter("2 * n > pages").groupBy("host", "layout").agg(
        F.collect_list("keys").alias("template"), F.collect_list(F.when(_is_firm(F.col("n"), F.col("pages")), F.col("keys"))).alias("firm"))
    found = _all_slots(scoped.select("host", "layout", "buckets", "main", "tree")).groupBy("host", "layout", "place").agg(
        F.sum("chars").alias("chars"), *[F.max(c).alias(c) for c in ("above", "head", "top")])
    varying = found.filter("chars > 0").groupBy("host", "layout").agg(
        F.collect_list(F.struct("place", "chars")).alias("slots"), F.collect_set(F.when(F.col("head"), F.col("above"))).alias("own"),
        F.sum(F.when(F.col("top"), F.col("chars"))).alias("total"))
    one = sizes.join(varying, ["host", "layout"], "left").join(same, ["host", "layout"], "left")
    one = one.select("host", F.struct("layout", "template", "firm", "slots", "own", "total").alias("w"))
    return one.groupBy("host").agg(F.to_json(F.collect_list("w")).alias("wrapper"))


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    slim = pages.select("page_id", "url", "html")
    wrappers = stage(learn(slim))
    named = slim.withColumn("_host", host_and_path(F.col("url"))[0])
    ready = named.join(wrappers, named["_host"] == wrappers["host"], "left").select("page_id", "url", "html", "wrapper")
    empty = induce([])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h, w or empty) for h, w in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return ready.mapInArrow(run, "page_id long, url string, text string, n_chars long")
