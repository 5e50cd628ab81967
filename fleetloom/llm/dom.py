"""A tolerant reading of HTML into containers and text blocks, and simple tree matching."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Elements that hold other blocks; the rest of the block elements hold text.
CONTAINERS = frozenset("body div section article main aside header footer nav form fieldset dialog details center".split())
TEXT_BLOCKS = frozenset(
    "p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd pre blockquote figure figcaption address table thead tbody tfoot "
    "tr td th caption hr hgroup summary".split()
)
ARTICLES = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is no text of the page.
UNSEEN = frozenset("script style noscript template textarea select button svg iframe object title datalist canvas audio video".split())
RAW = frozenset("script style textarea title noscript iframe".split())
# Containers nested deeper than this are read as text blocks of the one around them; what is marked as
# surrounding an article is left out at any depth.
MAX_DEPTH = 100
# Containers, and words in class, id or role, that mark what surrounds an article. A name that is such a
# word (``comments``) marks for sure, one that only holds it (``no-comments``, ``with-sidebar``) does not, nor does
# a form, which may enclose a whole page.
AROUND = frozenset("nav header footer aside dialog menu".split())
AROUND_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices pagination "
    "popup promo promoted related share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)

NONE, PERHAPS, SURE = range(3)
# Without any article, a mark that is not sure counts unless the unmarked text is less than this share of
# the text so marked.
UNMARKED_SHARE = 0.1

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_LETTERS = re.compile(r"[a-z]+")
_END = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)", re.I) for t in RAW}


@dataclass
class Node:
    label: str
    around: bool
    children: list[Node] = field(default_factory=list)
    id: int = -1
    mark: int = NONE
    size: int = 0  # characters of its own blocks

    def text(self) -> str:
        inner = ",".join(c.text() for c in self.children)
        return f"{self.label}{'!' if self.around else ''}({inner})"


def _label(tag: str, attributes: str) -> tuple[str, int]:
    found = [(k.lower(), v.strip("\"'").lower()) for k, v in _ATTRIBUTE.findall(attributes)] if attributes else ()
    names = [w for _, v in found for w in v.split()]
    if tag in AROUND or (tag not in ARTICLES and any(w in AROUND_WORDS for w in names)):
        mark = SURE
    elif tag == "form" or any(w in AROUND_WORDS for name in names for w in _LETTERS.findall(name)):
        mark = PERHAPS
    else:
        mark = NONE
    first = next((_LETTERS.findall(v) for k, v in found if k == "class"), [])
    return tag + ("." + first[0] if first else ""), mark


def is_article(node: Node) -> bool:
    return node.label.split(".")[0] in ARTICLES


def _settle(root: Node) -> None:
    """Decide which marks count: all that are sure, and of the others those that do not enclose the
    article (an element that says so and is longer than all unmarked text), or, without one, nearly all
    of the text."""
    # (length, path) of the longest article or main element outside of sure marks: in plain containers, in
    # doubtful ones, marked itself.
    best: dict[int, tuple[int, list[Node]]] = {}

    def walk(node: Node, path: list[Node], doubtful: bool) -> int:
        """Visible characters in ``node``; sets marks aside that are not sure."""
        node.around = node.mark != NONE
        if node.mark == SURE:
            return 0
        path = [*path, node]
        length = node.size + sum(walk(c, path, doubtful or node.around) for c in node.children)
        if is_article(node) and length:
            # A page's own article in plain containers leaves all marks as they are.
            kind = 0 if not doubtful and not node.around else 1 if not node.around else 2
            if kind not in best or length > best[kind][0]:
                best[kind] = (length, path)
        return length

    walk(root, [], False)
    if 0 in best:
        return

    def visible(node: Node, marked: list[tuple[int, Node]]) -> int:
        """Unmarked characters; the outermost doubtful containers with theirs go into ``marked``."""
        if node.mark == SURE:
            return 0
        if node.around:
            marked.append((_length(node), node))
            return 0
        return node.size + sum(visible(c, marked) for c in node.children)

    if best:
        length, path = best[min(best)]
        if visible(root, []) < length:
            for node in path:
                node.around = False
            return
    while True:
        marked: list[tuple[int, Node]] = []
        plain = visible(root, marked)
        length, node = max(marked, key=lambda m: m[0], default=(0, None))
        if not length or plain >= UNMARKED_SHARE * sum(n for n, _ in marked):
            return
        node.around = False


def _length(node: Node) -> int:
    return 0 if node.mark == SURE else node.size + sum(map(_length, node.children))


def read(page: str) -> tuple[str, list[tuple[int, str]]]:
    """The container tree as text, runs of equal siblings written once, and the text blocks in
    page order with the number of their container in that tree. Blocks in containers that surround
    an article are left out."""
    root = Node("body", False)
    stack: list[tuple[str, Node | None]] = [("body", root)]  # open elements; containers with their node
    blocks: list[tuple[Node, str]] = []
    parts: list[str] = []
    here, unseen, depth = root, 0, 0

    def close_block() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text and not unseen:
                blocks.append((here, text))
                here.size += len(text)

    def enter(tag: str, label: str, mark: int) -> None:
        nonlocal here, depth
        node = Node(label, False, mark=mark)
        if depth < MAX_DEPTH:
            here.children.append(node)  # a deeper one has no place in the tree, so its text goes
        stack.append((tag, node))
        here = node
        depth += 1

    def pop(i: int) -> None:
        nonlocal here, unseen, depth
        for tag, node in reversed(stack[i:]):
            if tag in UNSEEN:
                unseen -= 1
            if node is not None:
                depth -= 1
        del stack[i:]
        here = next(n for _, n in reversed(stack) if n is not None)

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            parts.append(page[at:])
            break
        if m.start() > at and not unseen:
            parts.append(page[at:m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None or not m.group(4):
            continue  # a comment or declaration, or a tag cut off by the end
        tag = tag.lower()
        if tag == "html" or tag == "body":
            continue
        if m.group(1):
            if tag in CONTAINERS or tag in TEXT_BLOCKS:
                close_block()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    if tag in CONTAINERS or tag in TEXT_BLOCKS or tag in UNSEEN:
                        close_block()
                    pop(i)
                    break
                if stack[i][1] is not None and tag not in CONTAINERS:
                    break  # inside a container, an end tag does not reach elements outside of it
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in RAW:
            # Raw text runs to its own end tag, whatever it holds.
            stop = _END[tag].search(page, at)
            at = stop.end() if stop else end
            continue
        if tag in CONTAINERS or tag in TEXT_BLOCKS:
            close_block()
            # A block ends an open paragraph, an item an open item of the same list.
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in CONTAINERS or stack[i][0] in ("ul", "ol", "dl", "table"):
                    break
                if stack[i][0] == "p" or (stack[i][0] == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option")):
                    pop(i)
                    break
        if tag in VOID or m.group(3).endswith("/"):
            continue
        if tag in UNSEEN:
            close_block()
            stack.append((tag, None))
            unseen += 1
        elif tag in TEXT_BLOCKS or tag in CONTAINERS:
            label, mark = _label(tag, m.group(3))
            # A marked list or paragraph counts as a container of its own. Far down only sure marks count.
            if mark == SURE or (depth < MAX_DEPTH and (mark or tag in CONTAINERS)):
                enter(tag, label, mark)
            else:
                stack.append((tag, None))
    close_block()
    _settle(root)
    skeleton = _numbered(root)
    left_out = _inside_marks(root)
    return skeleton, [(node.id, text) for node, text in blocks if node.id >= 0 and node.id not in left_out]


def _inside_marks(root: Node) -> set[int]:
    """Numbers of the containers that surround the article, with all in them."""
    found: set[int] = set()

    def walk(node: Node, inside: bool) -> None:
        inside = inside or node.around
        if inside:
            found.add(node.id)
        for c in node.children:
            walk(c, inside)

    walk(root, False)
    return found


def _numbered(root: Node) -> str:
    """Merge runs of equal siblings, number the nodes in order, and write the tree."""

    def shape(node: Node) -> str:
        merged: list[tuple[str, list[Node]]] = []
        for c in node.children:
            s = shape(c)
            if merged and merged[-1][0] == s:
                merged[-1][1].append(c)
            else:
                merged.append((s, [c]))
        node.runs = merged
        return f"{node.label}{'!' if node.around else ''}({','.join(s for s, _ in merged)})"

    text = shape(root)
    count = 0

    def number(nodes: list[Node]) -> None:
        nonlocal count
        for n in nodes:
            n.id = count
        count += 1
        for k in range(len(nodes[0].runs)):
            number([n for same in nodes for n in same.runs[k][1]])

    number([root])
    return text


def parse(skeleton: str) -> Node:
    """The tree of a skeleton, numbered as by ``read``."""
    root = Node("", False)
    stack, label, count = [root], "", 0
    for ch in skeleton:
        if ch == "(":
            node = Node(label.rstrip("!"), label.endswith("!"), id=count)
            count += 1
            stack[-1].children.append(node)
            stack.append(node)
            label = ""
        elif ch == ")":
            stack.pop()
        elif ch != ",":
            label += ch
    return root.children[0]


def tree_match(a: Node, b: Node) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: the largest order-keeping match of equal labels that pairs roots with
    roots, and the pairs of node numbers in it."""
    if a.label != b.label or a.around != b.around:
        return 0, []
    rows, columns = len(a.children), len(b.children)
    best = [[(0, 0)] * (columns + 1) for _ in range(rows + 1)]
    inner: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for i in range(1, rows + 1):
        for j in range(1, columns + 1):
            size, pairs = tree_match(a.children[i - 1], b.children[j - 1])
            inner[i, j] = pairs
            best[i][j] = max(
                (best[i][j - 1][0], 1), (best[i - 1][j][0], 2), (best[i - 1][j - 1][0] + size, 3 if size else 0)
            )
    pairs, i, j = [(a.id, b.id)], rows, columns
    while i and j:
        move = best[i][j][1]
        if move == 3:
            pairs += inner[i, j]
        i, j = i - (move != 1), j - (move != 2)
    return best[rows][columns][0] + 1, pairs
