"""A page as a flat tree: elements in page order with their parents, and runs of text in blocks.

The parser follows the rules of HTML that decide where text belongs: raw text elements, comments, void
elements, end tags that may be left out, end tags that match nothing. It takes time linear in the page.
"""

import re
from dataclasses import dataclass, field
from html import unescape

# Elements by their role in the syntax.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup; it ends at their own end tag.
RAW = frozenset("script style xmp iframe noembed noframes textarea title noscript plaintext".split())
#: They only change the looks of text, so they are not part of the tree.
FORMATTING = frozenset(
    "abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rb rp rt rtc ruby s "
    "samp small strike strong sub sup time tt u var".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li listing main menu nav "
    "ol optgroup option p pre search section select summary table tbody td template tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of these ends an open paragraph.
ENDS_P = BLOCKS - frozenset("body caption head html legend optgroup option tbody td template tfoot th thead tr".split())
#: Start tag to the open elements that it ends, and the elements beyond which it does not look.
_LISTS, _TABLE = frozenset("ul ol menu dir".split()), frozenset(["table"])
IMPLIED = {
    "li": (frozenset(["li"]), _LISTS),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "optgroup", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset("tbody thead tfoot table".split())),
    "tbody": (frozenset("tr td th tbody thead tfoot caption".split()), _TABLE),
    "thead": (frozenset("tr td th tbody thead tfoot caption".split()), _TABLE),
    "tfoot": (frozenset("tr td th tbody thead tfoot caption".split()), _TABLE),
}
#: What a head may hold; any other element ends it.
IN_HEAD = frozenset("base link meta title script style noscript template".split())
#: An end tag does not reach beyond these.
SCOPES = frozenset("td th table caption template button object".split())
#: Elements nested deeper than this become siblings.
DEEPEST = 512

_ATTRIBUTES = (
    r"((?:[\s/]*+[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+)*+)[\s/]*+>"
)
TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)" + _ATTRIBUTES)
ATTRIBUTE = re.compile(
    r"([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?+"
)
COMMENT_END = re.compile(r"--!?>")


@dataclass
class Tree:
    """Elements 0.. in page order; element 0 is the page. Pieces are runs of text within one element.

    `blocks[p]` is the number of the block that piece p belongs to, `owner[b]` the block-level element
    that holds block b itself. `links[p]`: the piece stands in a link.
    """

    tags: list[str] = field(default_factory=lambda: ["#page"])
    parents: list[int] = field(default_factory=lambda: [-1])
    attributes: list[dict[str, str]] = field(default_factory=lambda: [{}])
    texts: list[str] = field(default_factory=list)
    nodes: list[int] = field(default_factory=list)
    blocks: list[int] = field(default_factory=list)
    links: list[bool] = field(default_factory=list)
    owner: list[int] = field(default_factory=list)


def attributes_of(source: str) -> dict[str, str]:
    """Attributes by name in lower case; the first of a name counts."""
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(source):
        value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
        out.setdefault(m[1].lower(), unescape(value))
    return out


class _Builder:
    def __init__(self):
        self.tree = Tree()
        self.stack = [0]
        self.open_links = 0
        self.in_head = False
        self.breaks = 0  # line breaks since the last text
        self.block = -1  # of the text at hand; -1: the next text begins one

    def text(self, raw: str) -> None:
        tree = self.tree
        if self.block < 0:
            if not raw.strip():
                return
            holder = next(n for n in reversed(self.stack) if n == 0 or tree.tags[n] in BLOCKS)
            self.block = len(tree.owner)
            tree.owner.append(holder)
        if raw.strip():
            self.breaks = 0
        tree.texts.append(unescape(raw) if "&" in raw else raw)
        tree.nodes.append(self.stack[-1])
        tree.blocks.append(self.block)
        tree.links.append(self.open_links > 0)

    def line_break(self) -> None:
        """One is white space; several in a row end the block."""
        self.breaks += 1
        if self.breaks > 1:
            self.block = -1
        elif self.block >= 0:
            self.text(" ")

    def pop(self, depth: int) -> None:
        """Close all elements from this depth on."""
        tags = self.tree.tags
        for n in self.stack[depth:]:
            if tags[n] == "a":
                self.open_links -= 1
            elif tags[n] in BLOCKS:
                self.block = -1
        del self.stack[depth:]

    def close_within(self, wanted: frozenset[str], limits: frozenset[str]) -> None:
        """Close the outermost open element of `wanted` that is nearer than any of `limits`."""
        tags, found = self.tree.tags, None
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = tags[self.stack[depth]]
            if tag in wanted:
                found = depth
            elif tag in limits:
                break
        if found is not None:
            self.pop(found)

    def start(self, tag: str, source: str) -> None:
        tags = self.tree.tags
        if tag == "br":
            self.line_break()
            return
        if tag in FORMATTING:
            return
        if tag in ("html", "body") and tag in tags:
            return
        if self.in_head and tag not in IN_HEAD:
            self.in_head = False
            self.close_within(frozenset(["head"]), frozenset())
        self.in_head |= tag == "head"
        if tag in ENDS_P:
            self.close_within(frozenset(["p"]), SCOPES)
        if tag in IMPLIED:
            self.close_within(*IMPLIED[tag])
        if tag in HEADINGS and tags[self.stack[-1]] in HEADINGS:
            self.pop(len(self.stack) - 1)
        if tag == "a":
            self.close_within(frozenset(["a"]), BLOCKS)
        if tag in BLOCKS:
            self.block = -1
        node = len(tags)
        tags.append(tag)
        self.tree.parents.append(self.stack[-1])
        self.tree.attributes.append(attributes_of(source) if source else {})
        if tag not in VOID and len(self.stack) < DEEPEST:
            self.stack.append(node)
            self.open_links += tag == "a"

    def end(self, tag: str) -> None:
        tags = self.tree.tags
        if tag == "br":
            self.line_break()
            return
        if tag in FORMATTING or tag in VOID or tag in ("html", "body"):
            return
        if tag == "p":  # one that ends no paragraph is an empty one
            self.block = -1
        plain = tag not in BLOCKS
        for depth in range(len(self.stack) - 1, 0, -1):
            open_tag = tags[self.stack[depth]]
            if open_tag == tag or (tag in HEADINGS and open_tag in HEADINGS):
                self.pop(depth)
                return
            # a block is not closed by the end of what is not one, nor a cell by what stands in it
            if (plain and open_tag in BLOCKS) or (open_tag in SCOPES and tag not in IMPLIED and tag != "table"):
                return
            if open_tag == "table" and tag != "table":
                return


def parse(html: str) -> Tree:
    """The tree of a page. Unfinished markup at the end of the page is left out."""
    builder, at, size = _Builder(), 0, len(html)
    while at < size:
        lt = html.find("<", at)
        if lt < 0:
            builder.text(html[at:])
            break
        if lt > at:
            builder.text(html[at:lt])
        m = TAG.match(html, lt + 1)
        if m:
            at = m.end()
            tag = m[2].lower()
            if m[1]:
                builder.end(tag)
                continue
            builder.start(tag, m[3])
            if tag in RAW:
                at = _raw_end(html, at, tag)
                builder.end(tag)
            continue
        if html.startswith("<!--", lt):
            if html.startswith((">", "->"), lt + 4):
                at = html.find(">", lt) + 1
                continue
            done = COMMENT_END.search(html, lt + 4)
            at = done.end() if done else size
        elif lt + 1 < size and html[lt + 1] in "!?/":
            done = html.find(">", lt)
            at = done + 1 if done >= 0 else size
        elif lt + 1 < size and html[lt + 1].isascii() and html[lt + 1].isalpha():
            at = size  # a tag that does not end
        else:
            builder.text("<")
            at = lt + 1
    return builder.tree


_RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.IGNORECASE) for tag in RAW}


def _raw_end(html: str, at: int, tag: str) -> int:
    """Behind the end tag of a raw text element; the end of the page if there is none."""
    m = None if tag == "plaintext" else _RAW_ENDS[tag].search(html, at)
    return m.end() if m else len(html)
