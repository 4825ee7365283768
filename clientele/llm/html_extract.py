"""Main text of web pages by tree scoring.

Paragraphs pass points for their length and commas to their ancestors, which are discounted by the
share of their text that stands in links. The best container and those of its siblings that score too
are kept, without the parts that are no article text.
"""

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.llm.html_tree import BLOCKS, HEADINGS, RAW, Tree, parse

# Elements, roles and names of parts that are no article text.
NO_TEXT = RAW | frozenset(
    "aside nav footer menu dialog form button select option optgroup textarea input datalist progress meter "
    "fieldset legend object embed applet svg math canvas audio video map head frameset".split()
)
NO_TEXT_ROLES = frozenset(
    "navigation contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split()
)
#: Words of a class or id; two neighbours also count joined, so side-bar and sideBar are sidebar.
NO_TEXT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adbox adslot adsense banner banners "
    "promo promos promotion promoted sponsor sponsors sponsored outbrain taboola "
    "cookie cookies consent gdpr ccpa notice notices notification notifications popup modal overlay paywall "
    "subscribe subscription newsletter signup signin login register "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs crumbs toolbar topbar pager pagination "
    "header masthead footer colophon copyright sidebar sidenav aside rail widget widgets "
    "related recommended recommendations trending popular share sharing social follow "
    "comment comments commentlist disqus respond replies reply discussion search searchform skip tagcloud".split()
)
#: `has-sidebar` names a page with one, not the sidebar.
ABOUT = frozenset("has with no without show hide hidden enable disable open closed".split())
GOOD_NAMES = frozenset("article content main body entry hentry post story text blog".split())
TAG_POINTS = {"div": 5, "article": 10, "main": 10, "section": 3, "pre": 3, "td": 3, "blockquote": 3} | dict.fromkeys(
    "address ol ul dl dd dt li form".split(), -3
) | dict.fromkeys("h1 h2 h3 h4 h5 h6 th".split(), -5)
NAME_POINTS = 25
#: A paragraph has at least so many characters; one point for each comma and each further hundred.
LEAST_CHARS, CHARS_POINT, MOST_FOR_CHARS = 25, 100, 3
COMMAS = re.compile("[,،、，]")
#: Ancestors that get points: all of the first, half, a sixth, a ninth, ...
LEVELS = 5
#: A sibling is kept from this share of the best score, and at least so many points.
SIBLING_SHARE, SIBLING_LEAST = 0.2, 10.0
#: Inside the container, a list or box is a menu if so much of its text is links, and so many of them.
MENU_SHARE, MENU_LINKS = 0.75, 3
MENUS = frozenset("ul ol dl div section table".split())
#: Articles, or main parts, go first if they hold this share of the page's text.
MARKED_SHARE = 0.25
#: Characters of text after which a batch of results is handed on.
BATCH_CHARS = 4 << 20

WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
SENTENCE_END = re.compile(r"[.!?。؟][\"')\]»”]*$")


def names_of(attributes: dict[str, str]) -> list[set[str]]:
    """The words of each class and of the id."""
    out = []
    for name in (attributes.get("class", "") + " " + attributes.get("id", "")).split():
        words = [w.lower() for w in WORD.findall(name)]
        pairs = [a + b for a, b in zip(words, words[1:])]
        out.append(set() if ABOUT & set(words) else {*words, *pairs})
    return out


class Page:
    """The scores of one page."""

    def __init__(self, tree: Tree):
        self.tree = tree
        self.size = len(tree.tags)
        self.depth = [0] * self.size
        for n in range(1, self.size):
            self.depth[n] = self.depth[tree.parents[n]] + 1
        self._find_names()
        self._mark_no_text()
        self._gather()

    def _find_names(self) -> None:
        self.named = [0] * self.size  # -1: no article text by its name, 1: article text by its name
        for n, attributes in enumerate(self.tree.attributes):
            if "class" in attributes or "id" in attributes:
                names = names_of(attributes)
                if any(words & NO_TEXT_NAMES for words in names):
                    self.named[n] = -1
                elif any(words & GOOD_NAMES for words in names):
                    self.named[n] = 1

    def _holders(self, nodes: list[int]) -> set[int]:
        """Ancestors of the nodes."""
        found: set[int] = set()
        for n in nodes:
            n = self.tree.parents[n]
            while n >= 0 and n not in found:
                found.add(n)
                n = self.tree.parents[n]
        return found

    def _mark_no_text(self) -> None:
        """gone[n]: element n is no article text, or within one that is not."""
        tree, tags = self.tree, self.tree.tags
        # the page's own parts say more than the name of a box around them
        tops = [n for n in range(self.size) if tags[n] in ("h1", "main")]
        articles = [n for n in range(self.size) if tags[n] == "article" and self.named[n] >= 0]
        spared = self._holders(tops)
        boxed = [any(self.named[a] < 0 for a in self._line(n)) for n in articles]
        if not tops and all(boxed):
            spared |= self._holders(articles)
        chars = [0] * self.size
        for text, n in zip(tree.texts, tree.nodes):
            chars[n] += len(text)
        for n in range(self.size - 1, 0, -1):
            chars[tree.parents[n]] += chars[n]
        self.gone = [False] * self.size
        for n in range(1, self.size):
            if self.gone[tree.parents[n]]:
                self.gone[n] = True
                continue
            tag, attributes = tags[n], tree.attributes[n]
            if tag in ("html", "body", "main"):
                continue
            if tag == "form" and 2 * chars[n] > chars[0]:
                continue  # around the whole page
            self.gone[n] = (
                tag in NO_TEXT
                or "hidden" in attributes
                or attributes.get("aria-hidden") == "true"
                or attributes.get("role") in NO_TEXT_ROLES
                or bool(HIDDEN.search(attributes.get("style", "")))
                or (self.named[n] < 0 and n not in spared and tag not in HEADINGS)
                or (tag == "header" or attributes.get("role") == "banner")
                and not any(tags[a] in ("article", "main") for a in self._line(n))
            )

    def _line(self, n: int) -> Iterator[int]:
        """The ancestors of an element, nearest first."""
        n = self.tree.parents[n]
        while n > 0:
            yield n
            n = self.tree.parents[n]

    def _gather(self) -> None:
        """Texts of blocks, without what is gone; characters and links by element."""
        tree = self.tree
        parts: list[list[str]] = [[] for _ in tree.owner]
        linked = [0] * len(tree.owner)
        self.chars, self.link_chars, self.link_count = ([0] * self.size for _ in range(3))
        for text, n, block, link in zip(tree.texts, tree.nodes, tree.blocks, tree.links):
            if not self.gone[n]:
                parts[block].append(text)
                if link:
                    linked[block] += len(text.strip())
        self.block_texts = [" ".join("".join(p).split()) for p in parts]
        self.direct = [0] * self.size
        for owner, text, links in zip(tree.owner, self.block_texts, linked):
            self.chars[owner] += len(text)
            self.link_chars[owner] += min(links, len(text))
            self.direct[owner] += bool(text)
        self.has_blocks = [False] * self.size
        for n in range(self.size - 1, 0, -1):
            parent = tree.parents[n]
            self.link_count[n] += tree.tags[n] == "a" and not self.gone[n]
            self.chars[parent] += self.chars[n]
            self.link_chars[parent] += self.link_chars[n]
            self.link_count[parent] += self.link_count[n]
            self.has_blocks[parent] |= tree.tags[n] in BLOCKS or self.has_blocks[n]

    def link_share(self, n: int) -> float:
        return self.link_chars[n] / self.chars[n] if self.chars[n] else 0.0

    def scores(self) -> dict[int, float]:
        """Points of the elements that paragraphs pass points to, discounted by their links."""
        tree, points = self.tree, {}
        for owner, text in zip(tree.owner, self.block_texts):
            if len(text) < LEAST_CHARS or tree.tags[owner] in HEADINGS:
                continue
            own = 1 + len(COMMAS.findall(text)) + min(len(text) // CHARS_POINT, MOST_FOR_CHARS)
            # text beside other blocks makes a paragraph of its own
            n = owner if self.has_blocks[owner] else tree.parents[owner]
            for level in range(LEVELS):
                if n <= 0:
                    break
                if n not in points:
                    points[n] = TAG_POINTS.get(tree.tags[n], 0) + NAME_POINTS * max(self.named[n], 0)
                points[n] += own / (1 if level == 0 else 2 if level == 1 else 3 * level)
                n = tree.parents[n]
        return {n: p * (1 - self.link_share(n)) for n, p in points.items()}

    def within(self, roots: set[int]) -> list[bool]:
        inside = [n in roots for n in range(self.size)]
        for n in range(1, self.size):
            inside[n] |= inside[self.tree.parents[n]]
        return inside

    def container(self, scores: dict[int, float]) -> int:
        """The best element; an article or main part around it stands for it."""
        tags = self.tree.tags
        pool = scores
        for tag in ("article", "main"):
            marked = {n for n in range(self.size) if tags[n] == tag and not self.gone[n] and self.chars[n]}
            outer = {n for n in marked if not any(a in marked for a in self._line(n))}
            if outer and sum(self.chars[n] for n in outer) >= MARKED_SHARE * self.chars[0]:
                inside = self.within(outer)
                pool = {n: s for n, s in scores.items() if inside[n]}
                if not pool:
                    return max(sorted(outer), key=lambda n: self.chars[n])
                break
        if not pool:
            return next((n for n in range(self.size) if tags[n] == "body"), 0)
        best = max(sorted(pool), key=pool.get)
        if tags[best] in ("article", "main"):
            return best
        for n in self._line(best):
            if tags[n] == "article" or (tags[n] == "main" and self.chars[n] <= 2 * self.chars[best]):
                return n
        return best

    def kept_with(self, best: int, scores: dict[int, float]) -> set[int]:
        """The container, its siblings that score or read like text, and headings that lead to them."""
        tree, parent = self.tree, self.tree.parents[best]
        kept = {best}
        if best == 0 or parent <= 0:
            return kept
        least = max(SIBLING_LEAST, SIBLING_SHARE * scores.get(best, 0.0))
        marked = tree.tags[best] in ("article", "main")
        siblings = [n for n in range(1, self.size) if tree.parents[n] == parent and not self.gone[n]]
        texts = self._texts_of(siblings)
        for n in siblings:
            if n == best or (marked and tree.tags[n] != tree.tags[best]):
                continue
            same = tree.attributes[best].get("class") and tree.attributes[n].get("class") == tree.attributes[best]["class"]
            bonus = SIBLING_SHARE * scores.get(best, 0.0) if same else 0.0
            share = self.link_share(n)
            if n in scores and scores[n] + bonus >= least:
                kept.add(n)
            elif tree.tags[n] == "p" and not self.has_blocks[n]:
                if self.chars[n] > 80 and share < 0.25 or share == 0 and SENTENCE_END.search(texts[n]):
                    kept.add(n)
        first = min(kept)
        for n in reversed([s for s in siblings if s < first]):
            if tree.tags[n] not in HEADINGS and tree.tags[n] != "hgroup":
                break
            kept.add(n)
        return kept

    def _texts_of(self, nodes: list[int]) -> dict[int, str]:
        own: dict[int, str] = dict.fromkeys(nodes, "")
        for owner, text in zip(self.tree.owner, self.block_texts):
            if owner in own:
                own[owner] += text
        return own

    def main_text(self) -> str:
        scores = self.scores()
        best = self.container({n: s for n, s in scores.items() if not self.gone[n]})
        kept = self.kept_with(best, scores)
        inside = self.within(kept)
        menu = [False] * self.size
        for n in range(1, self.size):
            menu[n] = menu[self.tree.parents[n]] or (
                n not in kept
                and self.tree.tags[n] in MENUS
                and self.link_count[n] >= MENU_LINKS
                and self.link_share(n) > MENU_SHARE
            )
        texts = zip(self.tree.owner, self.block_texts)
        return "\n\n".join(t for n, t in texts if t and inside[n] and not menu[n])


def main_text(html: str) -> str:
    """The article of a page; see `extract_text`."""
    return Page(parse(html)).main_text() if html else ""


def _job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, html = batch.column("row"), batch.column("html")
        done, texts, chars = 0, [], 0
        for k, value in enumerate(html):
            texts.append(main_text(value.as_py() or ""))
            chars += len(texts[-1])
            if chars >= BATCH_CHARS or k == len(html) - 1:
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(done, len(texts)), pa.array(texts, pa.string())], ["row", "main_text"]
                )
                done, texts, chars = k + 1, [], 0


def extract_text(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """The main text of each page.

    Adds `text` and n_chars (long, its code points); input columns of these names give way, and the
    html column is left out. Left out of the text are elements that are no article text by their tag,
    role, class or id, that are hidden, and boxes of links. Of the rest, the best container is kept
    with its scoring siblings and the headings before it; of a page where nothing scores, its article,
    main part or body. Blocks are joined in page order by an empty line. Character references are
    decoded once; any white space within a block, line breaks and no-break spaces included, is one
    space; two line breaks in a row end a block.

    A null or empty page, or one without article text, gives an empty text. Nothing is cut: a page of
    any length is taken whole, in time linear in its length. Repeated rows get equal results. No pages
    give no rows.
    """
    names = (text.lower(), "n_chars", html.lower())
    others = [c for c in pages.columns if c.lower() not in names]
    packed = pages.select(
        F.struct(F.lit(0).alias("_"), *[pages[f"`{c}`"] for c in others]).alias("row"), pages[html].alias("html")
    )
    schema = T.StructType([packed.schema["row"], T.StructField("main_text", T.StringType())])
    out = packed.mapInArrow(_job, schema)
    return out.select(
        *[F.col("row").getField(c).alias(c) for c in others],
        F.col("main_text").alias(text),
        F.char_length("main_text").cast("long").alias("n_chars"),
    )
