"""Main text of web pages by composite text density."""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript iframe template textarea title svg object".split())
# Of these, the ones that hold markup: without an end tag they do not run to the end of the page.
_MARKUP = frozenset("template svg object".split())
_NEVER = frozenset("button select option label dialog head annotation annotation-xml".split())
# Left out unless they hold most of the text; the first may be laid around the whole page.
_FORMS = frozenset("form fieldset".split())
_ASIDE = _FORMS | frozenset("nav footer aside menu".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table"
    " tbody tfoot thead tr ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# A start tag ends an open element of these, unless one of the others lies between.
_ENDS = {
    "li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}),
    "tr": ("tr", {"table"}), "td": ("td th", {"table", "tr"}), "th": ("td th", {"table", "tr"}),
    "option": ("option", {"select"}),
}
# Words of class, id and role that mark menus and other parts beside the text.
_LAYOUT = frozenset(
    "banner nav navbar navigation menu breadcrumb breadcrumbs sidebar footer header masthead share sharing"
    " social pagination pager widget widgets toolbar search complementary contentinfo toc".split()
)
# Words that mark adverts and notices, which may be longer than the text.
_NOTICES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent"
    " notice notices alert popup modal newsletter subscribe signup login".split()
)
_HINTS = _LAYOUT | _NOTICES
# Words of parts that may hold articles of others.
_OTHERS = frozenset("comment comments reply replies disqus related recommended".split())
# Whole names of parts around a text that give no part of it.
_PARTS = frozenset(
    "share-buttons social-buttons author-box author-bio author-card about-author post-tags entry-tags article-tags"
    " tag-list tags-list tag-cloud tags read-more".split()
)
# Words that may stand beside these in one name; any other word makes it the name of something else.
_BESIDE = frozenset(
    "site main global primary secondary top bottom left right box bar list item items block container wrapper"
    " inner".split()
)
_BESIDE_OTHERS = _BESIDE | _HINTS | frozenset(
    "post posts article articles story stories news content body text thread section area reader readers user form"
    .split()
)
# An element so marked is part of the text all the same if it holds more than such a share of the
# page's text outside links. Where an article is marked elsewhere, the layout must hold nearly all,
# and what is no layout is never part of the text.
_MOST, _NEARLY_ALL = 0.5, 0.9
# A closing part of so many characters at most, which claims rights.
_IMPRINT_CHARS = 200
_IMPRINT = re.compile(r"^(copyright\b|©|\(c\)\s*\d{4})|all rights reserved\W*$", re.IGNORECASE)
# Quotes count only after "=", and only if they are closed.
_TAG = re.compile(
    r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)|=)*+)>"""
)
_LOOSE_TAG = re.compile("<(/?)([a-zA-Z][^\\s/>]*+)([^>]*+)>")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE | re.ASCII) for name in _RAW}
_CLASS = re.compile(r"""(?:^|\s)class\s*=\s*("[^"]*"|'[^']*'|[^\s>]*)""", re.IGNORECASE)
_MARKING = re.compile("class|id|role|hidden|style", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"""([^\s=/>]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?""")
_WORD = re.compile("[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


class Page:
    """The elements of a page in order, each with the run of text items that it spans."""

    def __init__(self, source: str):
        self.tags, self.parents, self.first, self.last = ["html"], [-1], [0], [0]
        self.dropped = [False]
        self._names = [("html", "")]  # tag and class
        self._by_word: set[int] = set()  # dropped only for what may be the page's layout
        self._beside: set[int] = set()  # dropped unless they hold nearly all of the text
        self._layout: set[int] = set()  # of these, dropped unless they hold most of it
        self.items: list[tuple[int, str]] = []  # element and text; an empty text parts blocks
        self._open, self._counts = [0], Counter(["html"])
        self._parse(source)
        while self._open:
            self._close()
        self._spare()

    def _close(self) -> None:
        node = self._open.pop()
        self._counts[self.tags[node]] -= 1
        self.last[node] = len(self.items)
        if self.tags[node] in _BLOCK:
            self.items.append((node, ""))

    def _start(self, tag: str, attributes: str) -> None:
        if tag in _BLOCK:
            self._end("p", {"table", "button", "object"})
        if tag in _ENDS:
            for other in _ENDS[tag][0].split():
                self._end(other, _ENDS[tag][1])
        if tag == "br":
            self.items.append((self._open[-1], " "))
        if tag in _BLOCK:
            self.items.append((self._open[-1], ""))
        if tag in _VOID:
            return
        if tag in ("td", "th"):
            self.items.append((self._open[-1], " "))
        node = len(self.tags)
        self.tags.append(tag)
        self.parents.append(self._open[-1])
        self.first.append(len(self.items))
        self.last.append(0)
        self.dropped.append(self._is_extra(tag, attributes))
        named = _CLASS.search(attributes)
        self._names.append((tag, named[1] if named else ""))
        self._open.append(node)
        self._counts[tag] += 1

    def _end(self, tag: str, within: frozenset | set = frozenset()) -> None:
        if not self._counts[tag]:
            return
        for depth in range(len(self._open) - 1, 0, -1):
            found = self.tags[self._open[depth]]
            if found == tag:
                while len(self._open) > depth:
                    self._close()
                return
            if found in within:
                return

    def _is_extra(self, tag: str, attributes: str) -> bool:
        if tag in _NEVER:
            return True
        extra = tag in _ASIDE or tag == "header" and not self._counts["article"] and not self._counts["main"]
        layout, notice = not extra or tag in _FORMS, False
        if tag in ("html", "body", "main") or not _MARKING.search(attributes):
            found = []
        else:
            found = _ATTRIBUTE.findall(attributes)
        for name, value in found:
            value, name = value.strip("\"'"), name.lower()
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if name == "style":
                if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                    return True
            elif name in ("class", "id", "role"):
                for token in value.split():
                    words = {word.lower() for word in _WORD.findall(token)}
                    if "-".join(_WORD.findall(token)).lower() in _PARTS:
                        extra = True
                    if words & _OTHERS and words <= _OTHERS | _BESIDE_OTHERS:
                        extra, layout = True, False
                    elif words & _HINTS and words <= _HINTS | _BESIDE:
                        extra, notice = True, notice or bool(words & _NOTICES)
        if extra:
            node = len(self.tags) - 1
            self._beside.add(node)
            if layout:
                self._by_word.add(node)
            if layout and not notice:
                self._layout.add(node)
        return extra

    def _parse(self, source: str) -> None:
        at, size, pattern = 0, len(source), _TAG
        while at < size:
            opening = source.find("<", at)
            if opening < 0:
                opening = size
            if opening > at:
                self.items.append((self._open[-1], entities.unescape(source[at:opening])))
            if opening == size:
                return
            at = opening
            following = source[at + 1 : at + 2]
            named = source[at + 2 : at + 3] if following == "/" else following
            if source.startswith("<!--", at):
                end = source.find("-->", at + 2)
                at = size if end < 0 else end + 3
            elif named.isascii() and named.isalpha():
                tag = pattern.match(source, at)
                if not tag:
                    # All that is left counts as quoted; from here on, tags end at the next ">".
                    pattern = _LOOSE_TAG
                    tag = pattern.match(source, at)
                if not tag:
                    return  # a tag that the page breaks off in
                at, name = tag.end(), tag[2].lower()
                if tag[1]:
                    self._end(name)
                elif name in _RAW:
                    if name == "svg" and tag[3].endswith("/"):
                        continue
                    closing = _RAW_END[name].search(source, at)
                    end = source.find(">", closing.end()) if closing else -1
                    if end >= 0 or name not in _MARKUP:
                        at = size if end < 0 else end + 1
                else:
                    self._start(name, tag[3])
            elif following in ("!", "?") or following == "/" and named:
                end = source.find(">", at)
                at = size if end < 0 else end + 1
            else:
                self.items.append((self._open[-1], "<"))
                at += 1

    def _links(self) -> list[bool]:
        in_link = [False] * len(self.tags)
        for node in range(1, len(self.tags)):
            in_link[node] = in_link[self.parents[node]] or self.tags[node] == "a"
        return in_link

    def _spare(self) -> None:
        """An element is no extra when it holds most of the text, or, by mark of layout, an article."""
        n = len(self.tags)
        if self._beside:
            in_link, hidden, apart, marked = self._links(), [False] * n, [False] * n, [False] * n
            for node in range(1, n):
                up, dropped = self.parents[node], self.dropped[node]
                hidden[node] = hidden[up] or dropped and node not in self._beside
                apart[node] = apart[up] or dropped and node not in self._by_word
                marked[node] = not apart[node] and (marked[up] or self.tags[node] in ("article", "main"))
            chars, in_marked = [0] * n, [0] * n
            for node, text in self.items:
                if not hidden[node] and not in_link[node]:
                    count = len(" ".join(text.split()))
                    chars[node] += count
                    in_marked[node] += count * marked[node]
            for node in range(n - 1, 0, -1):
                chars[self.parents[node]] += chars[node]
                in_marked[self.parents[node]] += in_marked[node]
            for node in self._beside:
                elsewhere = in_marked[0] > in_marked[node]
                if elsewhere and node not in self._layout:
                    continue
                share = _MOST if node in self._layout and not elsewhere else _NEARLY_ALL
                if chars[node] > share * chars[0]:
                    self.dropped[node] = False
        for node, tag in enumerate(self.tags):
            if tag in ("article", "main") and not self.dropped[node]:
                up = self.parents[node]
                while up >= 0:
                    if up in self._by_word:
                        self.dropped[up] = False
                    up = self.parents[up]
        for node in range(1, n):
            self.dropped[node] = self.dropped[node] or self.dropped[self.parents[node]]

    def densities(self) -> list[float]:
        """Composite text density of each element: link-adjusted characters for each tag."""
        n = len(self.tags)
        chars, link_chars, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        in_link = self._links()
        for node, text in self.items:
            if not self.dropped[node]:
                count = len(" ".join(text.split()))
                chars[node] += count
                link_chars[node] += count * in_link[node]
        for node in range(n - 1, 0, -1):
            up = self.parents[node]
            if not self.dropped[node]:
                chars[up] += chars[node]
                link_chars[up] += link_chars[node]
                tags[up] += tags[node] + 1
                link_tags[up] += link_tags[node] + (self.tags[node] == "a")
        share = link_chars[0] / max(chars[0], 1)
        result = []
        for node in range(n):
            c, links = chars[node], link_chars[node]
            if not c or self.dropped[node]:
                result.append(0.0)
                continue
            base = math.log(c / max(c - links, 1) * links + share * c + math.e)
            inner = c / max(links, 1) * max(tags[node], 1) / max(link_tags[node], 1)
            logarithm = math.log(max(inner, 1.0)) / math.log(base) if base > 1.0 + 1e-9 else math.log(max(inner, 1.0))
            result.append(c / max(tags[node], 1) * logarithm)
        return result

    def main_text(self) -> str:
        """Blocks of the subtree with the largest sum of child densities, and of its like."""
        density = self.densities()
        sums = [0.0] * len(self.tags)
        for node in range(1, len(self.tags)):
            sums[self.parents[node]] += density[node]
        best = max(range(len(sums)), key=lambda node: (sums[node], -node))
        path = [best]
        while self.parents[path[-1]] >= 0:
            path.append(self.parents[path[-1]])
        # The path to the body gives the density that other parts need; extras are out already.
        least = min((density[node] for node in path if density[node] > 0), default=0.0)
        chars, free = self._link_free()
        mostly_text = [2 * own > all_of for own, all_of in zip(free, chars)]
        self._drop_links_alone(chars, free)
        inside = [node for node in path if self.tags[node] in ("article", "main")]
        if inside:
            parts = self._articles_beside(inside[0], path)
            parts = [node for node in parts if density[node] >= least and mostly_text[node]]
            return "\n".join(filter(None, (self._text(node, None) for node in sorted([inside[0], *parts]))))
        around = self.parents[best]
        whole = around > 0 and self.tags[around] != "body"
        kept = [False] * len(self.tags)
        on_path = set(path)
        for node in range(len(self.tags)):
            up = self.parents[node]
            # Beside the densest part, text is text however short; elsewhere it must be as dense.
            beside = up >= 0 and up == around and (whole or self._names[node] == self._names[best]) and mostly_text[node]
            kept[node] = (
                node in on_path or up >= 0 and (kept[up] and up not in on_path or up == best) or beside
                or up in on_path and (density[node] >= least or self.tags[node] in _HEADINGS)
                or self.tags[node] == "h1"
            )
            if up in on_path and node not in on_path and node > best and self._is_imprint(node, chars[node]):
                kept[node] = False
        return self._text(0, kept)

    def _link_free(self) -> tuple[list[int], list[int]]:
        """Characters of each element, and those outside links."""
        chars, free, in_link = [0] * len(self.tags), [0] * len(self.tags), self._links()
        for node, text in self.items:
            if not self.dropped[node]:
                count = len("".join(text.split()))
                chars[node] += count
                free[node] += count * (not in_link[node])
        for node in range(len(self.tags) - 1, 0, -1):
            chars[self.parents[node]] += chars[node]
            free[self.parents[node]] += free[node]
        return chars, free

    def _drop_links_alone(self, chars: list[int], free: list[int]) -> None:
        """Lists and other parts that hold links and nothing else, no heading either, are menus."""
        heads = [False] * len(self.tags)
        for node in range(len(self.tags) - 1, 0, -1):
            heads[node] = heads[node] or self.tags[node] in _HEADINGS
            heads[self.parents[node]] = heads[self.parents[node]] or heads[node]
        in_link = self._links()
        for node in range(1, len(self.tags)):
            alone = chars[node] and not free[node] and not heads[node] and not in_link[node]
            self.dropped[node] = self.dropped[node] or self.dropped[self.parents[node]] or bool(
                alone and self.tags[node] in ("div", "ul", "ol", "section", "table")
            )

    def _articles_beside(self, root: int, path: list[int]) -> list[int]:
        """The outermost other articles in the ``main``, or else the parent, around the article ``root``."""
        if self.tags[root] != "article":
            return []
        above = path[path.index(root) + 1 :]
        around = next((node for node in above if self.tags[node] == "main"), self.parents[root])
        inner, found = [False] * len(self.tags), []
        for node in range(around + 1, len(self.tags)):
            up = self.parents[node]
            inner[node] = up == around or up > around and inner[up]
            if up > around and self.tags[up] == "article":
                inner[node] = False  # What lies in an article goes with it.
            if inner[node] and self.tags[node] == "article" and node != root and not self.dropped[node]:
                found.append(node)
        return found

    def _is_imprint(self, node: int, chars: int) -> bool:
        """A short closing part that claims rights."""
        if chars > _IMPRINT_CHARS:
            return False
        return bool(_IMPRINT.search(self._text(node, None)))

    def _text(self, root: int, kept: list[bool] | None) -> str:
        lines, parts = [], []
        for node, text in self.items[self.first[root] : self.last[root]] + [(root, "")]:
            if text == "":
                if parts and (line := " ".join("".join(parts).split())):
                    lines.append(line)
                parts = []
            elif not self.dropped[node] and (kept is None or kept[node]):
                parts.append(text)
        return "\n".join(lines)


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``id_col, url_col, text`` for each row of ``pages``, from the whole source.

    Menus, page headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
    comments are left out by element and by the names in their class, id and role, unless they hold
    most of the text outside links (nearly all, for notices and comments). Of the rest,
    the element whose children have the largest sum of composite text density is the article, or
    its enclosing ``article`` or ``main``. Other articles of the same ``main`` belong to the text if
    they hold more text outside links than inside and reach the least density on the path from that
    element to the body. Without such marks, siblings of the element that hold more text outside
    links than inside belong to it (in the body itself, only those of its tag and class), and so do
    other parts beside the path that reach the least density there, headings there and any ``h1``;
    a short closing claim of rights does not. Parts of links alone are menus. Text is decoded, blocks are parted by
    line feeds, white space inside a block is one space. A null or empty source, or one without
    text, gives an empty text. Null and repeated ids are kept; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(source).main_text() if source else "" for source in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["id", "url", "text"]
            )

    given = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    schema = StructType([*given.schema.fields[:2], StructField("text", StringType())])
    found = given.mapInArrow(run, schema)
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text")
