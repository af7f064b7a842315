"""Main text of web pages, with the parts a site repeats on many of its pages removed."""

from __future__ import annotations

import hashlib
import re
import sys
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.common import per_text, ship, sliced, table
from tillmark.session import materialised

ship(sys.modules[__name__])

#: A subtree is a site's template if so many of the site's different pages have it, however large the site.
MANY = 10

# Elements of HTML by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split())
DROPPED = frozenset(
    "aside audio button canvas datalist dialog footer head iframe input label legend menu nav noscript object script search "
    "select style svg template textarea title video".split())
CLOSE_P = BLOCKS - frozenset("br body caption head html legend li optgroup option summary tbody td tfoot th thead tr".split())
#: What an opening tag ends, if open inside the nearest of the second set.
ENDS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
        "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select datalist")}
ENDS = {tag: (frozenset(ended.split()), frozenset(within.split())) for tag, (ended, within) in ENDS.items()}
#: Words of class names, ids and roles that mark what is not the article; a name counts if all its words are of these or
#: say nothing by themselves.
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent contentinfo "
    "cookie cookies disqus disclaimer footer masthead menu modal nav navbar navigation newsletter notice notices notification "
    "outbrain pager pagination paywall popup promo promoted promotion related recommended search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe subscription taboola toolbar widget".split())
NEUTRAL = frozenset(
    "area bar block bottom box buttons container content global inner item left links list main outer page post posts primary "
    "right row secondary section site top wrap wrapper".split())
MAIN = frozenset(("article", "main"))
SEPARATORS = re.compile(r"[-_:.]+")
#: Subtrees that may be a template even inside the article; paragraphs, headings and inline parts of it are its own words.
PARTS = frozenset("aside center details dl div fieldset figure footer form header menu nav ol section table ul".split())

HEAD = frozenset("base link meta noscript script style template title".split())
CUT_OFF = re.compile(r"<[a-zA-Z/!?]")


def marked(names: str) -> bool:
    """Whether one of the names, such as ``site-footer``, says that an element is not the article; ``no-sidebar`` does not."""
    for name in names.split():
        words = [w for w in SEPARATORS.split(name) if w]
        if not MARKED.isdisjoint(words) and all(w in MARKED or w in NEUTRAL for w in words):
            return True
    return False


class _Element:
    """An open element: what drops it (its kind for good, or as many names around it), whether it is in the article, its text so far."""

    __slots__ = ("tag", "hard", "soft", "inner", "number", "digest")

    def __init__(self, tag: str, hard: bool, soft: int, inner: bool, number: int, head: str) -> None:
        self.tag, self.hard, self.soft, self.inner, self.number = tag, hard, soft, inner, number
        self.digest = None if hard else hashlib.blake2b(head.encode("utf-8", "surrogatepass"), digest_size=8)


class Page(HTMLParser):
    """The text blocks of a page that are not dropped by an element's kind or names, in time linear in the page.

    ``blocks`` holds (in the article, names that drop it, text, number of its element), ``parents`` the number of the
    element around each, and ``subtrees`` the hash of each subtree that may be a template by its number.  A
    tag cut off by the end of the page is no text; elements left open end with it.
    """

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.open = [_Element("", False, 0, False, 0, "")]
        self.depths: dict[str, list[int]] = {}
        self.block_depths: list[int] = []
        self.blocks: list[tuple[bool, int, str, int]] = []
        self.pieces: list[str] = []
        self.parents = [-1]
        self.subtrees: dict[int, int] = {}
        self.article = False
        # Only after the last ">" can a tag be cut off.
        cut = CUT_OFF.search(html, html.rfind(">") + 1)
        self.feed(html[:cut.start()] if cut else html)
        self.close()
        self._flush()
        self._end_from(1)

    def _flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        self.pieces = []
        if text:
            top = self.open[-1]
            self.blocks.append((top.inner, top.soft, text, top.number))

    def _depth(self, tags: frozenset | tuple) -> int:
        """Depth of the innermost open element of these tags; 0 if there is none."""
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)

    def _end_from(self, depth: int) -> None:
        """End the open elements from this depth on, the innermost first."""
        while len(self.open) > depth:
            element = self.open.pop()
            self.depths[element.tag].pop()
            if element.tag in BLOCKS:
                self.block_depths.pop()
            if element.digest is None:
                continue
            digest = element.digest.digest()
            # What names drop does not count for the subtrees around it.
            if self.open[-1].digest and element.soft <= self.open[-1].soft:
                self.open[-1].digest.update(digest)
            if element.tag in (PARTS if element.inner else BLOCKS) and element.tag not in MAIN and element.tag != "body":
                self.subtrees[element.number] = int.from_bytes(digest, "little", signed=True)

    def _end_nearest(self, ended: frozenset | tuple, within: frozenset | tuple) -> None:
        """End the nearest open element of ``ended``, unless one of ``within`` is nearer."""
        depth = self._depth(ended)
        if depth and self._depth(within) < depth:
            self._end_from(depth)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self._flush()
        if tag not in HEAD and self.depths.get("head") and self.block_depths[-1] == self.depths["head"][-1]:
            self._end_from(self.block_depths[-1])
        if tag in CLOSE_P and self.depths.get("p"):
            self._end_nearest(("p",), ("td", "th", "table", "button", "object"))
        if tag in ENDS:
            self._end_nearest(*ENDS[tag])
        top = self.open[-1]
        if tag in VOID:
            return
        hard = top.hard or tag in DROPPED or (tag == "header" and not top.inner)
        names, soft = "", top.soft
        if attrs and not hard:
            values = {k: v or "" for k, v in attrs}
            names = " ".join(values.get(k, "") for k in ("class", "id", "role")).lower()
            hard = ("hidden" in values or values.get("aria-hidden") == "true"
                    or "display:none" in values.get("style", "").replace(" ", ""))
        # A form may be around all of a page, so it goes like a part with a name.
        soft += tag not in ("html", "body") and (tag == "form" or marked(names))
        inner = not hard and (top.inner or tag in MAIN)
        if inner and not self.article:
            # The first article counts whatever it and what is around it are called.
            self.article, soft = True, 0
        self.parents.append(top.number)
        self.depths.setdefault(tag, []).append(len(self.open))
        if tag in BLOCKS:
            self.block_depths.append(len(self.open))
        self.open.append(_Element(tag, hard, soft, inner, len(self.parents) - 1, f"<{tag} {SEPARATORS.sub(' ', names)}>"))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
        if not self.depths.get(tag):
            return
        depth = self.depths[tag][-1]
        # An inline element's end does not reach out of the block it stands in, a block's not out of its table cell.
        if tag in BLOCKS:
            wall = 0 if tag in ("table", "tr", "tbody", "thead", "tfoot", "body", "html") else self._depth(("td", "th", "table"))
        else:
            wall = self.block_depths[-1] if self.block_depths else 0
        if wall <= depth:
            self._end_from(depth)

    def handle_data(self, data: str) -> None:
        top = self.open[-1]
        if top.digest:
            self.pieces.append(data)
            top.digest.update(data.encode("utf-8", "surrogatepass"))

    def content(self) -> list[tuple[str, int]]:
        """Text and element of the article's blocks or, if no article has text, of all; those under the fewest dropping names."""
        found = [b for b in self.blocks if b[0]] or self.blocks
        fewest = min((soft for _, soft, _, _ in found), default=0)
        return [(text, number) for _, soft, text, number in found if soft == fewest]

    def outline(self) -> tuple[list[str], list[int], list[int], list[int]]:
        """Texts of the content, the nearest possible template around each, and the parents and hashes of those (-1: none)."""
        content = self.content()
        near, parents, hashes = [-1] * len(self.parents), [], []
        for number in range(1, len(self.parents)):
            near[number] = near[self.parents[number]]
            if number in self.subtrees:
                parents.append(near[number])
                near[number] = len(hashes)
                hashes.append(self.subtrees[number])
        used = [False] * len(hashes)
        for _, number in content:
            at = near[number]
            while at >= 0 and not used[at]:
                used[at], at = True, parents[at]
        # Only subtrees that hold some of the text; a parent comes before its parts.
        number_of = {old: new for new, old in enumerate(i for i, u in enumerate(used) if u)} | {-1: -1}
        return ([t for t, _ in content], [number_of[near[n]] for _, n in content],
                [number_of[parents[i]] for i, u in enumerate(used) if u], [hashes[i] for i, u in enumerate(used) if u])


def without(texts: list[str], places: list[int], parents: list[int], hashes: list[int], gone: frozenset) -> list[str]:
    """The texts outside the subtrees ``gone``.

    If nothing is left, the subtrees with more than half of the text stay, as that is what the page is about;
    if that is nothing either, all do.
    """
    def left(gone: frozenset) -> list[str]:
        out: list[bool] = []
        for parent, found in zip(parents, hashes, strict=True):
            out.append(found in gone or (parent >= 0 and out[parent]))
        return [t for t, at in zip(texts, places, strict=True) if at < 0 or not out[at]]

    if not gone or (kept := left(gone)):
        return kept if gone else texts
    weights = [0] * len(hashes)
    for text, at in zip(texts, places, strict=True):
        if at >= 0:
            weights[at] += len(text)
    total: Counter = Counter()
    for i in range(len(hashes) - 1, -1, -1):
        total[hashes[i]] += weights[i]
        if parents[i] >= 0:
            weights[parents[i]] += weights[i]
    half = sum(map(len, texts)) / 2
    return left(frozenset(h for h in gone if total[h] <= half)) or texts


def host_of(url: str = "url") -> Column:
    """The host of a URL in lower case, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _outlines(pages: DataFrame, row: Column) -> DataFrame:
    """Every page once parsed: ``row``, ``host``, ``page`` and ``content`` (digests of html and text), and its outline."""
    def run(texts: pa.Array) -> list[pa.Array]:
        found = [Page(t or "").outline() for t in texts.to_pylist()]
        digests = (hashlib.blake2b("\n".join(f[0]).encode("utf-8", "surrogatepass"), digest_size=8).digest() for f in found)
        return [pa.array([f[0] for f in found], pa.list_(pa.string())), *[pa.array([f[i] for f in found], pa.list_(pa.int32())) for i in (1, 2)],
                pa.array([f[3] for f in found], pa.list_(pa.int64())),
                pa.array([int.from_bytes(d, "little", signed=True) for d in digests], pa.int64())]

    keyed = pages.select(row.alias("row"), host_of().alias("host"), F.col("html").alias("text"),
                         F.md5(F.coalesce(F.col("html"), F.lit("")).cast("binary")).alias("page"))
    return materialised(per_text(
        keyed, "texts array<string>, places array<int>, parents array<int>, subtrees array<bigint>, content bigint", run), "outlines")


def _templates(found: DataFrame, many: int) -> DataFrame:
    return found.select("host", "content", F.explode("subtrees").alias("subtree")).distinct().groupBy("host", "subtree").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= many).select("host", "subtree")


def site_templates(pages: DataFrame, many: int = MANY) -> DataFrame:
    """``host`` and ``subtree``, the hash of a subtree that ``many`` different pages of the host have, whatever the host's size.

    Pages with equal text count once, so a mirrored article is no template.  A host may have any number of templates.
    """
    return _templates(_outlines(pages, F.lit(0)), many)


def main_text(pages: DataFrame, many: int = MANY) -> DataFrame:
    """``pages`` without its html, with ``text`` (empty if there is none) and ``n_chars`` (code points).

    The text is that of the article or main element, else of the whole page, without menus, headers,
    footers, sidebars, notices, adverts, forms, scripts, styles and comments,
    which are known by their elements and names, and without subtrees that the host repeats on many of its
    pages (see :func:`site_templates`), however much of a page they are, unless nothing would be left of it.  The names
    of the first article, and of what is around it, do not count, and if names would drop all text, the text under the
    fewest of them stays.  Blocks are in page order, one a line; white space inside a block is one space.

    Null html counts as empty; null and odd URLs share the empty host.  Repeated rows
    get equal results; other columns pass through, but for such named text or n_chars; no
    rows give no rows.  Very long and deeply nested pages take time in proportion to their length.
    """
    found = _outlines(pages, F.struct(*[F.col(c) for c in pages.columns if c.lower() not in ("html", "text", "n_chars")]))
    templates = materialised(_templates(found, many), "templates")
    # What goes from a page is joined to its own subtrees, so no list grows with the host.
    gone = materialised(
        found.select("host", "page", F.explode("subtrees").alias("subtree")).join(templates, ["host", "subtree"])
        .groupBy("host", "page").agg(F.collect_set("subtree").alias("templates")), "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            columns = [batch.column(c).to_pylist() for c in ("texts", "places", "parents", "subtrees", "templates")]
            texts = ["\n".join(without(*outline, frozenset(gone or ()))) for *outline, gone in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["row", "text", "n_chars"])

    kept = found.join(gone, ["host", "page"], "left").select("row", "texts", "places", "parents", "subtrees", "templates")
    schema = kept.select("row").schema.add("text", "string").add("n_chars", "long")
    return kept.mapInArrow(run, schema).select("row.*", "text", "n_chars")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
