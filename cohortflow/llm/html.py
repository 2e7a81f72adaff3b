"""Main text of pages: element subtrees that recur across a host are its template and go.

A first pass hashes every element subtree (tag, attributes without link targets, text, children) and
counts, per host, on how many pages of different content each hash occurs; a task sums rows and keeps
at most ``MIN_PAGES`` contents of each before anything is shuffled. Pages with equal bodies are copies
and one content. A subtree in ``MIN_PAGES`` contents of its host is template, however many pages the
host has; in ``article`` or ``main`` it has to be on ``MIN_SHARE`` of them too. A second pass joins the
subtrees of each page with the templates, one row each, and groups the hits by page, so no task gets
the list of a whole host. A third one writes the text blocks that lie in none of the page's hits. If
these would take nearly all text of a page, it is a near copy of others, and its text stays.

Elements that are no article text by their tag, role or class (menus, headers and footers of the
page, asides, forms, scripts, adverts, notices, comments) go by that alone, so a page whose host has
too few pages for counting is cleaned too. A class or id counts by whole tokens and known compounds,
and not on an element that wraps the page's article or most of its paragraph text, nor, within an
article, on one that holds most of it (unless it is marked as comments, an advert or the like). If
``article`` and ``main`` elements hold as much text as the paragraphs outside, only text in them counts;
there, a recurring text block (paragraph, heading, list, table ...) stays, since pages may quote the
same passage, and other recurring subtrees go.

Blocks are split at block elements; white space in a block becomes one space; ``br`` is white space.

Edge cases: null or empty html gives the empty text. Null or hostless urls take no part in counting
and have no template. Unclosed and stray tags, cut-off pages and raw text elements follow the usual
rules of browsers, in time that grows with the length of the page. Repeated rows and copies under other
addresses count once; further columns are not touched.
"""

from __future__ import annotations

import functools
import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm import common as C

MIN_PAGES, MIN_SHARE = 5, 0.05
# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd table thead tbody tfoot tr td th caption figure figcaption address".split())
BLOCKS = TEXT_BLOCKS | frozenset("html body div section article main header footer nav aside form fieldset hr details summary head title dialog hgroup search center".split())
NO_TEXT = frozenset("nav footer aside form script style noscript template iframe object svg math button select option textarea input head title dialog menu canvas audio video label legend datalist noembed noframes xmp".split())
CLOSES_P = BLOCKS - {"html", "body", "head", "title", "li", "dt", "dd", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "summary", "figcaption"}
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "thead": ({"thead", "tbody", "tr"}, {"table"}),
            "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"})}
# Words in class or id, and roles, that mark what is no article text.
NOISE_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies
 consent gdpr notice notices sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment
 comments disqus replies respond adslot adbox adunit adsense share sharing social related recommended newsletter subscribe subscription popup modal overlay widget
 toolbar pagination pager login signup search skip paywall alert""".split())
#: Words that may stand beside these in a compound (site-sidebar, ad-slot, post-comments); a compound
#: with any other word (has-sidebar, search-result, how-to-share-files) marks something else.
COMPANIONS = frozenset("""site page main global top bottom left right center primary secondary tertiary sub mini mobile desktop
 sticky fixed floating inline bar box boxes slot unit units list lists item items wrap wrapper container inner outer holder area
 areas block blocks section region zone panel pane row col column group grid card cards title heading headline head body text
 content contents link links button buttons btn icon icons form field input label image img media logo toggle trigger dropdown
 post posts article articles story stories entry blog author avatar meta reply thread count news recent latest popular more
 follow facebook twitter email print tool tools user account policy law info message dialog window close accept header footer
 masthead topbar foot web google dfp gpt leaderboard skyscraper mpu rectangle billboard teaser teasers module component plugin
 js wp""".split())
#: An element with this share of the page's paragraph text is a wrapper, whatever its class.
WRAPPER_SHARE = 0.75
#: If templates would leave less than this share of a page's article or paragraph text, the page is a
#: copy of others with small differences, and its text stays.
LEAST_SHARE = 0.1
#: In an article these mark no article text however long they are.
NEVER_TEXT = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr comment comments disqus
 replies respond adslot adbox adunit adsense related recommended newsletter subscribe subscription breadcrumb breadcrumbs pagination pager""".split())
#: These mark the header of a page, but within an article the place of its heading.
HEADER_WORDS = frozenset("header masthead topbar".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar alertdialog".split())

TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<([a-zA-Z][^\s/>]*)([^>"']*+(?:"[^"]*"[^>"']*+|'[^']*'[^>"']*+)*+)(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<[a-zA-Z!?/][^>]*(?:>|\Z)|[^<]+|<""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
PART = re.compile(r"(?<![a-z0-9])[a-z]+(?=[0-9]*(?![a-z0-9]))")  # parts with digits in them are numbers and hashes
SPACE = re.compile(r"\s+")


def marked(value: str, marks: frozenset[str]) -> bool:
    """Whether a token of a class or id is one of the marks or a known compound with one."""
    for token in value.lower().split():
        parts = [p for p in PART.findall(token) if len(p) > 1 or p in marks]
        if any(p in marks for p in parts) and all(p in marks or p in NOISE_WORDS or p in COMPANIONS for p in parts):
            return True
    return False


@functools.lru_cache(maxsize=4096)
def is_noise(tag: str, attributes: str) -> bool:
    """Whether an element is no article text by its tag, role or style."""
    if tag in NO_TEXT:
        return True
    for name, value in ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "role" and value in NOISE_ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _named(attributes: str) -> list[str]:
    return [v.strip("\"'") for n, v in ATTRIBUTE.findall(attributes) if n.lower() in ("class", "id")] if attributes else []


@functools.lru_cache(maxsize=4096)
def is_noise_by_class(attributes: str) -> bool:
    return any(marked(v, NOISE_WORDS) for v in _named(attributes))


@functools.lru_cache(maxsize=4096)
def is_never_text(attributes: str) -> bool:
    return any(marked(v, NEVER_TEXT) for v in _named(attributes))


@functools.lru_cache(maxsize=4096)
def is_header_by_class(attributes: str) -> bool:
    return any(marked(v, HEADER_WORDS) for v in _named(attributes))


@functools.lru_cache(maxsize=4096)
def identity(tag: str, attributes: str) -> str:
    """What of a start tag goes into the hash: not the targets, which differ from page to page."""
    return tag + "".join(f" {n.lower()}={v}" for n, v in ATTRIBUTE.findall(attributes) if n.lower() not in ("href", "src", "action", "value"))


class _Open:
    """The open elements, with the places of each tag and of the blocks among them."""

    def __init__(self, tags: list[str]) -> None:
        self.tags, self.elements = tags, [0]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def top(self) -> int:
        return self.elements[-1]

    def last(self, tag: str) -> int:
        """Place of the innermost open element of a tag; 0 if there is none."""
        found = self.places.get(tag)
        return found[-1] if found else 0

    def last_block(self) -> int:
        return self.blocks[-1] if self.blocks else 0

    def push(self, i: int) -> None:
        tag, place = self.tags[i], len(self.elements)
        self.elements.append(i)
        self.places.setdefault(tag, []).append(place)
        if tag in BLOCKS:
            self.blocks.append(place)

    def cut(self, place: int) -> None:
        """Close the element at a place and all within it."""
        for i in self.elements[place:]:
            self.places[self.tags[i]].pop()
        del self.elements[place:]
        while self.blocks and self.blocks[-1] >= place:
            self.blocks.pop()


class Page:
    """Elements in page order: ``tag``, ``attributes``, ``parent``, and ``items``, the sequence of
    (element number, text) with a text of None where an element of block kind begins or ends."""

    def __init__(self, html: str) -> None:
        self.tag, self.attributes, self.parent = ["#root"], [""], [-1]
        self.items: list[tuple[int, str | None]] = []
        stack, at, n = _Open(self.tag), 0, len(html)
        while at < n:
            m = TOKEN.match(html, at)
            at = m.end()
            if m[1]:
                tag = m[1].lower()
                if tag in CLOSES_P:
                    self._close(stack, {"p"}, {"button", "table", "td", "th", "article", "section", "div", "li", "blockquote", "aside"}, tag)
                if tag in SIBLINGS:
                    self._close(stack, *SIBLINGS[tag], tag)
                i = len(self.tag)
                self.tag.append(tag)
                self.attributes.append(m[2])
                self.parent.append(stack.top())
                if tag in BLOCKS:
                    self.items.append((i, None))
                elif tag == "br":
                    self.items.append((stack.top(), " "))
                if tag in RAW:
                    end = re.compile(rf"</{tag}\s*[^>]*(?:>|\Z)", re.I).search(html, at)
                    self.items.append((i, html[at: end.start() if end else n]))
                    at = end.end() if end else n
                elif tag not in VOID and not m[2].endswith("/"):
                    stack.push(i)
            elif m[3]:
                tag = m[3].lower()
                k = stack.last(tag)
                if k and (tag in BLOCKS or k > stack.last_block()):  # an inline end tag does not close the block around it
                    if stack.last_block() >= k:
                        self.items.append((stack.elements[k], None))
                    stack.cut(k)
                elif tag == "p":  # a stray one is an empty paragraph
                    self.items.append((stack.top(), None))
            elif m[0][0] != "<" or m[0] == "<":
                self.items.append((stack.top(), m[0]))

    def _close(self, stack: _Open, tags: set[str], scope: set[str], by: str) -> None:
        while (k := max(map(stack.last, tags))) > max(map(stack.last, scope)):
            self.items.append((stack.elements[k], None))
            stack.cut(k)
            if by not in SIBLINGS or by in ("li", "dt", "dd", "option"):
                return

    @functools.cached_property
    def _digests(self) -> list[bytes]:
        parts: list[list[str]] = [[identity(t, a)] for t, a in zip(self.tag, self.attributes)]
        for i, text in self.items:
            if text is not None and (x := SPACE.sub(" ", text).strip()):
                parts[i].append(x)
        out = [b""] * len(parts)
        for i in range(len(parts) - 1, -1, -1):  # children come after their parents
            out[i] = d = hashlib.blake2b("\x1f".join(parts[i]).encode("utf-8", "replace"), digest_size=8).digest()
            if self.parent[i] >= 0:
                parts[self.parent[i]].append(d.hex())
        return out

    def wrappers(self) -> set[int]:
        """Elements that hold the page's main element, at least half the text of its articles or, if
        it has neither, most of its paragraph text. Articles whose own class is noise do not count."""
        n = len(self.tag)
        main, article, paragraph = [0] * n, [0] * n, [0] * n
        gone, kind = [False] * n, [""] * n
        for i in range(1, n):
            p, tag = self.parent[i], self.tag[i]
            real = tag in ("article", "main") and not is_noise_by_class(self.attributes[i])
            gone[i] = gone[p] or is_noise(tag, self.attributes[i]) or tag == "article" and not real
            kind[i] = "article" if real else kind[p] or ("p" if tag in ("p", "pre", "blockquote") else "")
            main[i] = int(tag == "main" and not gone[i])
        for i, text in self.items:
            if text is not None and not gone[i] and kind[i]:
                (article if kind[i] == "article" else paragraph)[i] += len(text.strip())
        for i in range(n - 1, 0, -1):  # children come after their parents
            for x in (main, article, paragraph):
                x[self.parent[i]] += x[i]
        if main[0] or article[0]:
            return {i for i in range(n) if main[i] or article[i] and 2 * article[i] >= article[0]}
        return {i for i in range(n) if paragraph[i] and paragraph[i] >= WRAPPER_SHARE * paragraph[0]}

    def content(self) -> bytes:
        """Digest of what the page shows: equal for copies of a page, whatever their heads say."""
        subtree = self.hashes()
        return subtree[next((i for i, tag in enumerate(self.tag) if tag == "body"), 0)]

    def bulk(self) -> set[int]:
        """Elements that hold most of the text of the article or main element around them or, outside
        of these, of the page's paragraphs. What is no article text by its tag, role or plain mark
        (`NEVER_TEXT`) does not count and is not among them."""
        n = len(self.tag)
        gone, home, paragraph, text = [False] * n, [0] * n, [False] * n, [0] * n
        for i in range(1, n):
            p, tag = self.parent[i], self.tag[i]
            gone[i] = gone[p] or is_noise(tag, self.attributes[i]) or is_never_text(self.attributes[i])
            home[i] = i if tag in ("article", "main") else home[p]
            paragraph[i] = paragraph[p] or tag in ("p", "pre", "blockquote")
        total: Counter = Counter()
        for i, x in self.items:
            if x is not None and not gone[i] and (home[i] or paragraph[i]):
                text[i] += len(x.strip())
                total[home[i]] += len(x.strip())
        out = set()
        for i in range(n - 1, 0, -1):  # children come after their parents
            if text[i] and home[i] != i and text[i] >= WRAPPER_SHARE * total[home[i]]:
                out.add(i)
            if home[self.parent[i]] == home[i]:
                text[self.parent[i]] += text[i]
        return out

    def frame(self) -> tuple[list[bool], list[bool]]:
        """For each element, whether it goes without regard to templates, and whether it is in an
        article or main element."""
        n = len(self.tag)
        noise, within = [False] * n, [False] * n
        wraps = bulk = None
        for i in range(1, n):
            p, tag = self.parent[i], self.tag[i]
            within[i] = within[p] or tag in ("article", "main")
            noise[i] = noise[p] or is_noise(tag, self.attributes[i]) or tag == "header" and not within[p]
            # the header of a page goes, that of an article holds its heading
            if not noise[i] and tag not in ("html", "body", "article", "main") and (is_noise_by_class(self.attributes[i]) or not within[p] and is_header_by_class(self.attributes[i])):
                if within[p]:
                    bulk = self.bulk() if bulk is None else bulk
                    noise[i] = i not in bulk
                else:
                    wraps = self.wrappers() if wraps is None else wraps
                    noise[i] = i not in wraps
        return noise, within

    def may_go(self, i: int, within: bool) -> bool:
        """Whether an element goes if its subtree is template."""
        return self.tag[i] not in ("html", "body", "article", "main") and not (within and (self.tag[i] in TEXT_BLOCKS or self.tag[i] not in BLOCKS))

    def hashes(self) -> list[bytes]:
        """A 64-bit digest of each subtree."""
        return self._digests

    def candidates(self) -> set[tuple[bytes, bool]]:
        """Subtrees that go if they are template, and whether they are in an article."""
        noise, within = self.frame()
        return {(h, w) for i, (h, x, w) in enumerate(zip(self.hashes(), noise, within)) if i and not x and self.may_go(i, w)}

    def blocks(self, template: frozenset[bytes] = frozenset(), inside: frozenset[bytes] = frozenset()) -> list[str]:
        """Text blocks without subtrees of ``template`` and, in an article, of ``inside``."""
        n = len(self.tag)
        noise, within = self.frame()
        paragraph = [False] * n
        for i in range(1, n):
            paragraph[i] = paragraph[self.parent[i]] or self.tag[i] in ("p", "pre", "blockquote")
        size = [(i, len(x.strip())) for i, x in self.items if x is not None and not noise[i]]
        body = [(i, k) for i, k in size if paragraph[i] or within[i]]
        if template or inside:
            subtree, gone = self.hashes(), noise.copy()
            for i in range(1, n):
                gone[i] = gone[i] or gone[self.parent[i]] or subtree[i] in (inside if within[i] else template) and self.may_go(i, within[i])
            if not body or sum(k for i, k in body if not gone[i]) >= LEAST_SHARE * sum(k for _, k in body):
                noise = gone
        own = sum(k for i, k in size if within[i] and not noise[i])
        only = own and own >= sum(k for i, k in size if paragraph[i] and not within[i] and not noise[i])
        out: list[str] = []
        block: list[str] = []
        for i, text in [*self.items, (0, None)]:
            if text is None:
                if block and (x := SPACE.sub(" ", entities.unescape("".join(block))).strip()):
                    out.append(x)
                block = []
            elif not noise[i] and (within[i] or not only):
                block.append(text)
        return out


def host(url_col: str) -> F.Column:
    return F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def _long(digests: Iterable[bytes]) -> pa.Array:
    return pa.array([int.from_bytes(d, "little", signed=True) for d in digests], pa.int64())


def template_counts(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(site, subtree, n, contents): on how many pages of a host a subtree occurs, and on how many of
    different content; of these each task counts ``min_pages`` at most, which is all that matters."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        contents: dict[tuple, list[bytes]] = {}

        def flush() -> pa.RecordBatch:
            rows = [(*key, x, count[key] if i == 0 else 0) for key, found in contents.items() for i, x in enumerate(found)]
            site, subtree, content, n = zip(*rows)
            count.clear()
            contents.clear()
            return pa.RecordBatch.from_arrays([pa.array(site, pa.int64()), _long(subtree), _long(content), pa.array(n, pa.int64())], names=["site", "subtree", "content", "n"])

        for batch in batches:
            for part in C.slices(batch, 1):
                for site, html in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    page = Page(html or "")
                    content = page.content()
                    for h in set(page.hashes()[1:]):
                        count[site, h] += 1
                        found = contents.setdefault((site, h), [])
                        if len(found) < min_pages and content not in found:
                            found.append(content)
                if len(count) > 300_000:
                    yield flush()
        if count:
            yield flush()

    named = pages.where("site IS NOT NULL").select("site", "html")
    rows = named.mapInArrow(run, "site long, subtree long, content long, n long").groupBy("site", "subtree", "content").agg(F.sum("n").alias("n"))
    return rows.groupBy("site", "subtree").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("contents"))


def candidate_rows(pages: DataFrame) -> DataFrame:
    """(site, key, subtree, within): the subtrees of each page that go if they are template."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, 2):
                found = [(site, key, h, w) for site, key, html in zip(*(c.to_pylist() for c in part.columns)) for h, w in Page(html or "").candidates()]
                if found:
                    site, key, h, w = zip(*found)
                    yield pa.RecordBatch.from_arrays([pa.array(site, pa.int64()), pa.array(key, pa.int64()), _long(h), pa.array(w, pa.bool_())], names=["site", "key", "subtree", "within"])

    return pages.where("site IS NOT NULL").select("site", "key", "html").mapInArrow(run, "site long, key long, subtree long, within boolean")


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(site, subtree, often): subtrees on ``min_pages`` pages of a host that differ in content, and
    whether these are ``min_share`` of its pages."""
    totals = pages.where("site IS NOT NULL").groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
    counts = template_counts(pages, min_pages).where(F.col("contents") >= min_pages)
    return counts.join(totals, "site").select("site", "subtree", (F.col("n") >= min_share * F.col("pages")).alias("often"))


def page_hits(pages: DataFrame, found: DataFrame) -> DataFrame:
    """(key, outside, inside): the template subtrees of each page, by whether they are in its
    article. A subtree on very many pages is a hot key of a plain join, which Spark splits."""
    hits = candidate_rows(pages).join(found, ["site", "subtree"]).where("often OR NOT within")
    return hits.groupBy("key").agg(F.collect_set(F.expr("IF(within, NULL, subtree)")).alias("outside"), F.collect_set(F.expr("IF(within, subtree, NULL)")).alias("inside"))


def extract(pages: DataFrame, html_col: str = "html", url_col: str = "url", out_col: str = "main_text",
            min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """``pages`` with the main text of each page; all other columns pass through."""
    rest = [c for c in pages.columns if c not in (html_col, out_col)]
    inner = F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row")
    rows = pages.select(inner, F.col(html_col).alias("html"), host(url_col).alias("host"))
    # copies of a page differ in its id, so all plain columns make the key; where two pages share one,
    # each meets the templates of both
    plain = [F.col("row")[c] for c in rest if not pages.schema[c].dataType.typeName().startswith(("map", "struct", "array", "variant"))]
    rows = rows.select("row", "html", F.when(F.col("host") != "", F.xxhash64("host")).alias("site"), F.xxhash64("html", *plain).alias("key"))
    found = C.stored(templates(rows, min_pages, min_share), "templates")
    hits = page_hits(rows, found)
    joined = rows.join(hits, "key", "left").select("row", "html", "outside", "inside")

    def main_text(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for html, *hits in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
            outside, inside = (frozenset(h.to_bytes(8, "little", signed=True) for h in x or ()) for x in hits)
            out.append("\n\n".join(Page(html or "").blocks(outside, inside)))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["row", "text"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, 1):
                yield main_text(part)

    schema = joined.select("row", F.lit("").alias("text")).schema
    out = joined.mapInArrow(run, schema)
    return out.select(*[F.col("row")[c].alias(c) for c in rest], F.col("text").alias(out_col))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = C.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, out_col="text").select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
