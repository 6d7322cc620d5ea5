"""Main text of web pages by site template removal.

1. One pass parses every page and hashes its element subtrees bottom up (tag, attributes, text and the hashes
   of the children). Spark counts on how many distinct pages of each host a subtree stands: copies, pages with
   the same text, count once.
2. Subtrees on ``min_pages`` distinct pages recur, whatever the size of the host; those that are also on
   ``prose_share`` of the host's distinct pages are common. On a host of fewer pages, subtrees without prose recur from
   ``SMALL_PAGES`` pages on if they are on ``SMALL_SHARE`` of them. Each page gets the list of its own subtrees that
   recur, so no list grows with the host.
3. A second pass parses the pages again and deletes subtrees without prose, and outside the marked article
   containers of prose other than lists and tables, for recurring; paragraphs and the like outside the article, lists,
   tables and containers of prose inside the article for being common. Paragraphs inside the marked article stay:
   articles may quote each other. Containers of prose that are not common are not deleted where they would
   take over half of a page's text (near copies of an article), and nothing is where under a tenth would be left.
   Elements that are no article by their kind (navigation, forms, scripts and so on) go in any case, and those of which a
   whole name (of class, id or role) says so: each of its words names such a kind or a mere part of a layout
   ("cookieBanner", "related-posts", but not "related-work" or "market-share").
   Where a page marks its article, text outside it is dropped last.

Pages meet their lists in a join that Spark broadcasts only while the stored lists are below its
threshold; beyond it is a sort-merge join whose hot pages (copies) are split.

Defined results: null html is an empty page (empty text, 0 characters); a null url is a host of its own; unclosed and
stray tags close where a browser would close them or are text; repeated rows each get their own result; an empty
table gives an empty result; extra columns are kept by ``main_text`` and a clashing ``text`` or ``host`` is replaced.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stored

NAME = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)")
UNQUOTED = re.compile(r"[^>\"']*")
NAMES = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")  # of a name, at its marks and capitals

RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dt dd figcaption caption".split())
BLOCK = PROSE | frozenset(
    "html head body article main section div nav header footer aside form fieldset ul ol dl table thead tbody tfoot tr "
    "address details summary figure dialog menu center hr".split())
MAIN = frozenset(("article", "main"))
# No article by the kind of element, or by a word of its class, id or role.
NO_ARTICLE = frozenset(
    "head script style noscript template nav footer aside form button select option input textarea iframe object "
    "embed svg canvas dialog menu title xmp noembed noframes audio video".split())
NO_ARTICLE_WORDS = frozenset(
    "ad ads adbox adsbygoogle advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice notices popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs comment "
    "comments commentlist commentform disqus respond responses share sharing social related recommended newsletter subscribe footer "
    "masthead toolbar pagination pager search login signup complementary contentinfo".split())
# Words that say no more than what part of a layout an element is: they may stand beside those. Others (has-sidebar,
# comments-open, related-work) make a name one of something else.
LAYOUT_WORDS = frozenset(
    "area article articles author bar block body bottom box btn button buttons cell col column container content copyright count desktop "
    "div element entry field fixed float form global group head header heading headline holder icon icons inner item items label "
    "layer layout left legal link links list local main message meta middle mobile module more msg outer page panel part placeholder "
    "policy post posts primary privacy region reply replies right row secondary section site slot small space stories story strip "
    "tag tags terms text thread tile title tool tools top unit user view widget widgets wrap wrapper you may also like zone".split())
# Text of a page of a small host recurs where it stands on so many of its distinct pages, and on such a share of them.
SMALL_PAGES, SMALL_SHARE = 3, 0.75
# Start tags that end an open paragraph, and elements that end their like.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
# Containers whose equal parts are data (rows of products, lists of features) unless they are common.
DATA = frozenset("ul ol dl menu table thead tbody tfoot tr".split())
SCOPE = frozenset("ul ol dl table select article main section div body html td th".split())


@dataclass(slots=True)
class Open:
    tag: str
    attrs: str
    skip: bool        # no article by its kind or its name, or inside of such
    kind: bool        # by its kind, or inside of such
    named: int        # its number if its name says so, or 0
    main: bool
    blocks: int
    lost: int = 0     # characters below it that names hide
    article: bool = False  # is or contains a marked article, not inside of another
    prose: bool = False
    table: bool = False
    parts: list = field(default_factory=list)


def host_of(url: Column) -> Column:
    """Lower-case host without user and port; '' for none."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", ""))


def _no_article(tag: str, in_main: bool) -> bool:
    return tag in NO_ARTICLE or (tag == "header" and not in_main)


def _no_article_name(tag: str, attrs: str) -> bool:
    """Does a whole name (of class, id or role) say so: all its words name such a kind or a part of a layout, and one of them
    such a kind; of block--modifier the block."""
    if not attrs or tag in ("html", "body"):
        return False
    for m in NAMES.finditer(attrs):
        for name in m[1].strip("\"'").split():
            words = {w.lower() for w in WORD.findall(name.split("--")[0])}
            other = words - NO_ARTICLE_WORDS
            if len(other) < len(words) and all(w in LAYOUT_WORDS or len(w) == 1 for w in other):
                return True
    return False


@dataclass(slots=True)
class Cut:
    """A subtree that could be template: its hash and its blocks [start, end)."""
    digest: int
    start: int
    end: int
    prose: bool   # holds prose
    common: bool  # deleted only where it is common


@dataclass(slots=True)
class Parsed:
    """Blocks of a page (in the marked article, text) and its subtrees that could be template."""
    blocks: list[tuple[bool, str]]
    cuts: list[Cut]

    def text(self, gone: frozenset[int] | set[int] = frozenset()) -> list[str]:
        """Blocks of the marked article, of the whole page where none is marked, without those ``gone``."""
        article = any(main for main, _ in self.blocks)
        return [t for k, (main, t) in enumerate(self.blocks) if (main or not article) and k not in gone]

    def without(self, recurring: dict[int, bool | None]) -> list[str]:
        """The text without templates (``recurring``: is a hash that recurs on the host common there; None on a small
        host, where only subtrees without prose go)."""
        found = [c for c in self.cuts if c.digest in recurring and (
            not c.prose if recurring[c.digest] is None else recurring[c.digest] or not c.common)]
        if not found:
            return self.text()

        def blocks(cuts: list[Cut]) -> set[int]:
            out: set[int] = set()
            done = 0
            for c in sorted(cuts, key=lambda c: c.start):  # nested ones overlap: every block once
                out.update(range(max(c.start, done), c.end))
                done = max(done, c.end)
            return out

        def size(texts: list[str]) -> int:
            return sum(map(len, texts))

        whole = self.text()
        gone = blocks([c for c in found if recurring[c.digest] or not c.prose])
        left = self.text(gone)
        if size(left) * 10 < size(whole):
            gone, left = set(), whole
        more = gone | blocks([c for c in found if c.prose and not recurring[c.digest]])
        fewer = self.text(more)
        return fewer if size(fewer) * 2 >= size(left) else left


def parse(page: str, by_class: bool = True, spared: frozenset[int] = frozenset(),
          ) -> tuple[list[str], list[str], Parsed]:
    """Blocks of the marked article, blocks of the whole page, and both with the subtrees that could be
    template (``by_class``: without elements whose class, id or role says that they are no article, but for those
    ``spared`` by their number). Where names hide the marked article, or nine tenths of a page that marks none, the
    elements that hold it are spared."""
    from xxhash import xxh3_64_intdigest

    blocks: list[tuple[bool, str]] = []
    inline: list[str] = []
    cuts: list[Cut] = []
    stack: list[Open] = [Open("", "", False, False, 0, False, 0)]
    named: list[tuple[int, int, bool]] = []  # number, characters and whether with the article
    kept = number = 0
    low: str | None = None

    def flush() -> None:
        if inline:
            text = " ".join(entities.unescape("".join(inline)).split())
            if text:
                blocks.append((stack[-1].main, text))
            inline.clear()

    def text(s: str) -> None:
        nonlocal kept
        if s:
            top = stack[-1]
            bare = s.strip()
            top.parts.append(bare)
            if not top.skip:
                inline.append(s)
                kept += len(bare)
            elif not top.kind:
                top.lost += len(bare)

    def close() -> None:
        top = stack[-1]
        block = top.tag in BLOCK
        if block:
            flush()
        stack.pop()
        digest = xxh3_64_intdigest("\x00".join((top.tag, " ".join(top.attrs.split()), *top.parts)).encode(
            "utf-8", "surrogatepass")) - (1 << 63)
        up = stack[-1]
        up.parts.append(str(digest))
        up.lost += top.lost
        up.article = up.article or top.article
        if top.named:
            named.append((top.named, top.lost, top.article))
        up.prose = up.prose or top.prose or top.tag in PROSE
        up.table = up.table or top.table or top.tag == "table"
        # prose inside the article is article, a container of it unless common
        prose = top.prose or top.tag in PROSE
        if block and top.blocks < len(blocks) and top.tag not in MAIN and top.tag not in ("html", "body", "head") \
                and not (top.main and top.tag in PROSE):
            cuts.append(Cut(digest, top.blocks, len(blocks), prose,
                            prose and (top.main or top.tag in PROSE or top.tag in DATA or top.table)))

    def end(tag: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == tag:
                while len(stack) > k:
                    close()
                return
            if stack[k].tag in SCOPE and tag not in BLOCK:
                return

    loose = False  # after a tag whose quotes never close: tags end at the next ">"

    def tag_end(start: int) -> int:
        nonlocal loose
        i = start
        while not loose:
            i = UNQUOTED.match(page, i).end()
            if page[i:i + 1] == ">":
                return i
            i = page.find(page[i], i + 1) + 1 if i < len(page) else 0
            loose = not i
        return page.find(">", start)

    at, last_end = 0, page.rfind(">")
    while (lt := page.find("<", at)) >= 0 and (lt < last_end or page.startswith("<!--", lt)):
        if page[lt + 1] in "!?":  # comment or declaration
            text(page[at:lt])
            comment = page.startswith("<!--", lt)
            stop = page.find("-->" if comment else ">", lt)
            at = len(page) if stop < 0 else stop + (3 if comment else 1)
            continue
        m = NAME.match(page, lt)
        if not m:
            text(page[at:lt + 1])
            at = lt + 1
            continue
        text(page[at:lt])
        stop = tag_end(m.end())
        tag, attrs, at = m[2].lower(), page[m.end():stop], stop + 1
        if m[1]:
            end(tag)
            continue
        if tag in BLOCK:
            for k in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[k].tag == "p":
                    while len(stack) > k:
                        close()
                    break
                if stack[k].tag in SCOPE:
                    break
        if tag in SIBLINGS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in SIBLINGS[tag]:
                    while len(stack) > k:
                        close()
                    break
                if stack[k].tag in SCOPE:
                    break
        if tag in BLOCK:
            flush()
        up = stack[-1]
        if tag in VOID:
            up.parts.append(tag)
            if not up.skip:
                inline.append(" ")
            continue
        number += 1
        kind = up.kind or _no_article(tag, up.main)
        hides = by_class and not kind and number not in spared and _no_article_name(tag, attrs)
        stack.append(Open(tag, attrs, up.skip or kind or hides, kind, number if hides else 0, up.main or tag in MAIN,
                          len(blocks), article=tag in MAIN and not up.main and not kind))
        if attrs.rstrip().endswith("/") and tag not in BLOCK:
            close()
        elif tag in RAW:
            low = page.lower() if low is None else low
            stop = low.find(f"</{tag}", at) if len(low) == len(page) else page.find(f"</{tag}", at)
            stop = len(page) if stop < 0 else stop
            text(page[at:stop])
            at = stop
    text(page[at:])
    while len(stack) > 1:
        close()
    flush()
    if named and not spared and not any(main for main, _ in blocks):
        size = kept + stack[0].lost
        holds = frozenset(n for n, lost, article in named if lost and (article or lost * 10 > size * 9))
        if holds:
            return parse(page, by_class, holds)
    return [t for main, t in blocks if main], [t for _, t in blocks], Parsed(blocks, cuts)


def read(page: str | None) -> Parsed:
    """A page, without the elements that are no article."""
    article, whole, parsed = parse(page or "")
    if not whole and page:  # a wrapper of the whole page can bear such a class
        parsed = parse(page, by_class=False)[2]
    return parsed


def page_key() -> Column:
    """A page's number: copies of one host share it."""
    return F.xxhash64("host", "html")


def subtrees(pages: DataFrame) -> DataFrame:
    """``site`` (a number of the host), ``page`` (of the page's html), ``body`` (of its text: equal for copies) and
    ``hashes`` of its subtrees that could be template; repeated pages of a batch once."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from xxhash import xxh3_64_intdigest

        def number(s: str) -> int:
            return xxh3_64_intdigest(s.encode("utf-8", "surrogatepass")) - (1 << 63)

        for batch in batches:
            seen: set[int] = set()
            out: tuple[list, ...] = ([], [], [], [])
            for host, html, page in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
                if page in seen:
                    continue
                seen.add(page)
                parsed = read(html)
                for column, value in zip(out, (number(host), page, number("\x00".join(parsed.text())),
                                               sorted({c.digest for c in parsed.cuts})), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(column, pa.int64()) for column in out[:3]], pa.array(out[3], pa.list_(pa.int64()))],
                names=["site", "page", "body", "hashes"])

    return map_arrow(pages.select("host", "html", page_key()), run,
                     "site bigint, page bigint, body bigint, hashes array<bigint>")


def site_templates(found: DataFrame, min_pages: int, prose_share: float) -> DataFrame:
    """``site``, ``hash`` and ``common`` of the subtrees on at least ``min_pages`` distinct pages of their host;
    common ones are on ``prose_share`` of its distinct pages. ``common`` is null for those that recur by the rule for
    small hosts alone."""
    sizes = found.select("site", "body").distinct().groupBy("site").agg(F.count(F.lit(1)).alias("bodies"))
    counts = (found.select("site", "body", F.explode("hashes").alias("hash")).distinct()
              .groupBy("site", "hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min(SMALL_PAGES, min_pages)))
    many = F.col("n") >= min_pages
    return (counts.join(sizes, "site").filter(many | (F.col("n") >= F.col("bodies") * SMALL_SHARE))
            .select("site", "hash", F.when(many, F.col("n") >= F.col("bodies") * prose_share).alias("common")))


def page_templates(pages: DataFrame, min_pages: int, prose_share: float) -> DataFrame:
    """``page`` and ``templates``: the recurring subtrees of every page that has some, with whether they are common."""
    found = stored(subtrees(pages), "subtrees")
    templates = stored(site_templates(found, min_pages, prose_share), "templates")
    return (found.select("site", "page", F.explode("hashes").alias("hash")).join(templates, ["site", "hash"])
            .groupBy("page").agg(F.collect_set(F.struct("hash", "common")).alias("templates")))


def main_text(pages: DataFrame, *, min_pages: int = 5, prose_share: float = 0.5) -> DataFrame:
    """The input (columns ``url`` and ``html`` required) plus ``host`` and ``text``."""
    rows = pages.drop("host", "text").withColumn("host", host_of(F.col("url")))
    templates = stored(page_templates(rows, min_pages, prose_share), "page-templates").select(
        F.col("page").alias("__page"), F.col("templates").alias("__templates"))
    joined = rows.withColumn("__page", page_key()).join(templates, "__page", "left").select(
        *rows.columns, "__templates")
    schema = rows.schema.add("text", "string")
    html_at, list_at = (joined.columns.index(c) for c in ("html", "__templates"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            lists = batch.column(list_at).to_pylist()
            texts = ["\n\n".join(read(page).without({t["hash"]: t["common"] for t in lists[k] or ()}))
                     for k, page in enumerate(batch.column(html_at).to_pylist())]
            columns = [c for i, c in enumerate(batch.columns) if i != list_at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=schema.names)

    return map_arrow(joined, run, schema)


def page_rows(pages: DataFrame) -> DataFrame:
    """One row per page."""
    return main_text(pages.select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "host")
