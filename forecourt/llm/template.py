"""Main text of web pages by equivalence-class template deduction.

A page is a sequence of tokens: tags, named by their path, and text blocks, named by path
and content. Paths hold tag names and the words of classes, no ids and no numbers. Pages of
a host with equal article text are one distinct page. A token's occurrence vector over the
distinct pages of a host is kept as a sum of hashes of (page, times it occurs),
pre-aggregated before it moves, so a host with a third of all pages is a few thousand small
rows. Tokens of a host with equal vectors form an equivalence class. A class is valid if it
spans MIN_PAGES distinct pages and more than half of the host's, and holds a tag; it nests
in the class of the path above its topmost tag. The valid classes are the host's template:
whatever is left between its tags are slots. Text blocks of a valid class are boilerplate,
unless the pages are near copies: blocks on no more pages than the class, but on more than
half as many, are then more than half of the article blocks of a page on average, and
all text of the class stays. So near copies lose text only where they are most of a host's
distinct pages and yet have half or less of their blocks in common; boilerplate of a section
with half or less of a host's pages stays in the text. Of the slots those of the article are kept: within article or main tags, or marked
so by id or class, where a page has such; never within menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments.

Blocks end where block-level tags begin or end; other tags and line breaks do not end a
block. Character references are decoded after tags are removed, white space becomes one
space, blocks are joined by two line breaks. Unclosed tags close with their parents; a tag
that the page cuts off is dropped. Null html gives an empty text, a null or odd url its
own host. Each row gives one row, repeated ones equal rows; an empty table gives none. A page is
read whole by one task, however long.
"""

from __future__ import annotations

import hashlib
import html as references
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import common

MIN_PAGES = 3
EVERY = 0
PIECE = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(>|$)|([^<]+|<)",
    re.S,
)
MARKS = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
WORD = re.compile(r"[a-z0-9]+")
SPACE = re.compile(r"\s+")
# Tags by what browsers make of them.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
    "ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noscript script style template textarea title xmp".split())
CHROME = frozenset(
    "nav footer aside form head menu button select option dialog input label svg object "
    "canvas audio video".split()
)
CHROME_ROLE = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split()
)
CHROME_WORD = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising alert banner breadcrumb "
    "breadcrumbs comment comments consent cookie cookies disqus dropdown footer gdpr login menu "
    "modal nav navbar navigation newsletter notice notices notification pagination pager popup "
    "promo promoted promotion recommended related replies reply respond search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets".split()
)
ARTICLE_WORD = frozenset("article content entry main post story".split())


class Page:
    """Blocks and tag paths of one page."""

    def __init__(self, source: str):
        self.tags: dict[str, int] = {}
        self.blocks: list[tuple[str, str, bool, int]] = []
        self.stack: list[tuple[str, str, bool, int]] = []
        self.text: list[str] = []
        self._read(source)
        self._end_block()

    def _end_block(self) -> None:
        if self.text:
            text = SPACE.sub(" ", references.unescape("".join(self.text))).strip()
            if text:
                path, chrome, article = self._where()
                self.blocks.append((path, text, chrome, article))
            self.text = []

    def _where(self):
        """Path, whether any tag above is page furniture, and how surely it is an article."""
        for _, path, chrome, article in reversed(self.stack):
            return path, chrome, article
        return "", False, 0

    def _open(self, name: str, marks: str) -> None:
        path, chrome, article = self._where()
        found = {a.lower(): b or c or d for a, b, c, d in MARKS.findall(marks)} if "=" in marks else {}
        words = WORD.findall(f"{found.get('class', '')} {found.get('id', '')}".lower())
        role = found.get("role", "").lower()
        chrome = (
            chrome
            or name in CHROME
            or (name == "header" and article < 2)
            or role in CHROME_ROLE
            or (name not in ("html", "body", "article", "main") and not CHROME_WORD.isdisjoint(words))
            or "display:none" in found.get("style", "").replace(" ", "").lower()
            or re.search(r"(^|\s)hidden(\s|$|=)", marks) is not None
        )
        if name in ("article", "main") or role == "main" or found.get("itemprop") == "articleBody":
            article = 3 if name == "article" or role == "article" or found.get("itemprop") else max(article, 2)
        elif name in ("div", "section", "td") and not ARTICLE_WORD.isdisjoint(words):
            article = max(article, 1)
        named = [x for x in WORD.findall(found.get("class", "").lower()) if not x.isdigit()]
        label = ".".join([name, *named])
        path = f"{path}/{label}" if name in BLOCK else path
        if name in BLOCK:
            self.tags[path] = self.tags.get(path, 0) + 1
        self.stack.append((name, path, chrome, article))

    def _close(self, name: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == name:
                del self.stack[i:]
                return

    def _close_within(self, names: tuple, stop: tuple) -> None:
        """A new paragraph or list item ends the open one, but not one further out."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in names:
                del self.stack[i:]
                return
            if self.stack[i][0] in stop:
                return

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            m = PIECE.match(source, at)
            at = m.end()
            if m[8] is not None:
                self.text.append(m[8])
                continue
            name = m[2] or m[5]
            if name is None:
                continue
            slash, marks, name = m[1] or m[4], m[3] or m[6] or "", name.lower()
            if source[at - 1] != ">":
                break
            if name in BLOCK:
                self._end_block()
            elif name == "br":
                self.text.append(" ")
            if slash:
                self._close(name)
                continue
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|$)", re.I).search(source, at)
                at = end.end() if end else size
                continue
            if name in VOID or marks.endswith("/"):
                continue
            if name in BLOCK:
                self._close_within(("p",), ("article", "section", "div", "body", "td", "li", "blockquote", "button", "main"))
            if name == "li":
                self._close_within(("li",), ("ul", "ol", "menu"))
            elif name in ("dt", "dd"):
                self._close_within(("dt", "dd"), ("dl",))
            elif name in ("td", "th"):
                self._close_within(("td", "th"), ("tr", "table"))
            elif name == "tr":
                self._close_within(("tr",), ("table",))
            elif name == "option":
                self._close_within(("option",), ("select",))
            self._open(name, marks)


def _article(blocks) -> list[tuple[str, str]]:
    """(path, text) of the blocks outside page furniture that most surely are the article."""
    best = max((a for _, _, chrome, a in blocks if not chrome), default=0)
    return [(path, text) for path, text, chrome, a in blocks if not chrome and a == best]


def _token(*parts) -> int:
    own = hashlib.blake2b("\x00".join(parts).encode(), digest_size=8).digest()
    return int(np.frombuffer(own, np.int64)[0])


def _tokens(batches):
    """(host, token, parent, is_tag, page, times, share): page is a hash of its article text.

    share is a text's part of the article blocks of its page, in millionths. EVERY is a
    token of all pages.
    """
    for batch in batches:
        out = []
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = Page(source)
            article = _article(page.blocks)
            mark = _token(*(text for _, text in article))
            out.append((host, EVERY, EVERY, False, mark, 1, 0))
            for path, n in page.tags.items():
                out.append((host, _token(path), _token(path.rpartition("/")[0]), True, mark, n, 0))
            times: dict[tuple[int, int], list[int]] = {}
            for path, text, _, _ in page.blocks:
                times.setdefault((_token(path, text), _token(path)), [0, 0])[0] += 1
            for path, text in article:
                times[_token(path, text), _token(path)][1] += 1
            out += [(host, a, b, False, mark, n, 1_000_000 * m // max(len(article), 1)) for (a, b), (n, m) in times.items()]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, k) for x, k in zip(list(zip(*out, strict=True)) or [[]] * 7, kinds, strict=True)],
            ["host", "token", "parent", "is_tag", "page", "times", "share"],
        )


def _pages(pages: DataFrame) -> DataFrame:
    common.ship(pages.sparkSession)
    url = F.col("url").cast("string")
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    return pages.select(
        F.col("page_id"),
        F.col("url"),
        F.coalesce(F.when(host != "", host), url, F.lit("")).alias("host"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )


def templates(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, class, parent_class, n_pages, is_tag, copied, token): the valid classes of every host."""
    tokens = _pages(pages).mapInArrow(
        _tokens,
        "host string, token long, parent long, is_tag boolean, page long, times int, share long",
    )
    vectors = (
        tokens.groupBy("host", "token", "parent", "is_tag", "page")
        .agg(F.max("times").alias("times"), F.max("share").alias("share"))
        .groupBy("host", "token", "parent", "is_tag")
        .agg(
            F.sum(F.xxhash64("page", "times").cast("decimal(20,0)")).alias("vector"),
            F.count("*").alias("n_pages"),
            F.sum("share").alias("share"),
        )
        .filter(F.col("n_pages") >= min_pages)
        .withColumn("class", F.xxhash64(F.col("vector"), "n_pages"))
    )
    vectors = common.store(vectors.drop("vector"), "vectors")
    every = (F.col("token") == EVERY) & (F.col("parent") == EVERY)
    hosts = vectors.filter(every).select("host", F.col("n_pages").alias("n_host"))
    vectors = vectors.filter(~every)
    valid = (
        vectors.groupBy("host", "class")
        .agg(
            F.max("is_tag").alias("valid"),
            F.min(F.when(F.col("is_tag"), F.col("parent"))).alias("above"),
            F.max("n_pages").alias("n"),
        )
        .filter("valid")
        .join(hosts, "host")
        .filter("2 * n > n_host")
    )
    # how much of an article the blocks make up that are about as frequent as a class
    shares = vectors.filter("share > 0").groupBy("host", "n_pages").agg(F.sum("share").alias("share"))
    copied = (
        valid.select("host", "n").distinct().join(shares, "host")
        .filter("n_pages <= n and 2 * n_pages > n")
        .groupBy("host", "n")
        .agg((F.sum("share") > 500_000 * F.col("n")).alias("copied"))
    )
    valid = valid.join(copied, ["host", "n"], "left").withColumn("copied", F.coalesce("copied", F.lit(False)))
    paths = vectors.filter("is_tag").select(
        "host", F.col("token").alias("above"), F.col("class").alias("parent_class")
    )
    nested = valid.join(paths, ["host", "above"], "left").select("host", "class", "parent_class", "copied")
    return vectors.join(nested, ["host", "class"]).select(
        "host", "class", "parent_class", "n_pages", "is_tag", "copied", "token"
    )


def _slots(batches):
    for batch in batches:
        texts = []
        for source, fixed in zip(batch.column("html").to_pylist(), batch.column("fixed").to_pylist(), strict=True):
            known = set(fixed or ())
            slots = [x for x in Page(source).blocks if not (known and _token(*x[:2]) in known)]
            texts.append("\n\n".join(text for _, text in _article(slots)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                pa.array([len(x) for x in texts], pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = _pages(pages)
    fixed = (
        templates(pages)
        .filter("not is_tag and not copied")
        .groupBy("host")
        .agg(F.collect_set("token").alias("fixed"))
    )
    fixed = common.store(fixed, "templates")
    joined = rows.join(fixed, "host", "left").select("page_id", "url", "html", "fixed")
    kinds = dict(joined.dtypes)
    return joined.mapInArrow(
        _slots, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )
