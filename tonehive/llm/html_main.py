"""Main text of web pages: page structure, and substrings that the pages of a host repeat.

A page is read once, into blocks of text. Blocks in menus, headers, footers, sidebars, forms, adverts,
notices and reader comments are boilerplate; blocks in an article or main element are main text.
What is in neither is undecided, on pages with such an element as well as on others.

The undecided is settled by a suffix array of each host: the token streams of all its pages (without
the main elements) are laid end to end and their suffixes sorted. The longest prefix that a suffix
shares with a suffix of a page of another text is the least of the common prefixes between them, so
one pass over neighbours finds it. Prefixes of `depth` words or more are substrings that the site
repeats; an undecided block that they cover for the most part goes, unique runs stay. Beside an article
or main element a run of fewer than DEPTH words, which no repeat can show to be the site's, is not kept.

Suffixes are kept to `span` words, since longer repeats are covered by those of their later words
too. Equal ones are one row with the least and greatest of their pages' texts before anything is
sorted, so a line that every page of a large host has is one row. The array is dealt over the cluster
by host and first `depth` words: equal prefixes stay together, and no host is one task's load.

Repeats never remove text inside an article: copied articles and quoted passages are repeated too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonehive.llm.store import cut

#: Words that a repeat has at least, and that are kept of a suffix.
DEPTH, SPAN = 6, 8
COVERED = 0.6

# HTML's elements by the part they play.
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "canvas"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table",
    "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
_SKIPPED = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "label", "fieldset"}
_CLOSES_ITSELF = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
# Words of class, id and role that mark what is not the article.
_MARKS = (
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription paywall sidebar sidenav menu nav navbar navigation breadcrumb breadcrumbs comment comments commentlist disqus respond reply replies footer share sharing social "
    "related recommended widget widgets toolbar pagination pager login signup search complementary contentinfo dialog skip"
).split()
_MARKED = re.compile(rf"(?:^|[\s_-])(?:{'|'.join(_MARKS)})(?=$|[\s_-])", re.IGNORECASE)
_TOP_MARKED = re.compile(r"(?:^|[\s_-])(?:header|masthead|topbar)(?=$|[\s_-])", re.IGNORECASE)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|</(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+>"
    r"|<(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(?P<loose>[a-zA-Z][^\s/>]*+)[^>]*+>",
    re.DOTALL,
)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:$|[\s=/])|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)

BOILERPLATE, MAIN, UNDECIDED = 0, 1, 2


def blocks(html: str | None) -> list[tuple[str, int]]:
    """(text, part) of every block of a page that has text, in order; white space is one space."""
    if not html:
        return []
    out: list[tuple[str, int]] = []
    # Open elements: tag, the part that they put their text in, and for boilerplate within a line the
    # line's text so far, which goes on after it.
    stack: list[tuple[str, int, list[str] | None]] = []
    part = UNDECIDED
    pieces: list[str] = []

    def flush() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append((text, part))
            pieces.clear()

    def close(i: int) -> None:
        nonlocal part, pieces
        while len(stack) > i:
            tag, _, line = stack.pop()
            outer = stack[-1][1] if stack else UNDECIDED
            if tag in _BLOCK or outer != part:
                flush()
            part = outer
            if line is not None:
                pieces = line

    def pop_to(tag: str, limits: set[str] | None = None) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                close(i)
                return
            if limits and stack[i][0] in limits:
                return

    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            pieces.append(unescape(html[at:]))
            break
        if m.start() > at:
            pieces.append(unescape(html[at : m.start()]))
        at = m.end()
        if m["end"]:
            tag = m["end"].lower()
            if tag in _BLOCK:
                flush()
            if tag in ("br", "p") and not any(s[0] == tag for s in stack):
                pieces.append(" ")
            pop_to(tag)
            continue
        tag = (m["tag"] or m["loose"] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                pieces.append(m[0][9:].removesuffix("]]>"))
            continue
        attrs = m["attrs"] or ""
        if tag in _BLOCK:
            flush()
            within = [s[0] for s in stack if s[2] is not None]
            pop_to("p", {"table", "td", "th", "div", "article", "section", "li", "body"})
            for inline in within[sum(s[2] is not None for s in stack) :]:  # boilerplate within the paragraph goes on
                stack.append((inline, BOILERPLATE, None))
                part = BOILERPLATE
        if tag in _CLOSES_ITSELF:
            pop_to(tag, _CLOSES_ITSELF[tag])
        if tag in _RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.IGNORECASE).search(html, at)
            at = end.end() if end else (n if tag in ("script", "style", "textarea", "title", "iframe") else at)
            continue
        if tag == "br":
            pieces.append(" ")
        if tag in _VOID or attrs.endswith("/") and tag not in _BLOCK:
            continue
        own = part
        if part != BOILERPLATE:
            named = " ".join(x or y or z for x, y, z in _NAMED.findall(attrs)) if attrs else ""
            if tag in _SKIPPED or named and _MARKED.search(named) and tag not in ("body", "html") or attrs and _HIDDEN.search(attrs):
                own = BOILERPLATE
            elif part == UNDECIDED and (tag == "header" or named and _TOP_MARKED.search(named) and tag not in ("body", "html")):
                own = BOILERPLATE
            elif tag in ("article", "main") or named and "role" in attrs.lower() and re.search(r"role\s*=\s*[\"']?main\b", attrs, re.IGNORECASE):
                own = MAIN
        line = None
        if own != part and own == BOILERPLATE and tag not in _BLOCK:
            line, pieces = pieces, []
        elif own != part:
            flush()
        stack.append((tag, own, line))
        part = own
    close(0)
    flush()
    return out


def main_of(found: list[tuple[str, int]], covered: set[int] | None = None) -> str:
    """Text of the main blocks and of the undecided ones that are not covered; beside main blocks, of runs of DEPTH words or more."""
    kept = [part == MAIN or part == UNDECIDED and i not in (covered or ()) for i, (_, part) in enumerate(found)]
    if any(part == MAIN for _, part in found):
        i = 0
        while i < len(found):
            j = i
            while j < len(found) and kept[j] and found[j][1] == UNDECIDED:
                j += 1
            if sum(text.count(" ") + 1 for text, _ in found[i:j]) < DEPTH:
                kept[i:j] = [False] * (j - i)
            i = max(j, i + 1)
    return "\n".join(text for (text, _), keep in zip(found, kept, strict=True) if keep)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every page with its blocks; the words outside main elements; whether any block is undecided; a digest of its own text."""
    for batch in batches:
        texts, parts, rest, undecided, own = [], [], [], [], []
        for html in batch.column("html").to_pylist():
            found = blocks(html)
            texts.append([text for text, _ in found])
            parts.append([part for _, part in found])
            rest.append(" ".join(text for text, part in found if part != MAIN))
            undecided.append(UNDECIDED in parts[-1])
            said = "\n".join(text for text, part in found if part != BOILERPLATE)
            own.append(blake2b(said.encode("utf-8", "surrogatepass"), digest_size=16).digest())
        made = [pa.array(texts, pa.list_(pa.string())), pa.array(parts, pa.list_(pa.int8())), pa.array(rest, pa.string()), pa.array(undecided, pa.bool_()), pa.array(own, pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("page_id", "url", "host")] + made, ["page_id", "url", "host", "texts", "parts", "rest", "open", "own"])


def _suffixes(depth: int, span: int):
    """Suffixes of every page's stream: the first words, each with a space after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, suffixes, places = [], [], []
            for i, rest in enumerate(batch.column("rest").to_pylist()):
                words = [w + " " for w in rest.split(" ")] if rest else []
                for at in range(len(words) - depth + 1):
                    rows.append(i)
                    suffixes.append("".join(words[at : at + span]))
                    places.append(at)
                if len(rows) >= 20_000 or i + 1 == batch.num_rows:
                    take = pa.array(rows, pa.int64())
                    yield pa.RecordBatch.from_arrays([batch.column(c).take(take) for c in ("pk", "host", "own", "open")] + [pa.array(suffixes, pa.string()), pa.array(places, pa.int32())], ["pk", "host", "own", "open", "suffix", "at"])
                    rows, suffixes, places = [], [], []

    return run


def _common(a: str, b: str) -> int:
    """Number of whole words at the beginning of two suffixes that are equal."""
    n = 0
    for x, y in zip(a.split(" ")[:-1], b.split(" ")[:-1], strict=False):
        if x != y:
            break
        n += 1
    return n


def _repeated(depth: int):
    """Suffixes of a group (one host, one first `depth` words), sorted, whose longest prefix on a page of another text has `words` words."""

    def shared(group: list[tuple[str, str, bytes, bytes]]) -> Iterator[tuple[str, str, int]]:
        n = len(group)
        best = [0] * n
        whole = [_common(group[i][1], group[i + 1][1]) for i in range(n - 1)]
        for order in (range(1, n), range(n - 2, -1, -1)):  # neighbours before, then after
            reach = 0
            for i in order:
                j = i - 1 if order.step > 0 else i + 1
                step = whole[min(i, j)]
                mine, other = group[i][2:], group[j][2:]
                # A suffix of two texts is on a page other than any one's.
                differ = mine != other or mine[0] != mine[1]
                reach = step if differ else min(step, reach)
                best[i] = max(best[i], reach)
        for i, (host, suffix, low, high) in enumerate(group):
            words = suffix.count(" ") if low != high else best[i]
            if words >= depth:
                yield host, suffix, words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple[str, str, bytes, bytes]] = []
        head = None
        out: list[tuple[str, str, int]] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("host", "head", "suffix", "low", "high")), strict=True):
                if row[:2] != head:
                    out += shared(group)
                    group, head = [], row[:2]
                group.append((row[0], *row[2:]))
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.string()), pa.array([r[2] for r in out], pa.int32())], ["host", "suffix", "words"])
                out = []
        out += shared(group)
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.string()), pa.array([r[2] for r in out], pa.int32())], ["host", "suffix", "words"])

    return run


def _settled(share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for texts, parts, repeats in zip(*(batch.column(c).to_pylist() for c in ("texts", "parts", "repeats")), strict=True):
                found = list(zip(texts, parts, strict=True))
                hit = {r["at"] + k for r in repeats or () for k in range(r["words"])}
                covered, token = set(), 0
                for i, (text, part) in enumerate(found):
                    if part == MAIN or not hit:
                        continue
                    size = text.count(" ") + 1
                    if part == UNDECIDED and sum(token + k in hit for k in range(size)) >= share * size:
                        covered.add(i)
                    token += size
                out.append(main_of(found, covered) or main_of(found))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])

    return run


def extract_main(pages: DataFrame, depth: int = DEPTH, span: int = SPAN, share: float = COVERED) -> DataFrame:
    """page_id, url, text and n_chars for every row of `pages` (page_id, url, html).

    A null or empty html has an empty text. The host is the part of the url after //, lower-cased;
    pages without one are a host of their own. Pages of a host with the same text outside boilerplate
    count once for a substring, so copies of an article are no repeats; repeats never take all of a
    page's text, nor any of what is in an article or main element. Pages are read whole, however long. Repeated rows all come back and are treated
    alike. Other columns, whatever their names, are not read. An empty table gives an empty result.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    ident = pages.schema["page_id"].dataType.simpleString()
    read = pages.select("page_id", "url", "html", host.alias("host")).mapInArrow(_parsed, f"page_id {ident}, url string, host string, texts array<string>, parts array<tinyint>, rest string, open boolean, own binary")
    parsed = cut(read.withColumn("pk", F.monotonically_increasing_id()))  # fixed by being written
    suffixes = parsed.select("pk", "host", "own", "open", "rest").mapInArrow(_suffixes(depth, span), "pk long, host string, own binary, open boolean, suffix string, at int")
    distinct = suffixes.groupBy("host", "suffix").agg(F.min("own").alias("low"), F.max("own").alias("high")).withColumn("head", F.substring_index("suffix", " ", depth))
    array = distinct.repartition("host", "head").sortWithinPartitions("host", "head", "suffix")
    repeated = cut(array.mapInArrow(_repeated(depth), "host string, suffix string, words int"))
    hits = cut(suffixes.where("open").join(repeated, ["host", "suffix"]).groupBy("pk").agg(F.collect_list(F.struct("at", "words")).alias("repeats")))
    out = parsed.select("pk", "page_id", "url", "texts", "parts").join(hits, "pk", "left").mapInArrow(_settled(share), f"page_id {ident}, url string, text string")
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
