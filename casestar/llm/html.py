"""Main text of web pages: blocks, page differencing against the nearest URL, declared content.

Method. A page becomes a list of blocks (its lines), each marked by where it stands. Pages of a
host are paired by URL path: the pages that share the longest leading part of the path. The lines
of paired pages are aligned by longest common subsequence, and the shared ones are deleted as
template. What an element declares to be the article (``article``, ``main``) is not template: two
addresses of one article share every line of it, and deleting those would delete the text. There
the differencing only decides about what stands in the article without being marked; in pages
that declare nothing it decides about every line.

Menus, page headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments are known by element, role, or a word of the class or id.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casestar.llm.common import byte_values, staged

# Names of elements and words of attributes.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "xmp")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl
dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu
nav ol p pre section select summary table tbody td tfoot th thead title tr ul""".split())
DROPPED = frozenset("""nav footer aside form head menu dialog button select option label fieldset
input template object canvas audio video""".split())
ROLES = frozenset("""navigation banner contentinfo complementary search form dialog alert
alertdialog menu menubar toolbar""".split())
DROPPED_WORDS = frozenset("""ad ads adv advert advertisement adverts advertising sponsor sponsored
promo promoted promotion banner sidebar aside menu nav navbar navigation breadcrumb breadcrumbs
footer masthead comment comments commentlist disqus respond cookie cookies consent gdpr notice
notices notification alert popup modal overlay newsletter subscribe subscription signup share
sharing social related recommended pagination pager login searchbox toolbar widget paywall""".split())
CONTENT = frozenset(("article", "main"))
CONTENT_WORDS = frozenset(("articlebody", "article-body", "entry-content", "post-content"))
HEADERS = frozenset(("header",))
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?P<rawattrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r".*?(?:</(?P=raw)\s*>|\Z)"
    r"|</(?P<close>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<open>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S | re.I)
_ATTRIBUTE = re.compile(r"([^\s=/]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.S)


def _attributes(raw: str) -> dict[str, str]:
    found = {}
    for name, value in _ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return found


def _marks(name: str, attrs: str, inside_content: bool) -> tuple[bool, bool]:
    """Whether an element is dropped with all it holds, and whether it declares content."""
    found = _attributes(attrs) if attrs.strip(" /\n\t\r") else {}
    role = found.get("role", "").lower()
    label = f"{found.get('class', '')} {found.get('id', '')}".lower()
    words = set(re.split(r"[^a-z]+", label))
    content = (name in CONTENT or role in CONTENT
               or found.get("itemprop", "").lower() in CONTENT_WORDS
               or any(w in label for w in CONTENT_WORDS))
    dropped = (name in DROPPED or role in ROLES or "hidden" in found
               or found.get("aria-hidden", "").lower() == "true"
               or bool(HIDDEN.search(found.get("style", "")))
               or (name in HEADERS and not inside_content))
    if name not in ("html", "body") and words & DROPPED_WORDS:
        # "article-comments" is one; an article of the class "sponsored" still is an article
        dropped = dropped or name not in CONTENT or bool(words & {"comment", "comments"})
    return dropped, content and not dropped


def blocks_of(page: str) -> tuple[list[str], list[bool]]:
    """The blocks of a page that no marked element holds, and whether content elements do."""
    blocks: list[str] = []
    declared: list[bool] = []
    pieces: list[str] = []
    stack: list[tuple[str, bool, bool]] = []
    dropping = holding = 0

    def end() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                blocks.append(text)
                declared.append(holding > 0)
            pieces.clear()

    def leave(depth: int) -> None:
        nonlocal dropping, holding
        while len(stack) > depth:
            _, dropped, content = stack.pop()
            dropping -= dropped
            holding -= content

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at and not dropping:
            pieces.append(page[at:token.start()])
        at = token.end()
        if name := token["open"]:
            name = name.lower()
            if name in BLOCKS:
                end()
                if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
                    # an open element of the kind ends here, but not beyond its container
                    for i in range(len(stack) - 1, -1, -1):
                        held = stack[i][0]
                        if held == name:
                            leave(i)
                            break
                        if held in BLOCKS:
                            break
            elif name == "br":
                pieces.append(" ")
            if name in VOID or token["attrs"].endswith("/") and name not in BLOCKS:
                continue
            dropped, content = _marks(name, token["attrs"], holding > 0)
            stack.append((name, dropped, content))
            dropping += dropped
            holding += content
        elif name := token["close"]:
            name = name.lower()
            if name in BLOCKS:
                end()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    leave(i)
                    break
                # a stray end tag does not end the sections around it
                if stack[i][0] in DROPPED | CONTENT | {"section", "body", "td", "table"} \
                        and name not in DROPPED | CONTENT | {"section", "body", "html", "table"}:
                    break
    if at < len(page) and not dropping:
        pieces.append(page[at:])
    end()
    return blocks, declared


def shared_lines(mine: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which lines of ``mine`` lie in a longest common subsequence with ``other``.

    Common ends are cut off first; the table then only has the rest of each side, one row of bits
    per line of ``mine``.
    """
    shared = np.zeros(len(mine), bool)
    low, most = 0, min(len(mine), len(other))
    while low < most and mine[low] == other[low]:
        low += 1
    high = 0
    while high < most - low and mine[-1 - high] == other[-1 - high]:
        high += 1
    shared[:low] = True
    shared[len(mine) - high:] = True
    a, b = mine[low:len(mine) - high], other[low:len(other) - high]
    common = np.isin(a, b)
    rows, a = np.flatnonzero(common), a[common]
    b = b[np.isin(b, a)]
    if len(a) and len(b):
        places: dict[int, int] = {}
        for i, line in enumerate(b.tolist()):
            places[line] = places.get(line, 0) | 1 << i
        # bit-parallel lengths: a zero bit of a row marks a step of the length (Hyyro 2004)
        full, row, table = (1 << len(b)) - 1, (1 << len(b)) - 1, []
        for line in a.tolist():
            table.append(row)
            hit = row & places[line]
            row = ((row + hit) | (row - hit)) & full
        j = len(b)
        for i in range(len(a) - 1, -1, -1):
            now = (full & ~table[i] & ((1 << j) - 1)).bit_count()
            after = (full & ~row & ((1 << j) - 1)).bit_count()
            if after > now:  # line i is needed; find where it is matched
                while j and (full & ~row & ((1 << (j - 1)) - 1)).bit_count() == after:
                    j -= 1
                shared[low + rows[i]] = True
                j -= 1
            row = table[i]
    return shared


def _line_numbers(blocks: list[str]) -> list[int]:
    return [xxhash.xxh3_64_intdigest(b) - (1 << 63) for b in blocks]


# Lengths of the leading part of a path that pages are paired by, the longest first.
PATH_PARTS = (1 << 20, 24, 16, 12, 9, 7, 5, 3, 1, 0)
# At the first lengths a group may hold any number of pages, and is cut by a hash first.
SALTED = 3
SALTS = 256


def paired(pages: DataFrame) -> DataFrame:
    """``page_id, pair``: pages of a host by twos, now and then threes, that share the longest
    leading part of the URL path; without a pair if the host has no other page.

    Only pages that found nobody go on to a shorter part, at most one for each longer part.
    Groups of long parts, which may have any size, are cut by a hash of the id first.
    """
    left = staged(pages.select("page_id", "host", "path"), "paths")
    found = []
    steps = [(length, salted) for i, length in enumerate(PATH_PARTS)
             for salted in ((True, False) if i < SALTED else (False,))]
    for number, (length, salted) in enumerate(steps):
        keys = [F.col("host"), F.left("path", F.lit(length))]
        if salted:
            keys.append(F.pmod(F.xxhash64("page_id"), F.lit(SALTS)))
        group = Window.partitionBy(*keys)
        ranked = (left.withColumn("_n", F.count("*").over(group))
                  .withColumn("_r", F.row_number().over(group.orderBy("path", "page_id"))))
        pair = F.floor((F.least(F.col("_r"), F.col("_n") - F.col("_n") % 2) - 1) / 2)
        ranked = staged(ranked.withColumn("pair", F.when(F.col("_n") > 1, F.xxhash64(
            F.lit(number), *keys, pair))).drop("_n", "_r"), "paired")
        found.append(ranked.where("pair is not null").select("page_id", "pair"))
        left = ranked.where("pair is null").drop("pair")
        if left.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def url_parts(pages: DataFrame) -> DataFrame:
    """Adds ``host`` and ``path``; a null URL has the empty host."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    return (pages.withColumn("host", F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1)))
            .withColumn("path", F.regexp_replace(url, r"^[a-zA-Z][\w+.-]*://[^/?#]*", "")))


def template_lines(pages: DataFrame) -> DataFrame:
    """``page_id, lines``: the numbers of the lines that a page shares with the pages paired with
    it."""
    id_type = pages.schema["page_id"].dataType.simpleString()

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [_line_numbers(blocks_of(t.decode())[0])
                     for t in byte_values(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lines, pa.list_(pa.int64()))],
                names=["page_id", "url", "hashes"])

    each = staged(pages.select("page_id", "url", "html").mapInArrow(
        numbered, f"page_id {id_type}, url string, hashes array<long>"), "lines")
    pairs = paired(url_parts(each.where("page_id is not null").dropDuplicates(["page_id"])))

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, pair = [], None

        def result() -> pa.RecordBatch:
            out = []
            for i, (page, mine) in enumerate(group):
                hit = np.zeros(len(mine), bool)
                for k, (_, other) in enumerate(group):
                    if k != i:
                        hit |= shared_lines(mine, other)
                if hit.all():  # another address of the same page, or a part of the other page
                    hit[:] = False
                out.append((page, np.flatnonzero(hit).tolist()))
            return pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in out], type=page_type),
                 pa.array([x for _, x in out], pa.list_(pa.int32()))], names=["page_id", "lines"])

        page_type = None
        for batch in batches:
            page_type = batch.schema.field(0).type
            for page, key, lines in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                        batch.column(2)):
                if key != pair and group:
                    yield result()
                    group = []
                pair = key
                group.append((page, np.asarray(lines.values, np.int64)))
        if group:
            yield result()

    sides = (pairs.join(each.dropDuplicates(["page_id"]), "page_id")
             .select("page_id", "pair", "hashes")
             .repartition("pair").sortWithinPartitions("pair", "page_id"))
    return sides.mapInArrow(aligned, f"page_id {id_type}, lines array<int>")


def main_text(page: str, template: list[int] | None) -> str:
    """The main text, given the numbers of its lines that are template."""
    blocks, declared = blocks_of(page)
    if any(declared):
        return "\n\n".join(b for b, d in zip(blocks, declared) if d)
    shared = set(template or ())
    return "\n\n".join(b for i, b in enumerate(blocks) if i not in shared)


def extracted(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``url``, ``text`` and ``n_chars``.

    A null or empty page has the empty text. Pages whose host is unknown or has no other page
    are read without differencing, and so are rows without an id and pages all of whose lines are
    shared with the nearest one (copies): differencing never deletes a whole page. Rows that repeat get the same
    text each. Other columns are ignored.
    """
    base = pages.select("page_id", "url", "html")
    shared = template_lines(base).select(F.col("page_id").alias("_page"), "lines")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(t.decode(), lines) for t, lines in
                     zip(byte_values(batch.column(2)), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return (base.join(shared.hint("merge"), F.col("page_id") == F.col("_page"), "left")
            .select("page_id", "url", "html", "lines")
            .mapInArrow(read, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, "
                              "n_chars long"))
