"""Main text of pages, and archives."""

from __future__ import annotations

import gzip
import hashlib
import random

import numpy as np
import pytest
from corpus_samples import CLASHING, frame
from pyspark.sql import functions as F

from casestar.llm import html, warc

PAGES = "page_id long, url string, html string"

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";
</script></head><body><header>Site</header><nav><ul><li><a href="/x">Menu</a></ul></nav><!-- c
--><div class="ad box">Buy</div><article><h1>Head &amp; more</h1><p>One <b>two.<br><p>Three
four&nbsp;five <a href="a>b">six</a><aside>Side</aside><form><input>Send</form>
<section id="comments"><p>Reader</p></section></article><div class="cookie-notice">OK</div>
<footer>&copy; 2024</footer>"""


def test_article_of_a_page():
    assert html.main_text(PAGE, None) == "Head & more\n\nOne two.\n\nThree four five six"


def lcs(a, b) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_shared_lines_are_a_longest_common_subsequence():
    draw = random.Random(4)
    for _ in range(400):
        a, b = ([draw.randrange(5) for _ in range(draw.randrange(9))] for _ in range(2))
        hit = html.shared_lines(np.array(a, np.int64), np.array(b, np.int64))
        kept = [x for x, h in zip(a, hit) if h]
        assert len(kept) == lcs(a, b)
        rest = iter(b)
        assert all(x in rest for x in kept)


def test_template_of_undeclared_pages_goes(spark):
    def page(i: int) -> str:
        return (f"<html><body><div>Welcome to the site</div><div>Own text {i}</div>"
                f"<p>More of {i}</p><div>All rights reserved</div></body></html>")

    rows = [(i, f"http://h{i % 2}.org/a/{i}", page(i)) for i in range(20)]
    rows += [(100, "http://alone.org/", page(100)), (101, None, page(101)), (102, None, None),
             (103, "http://h0.org/a/2", ""), (104, "not a url", page(104)), (None, None, page(7)),
             (105, "http://h1.org/a/3", page(3)), (105, "http://h1.org/a/3", page(3))]
    pages = frame(spark, rows, PAGES).select("*", *[F.lit(1).alias(c) for c in CLASHING])
    found = html.extracted(pages).collect()
    assert len(found) == len(rows)
    text = {r["page_id"]: r["text"] for r in found}
    assert all(text[i] == f"Own text {i}\n\nMore of {i}" for i in range(20) if i not in (3, 2))
    assert text[100].startswith("Welcome") and text[102] == text[103] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert html.extracted(spark.createDataFrame([], PAGES)).count() == 0


def test_a_copy_is_never_deleted_whole(spark):
    """Two addresses of one undeclared article, and a page that is a part of another."""
    article = "<html><body><p>The one article.</p><p>Its end.</p></body></html>"
    longer = article.replace("</body>", "<p>An addendum.</p></body>")
    rows = [(1, "http://a.org/a/1", article), (2, "http://a.org/a/1?ref=x", article),
            (3, "http://b.org/x", article), (4, "http://b.org/y", longer)]
    text = {r["page_id"]: r["text"] for r in html.extracted(frame(spark, rows, PAGES)).collect()}
    assert text[1] == text[2] == text[3] == "The one article.\n\nIts end."
    assert text[4] == "An addendum."  # what it shares with its neighbour goes


def test_very_long_pages_and_equally_near_addresses(spark):
    body = "".join(f"<p>Paragraph {n} of a long page.</p>" for n in range(4000))
    rows = [(i, "http://a.org/same", f"<body><div>Menu here</div><p>Page {i}</p>{body if i == 2 else ''}"
             "<div>Foot</div></body>") for i in range(4)]
    found = [html.extracted(frame(spark, rows, PAGES)).collect() for _ in range(2)]
    texts = [{r["page_id"]: r["text"] for r in rows} for rows in found]
    assert texts[0] == texts[1]
    assert all("Menu" not in t and t.startswith(f"Page {i}") for i, t in texts[0].items())
    assert texts[0][2].count("Paragraph") == 4000


def archive(version: int, records: list[tuple[str, bytes]]) -> bytes:
    more = "200 - - 0 - " if version == 2 else ""
    block = f"{version} 0 x\n{warc.ARC_FIELDS[version]}\n".encode()
    out = f"filedesc://x 0.0.0.0 20240102030405 text/plain {more}{len(block)}\n".encode()
    out += block + b"\n"
    for url, body in records:
        out += f"{url} 1.2.3.4 20240102030405 text/html {more}{len(body)}\n".encode()
        out += body + b"\n"
    return out


@pytest.mark.parametrize("version", [1, 2])
def test_arc_records(version):
    records = [("http://a/", b"HTTP/1.1 200 OK\r\n\r\nbody\n\nhttp://b/ 1 2 3 4\n"), ("dns:a", b"")]
    content = archive(version, records)
    for stored in (content, gzip.compress(content[:40]) + gzip.compress(content[40:])):
        found = list(warc.arc_records(stored))
        assert [(f["URL"], b) for f, b in found] == records
    with pytest.raises(ValueError, match="declares"):
        list(warc.arc_records(archive(version, records[:1])[:-5]))
    with pytest.raises(ValueError, match="version block"):
        list(warc.arc_records(b"http://a/ 1.2.3.4 20240102030405 text/html 0\n"))


def test_dates():
    assert warc.warc_date("20240102030405") == "2024-01-02T03:04:05Z"
    assert warc.warc_date("199607") == "1996-07-01T00:00:00Z"


def test_archives_round_trip(spark):
    same = "é" * 800
    rows = [(1, "http://a/", same), (2, "http://b/ c", same), (3, None, same), (4, "u", "short"),
            (5, "u", "short"), (6, "", None), (7, "http://x/", "a\r\n\r\nWARC/1.1\r\n" * 90),
            (8, "http://x/", "tail\n"), (8, "http://x/", "tail\n"), (None, None, "no id"),
            (9, "http://long/", "0123456789" * 200_000)]
    found = warc.archived(frame(spark, rows, PAGES).withColumn("content", F.lit(1))).collect()
    assert len(found) == len(rows)
    by_id = {r["page_id"]: r for r in found}
    for page, _, body in rows:
        payload = (body or "").encode()
        assert by_id[page]["payload_bytes"] == len(payload)
        assert by_id[page]["payload_digest"] == hashlib.sha1(payload).hexdigest()
    assert {p: (r["record_type"], r["refers_to"]) for p, r in by_id.items()} == {
        p: ("revisit", 3) if p in (1, 2) else ("response", None) for p in by_id}
    assert warc.archived(spark.createDataFrame([], PAGES)).count() == 0
