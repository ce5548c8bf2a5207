"""Archives come back whole whatever the splits; main texts equal those of an independent reading."""

import base64
import hashlib
import html
import re

import pytest
from pyarrow import fs

from costweave.llm import warc, wrappers
from costweave.session import scratch_path

SCHEMA = "page_id long, url string, html string, payload string, record_type string, host string, wrapper string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA)


ROWS = [
    (1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (5, None, "<p>same</p>"), (5, None, "<p>same</p>"),
    (3, "http://b/\r\nWARC-Type: x", None), (4, "http://b/4", ""), (None, "http://c", "<p>no key</p>"), (None, "http://c", "<p>same</p>"),
    (6, "http://d", "é\r\n\r\n日本 \x1f \u008b" * 10_000), (7, "", "WARC/1.1\r\nWARC-Type: response\r\n\r\n")]


def expected(rows):
    largest, out = {}, []
    for k, _, h in rows:
        largest[h or ""] = max((x for x in (largest.get(h or ""), k) if x is not None), default=None)
    for k, _, h in rows:
        data = (h or "").encode()
        first = largest[h or ""]
        revisit = first is not None and first != k
        out.append((k, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [1, 37, 1000, 1 << 20])
def test_archives_come_back(spark, split):
    folder = scratch_path(spark, "warc-test")
    files = warc.write_archives(pages(spark, ROWS).repartition(3), folder, file_bytes=400)
    rows = warc.read_archives(files, folder, split_bytes=split).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str) == expected(ROWS)
    assert all(bytes(r.payload).decode() in {h or "" for _, _, h in ROWS} for r in rows if r.record_type == "response")
    assert files.count() > 3


def test_short_payloads_and_no_rows(spark):
    folder = scratch_path(spark, "warc-test")
    rows = warc.read_archives(warc.write_archives(pages(spark, ROWS), folder, least_bytes=10**6), folder).collect()
    assert {r.record_type for r in rows} == {"response"} and len(rows) == len(ROWS)
    assert warc.round_trip(pages(spark, ROWS).where("false")).count() == 0


def test_splits_of_one_file_give_what_reading_it_through_gives(tmp_path):
    data = b"".join(warc.record(i, f"u{i}", bytes([i % 251]) * (i * 37 % 3000), hashlib.sha1(bytes([i % 251]) * (i * 37 % 3000)).hexdigest(), None, "d") for i in range(60))
    noise = data[:50] + b"\x1f\x8b\x08 not a member" + data
    for content, n in ((data, 60), (noise, 60)):
        (tmp_path / "f").write_bytes(content)
        with fs.LocalFileSystem().open_input_file(str(tmp_path / "f")) as file:
            for split in (1, 13, 500, 10**6):
                got = [f["warc-record-id"] for s in range(0, len(content), split) for f, _ in warc.records(file, len(content), s, min(len(content), s + split))]
                assert got == [f"<urn:page:{i}>" for i in range(n)]


def test_a_wrong_digest_is_an_error():
    with pytest.raises(ValueError):
        warc._row({"warc-type": "response", "warc-payload-digest": "sha1:AAAA"}, b"HTTP/1.1 200 OK\r\n\r\nx", False)


def plain(page):
    """The article of the test tables' pages, read without wrappers."""
    m = re.search(r"<article>(.*?)</article>", page, re.S)
    blocks = re.split(r"</?(?:p|h1)>", m[1])
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in wrappers.extract(table).collect()}
    for r in table.collect():
        assert got[r.page_id].text == plain(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


PAGE = """<html><head><title>T</title><style>x{{}}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1><nav><ul><li><a href=/>Home</a></li>{menu}</ul></nav></header>
<div class="cookie-notice">We use cookies</div>{main}
<aside>More <b>news</b></aside><section id="comments"><p>Nice!</p></section><footer>&copy; X</footer></body></html>"""


def test_regions():
    article = '<article class="post"><h1>A &amp; B</h1><p>One<br>two <b>three</b><i>four</i></p><!-- no --><div class="ad">Buy</div><p>5 &lt; 6&nbsp;<form>Mail<input></form><ul><li>a<li>b</ul><script>x</script></article>'
    text = "A & B\nOne two threefour\n5 < 6\na\nb"
    page = PAGE.format(menu="<li>x</li>", main=article)
    assert wrappers.main_text(page, None) == text
    others = [PAGE.format(menu="<li>y</li>" * n, main=f"<article class='post'><h1>T{n}</h1>{'<p>q' * n}</article>") for n in (1, 2, 3)]
    wrapper = wrappers.Wrapper(wrappers.infer([*others, page]))
    assert wrappers.main_text(page, wrapper) == text
    assert wrapper.chosen(wrappers.tokens(page)[0]) is not None
    assert all(wrapper.chosen(wrappers.tokens(p)[0]) is not None for p in others)


def test_without_article_the_template_is_left_out():
    def site(n):
        return f"<body><div class=menu>m</div><div class=top>All about us</div><div><p>Text {n}</p>{'<p>more ' + str(n) + '</p>' if n % 2 else ''}</div></body>"

    wrapper = wrappers.Wrapper(wrappers.infer([site(n) for n in range(5)]))
    assert wrappers.main_text(site(7), wrapper) == "Text 7\nmore 7"
    assert wrappers.main_text(site(8), wrapper) == "Text 8"
    assert wrappers.main_text("<div>other form</div>", wrapper) == "other form"


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "http://h/", ""), (3, "x", "<"), (4, "http://h/", "plain & simple"), (None, "http://h/", "<article>a"), (5, "http://h/", "<script>never closed"),
            (6, "http://h/", "<p>" * 3000 + "deep"), (7, "http://h/", "<a href='unclosed>x</a>"), (7, "http://h/", "<a href='unclosed>x</a>"),
            (8, "http://h/", "word " * 100_000)]
    got = {r.page_id: r.text for r in wrappers.extract(pages(spark, rows)).collect()}
    assert got[1] == got[2] == got[5] == "" and got[4] == "plain & simple" and got[None] == "a" and got[6] == "deep"
    assert got[8] == " ".join(["word"] * 100_000)
    assert wrappers.extract(pages(spark, rows)).count() == len(rows)
    assert wrappers.extract(pages(spark, rows).where("false")).count() == 0
