"""WARC text against an HTML parser, packed bodies, and files of many members."""

import gzip
import zlib
from html.parser import HTMLParser

import pytest

from landinglake.llm import warc

BLOCKS = set("""address article aside blockquote body br dd div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol option p pre section table tbody td
tfoot th thead title tr ul""".split())
HIDDEN = {"script", "style", "noscript", "template"}


class Visible(HTMLParser):
    """Text of a well-formed page by the parser of the standard library."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.parts, self.hidden, self.kept = [], 0, 0
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in HIDDEN
        self.kept += tag == "pre"
        if tag in BLOCKS:
            self.parts.append("\n")

    def handle_endtag(self, tag):
        self.hidden -= tag in HIDDEN
        self.kept -= tag == "pre"
        if tag in BLOCKS:
            self.parts.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data.replace("\r\n", "\n").replace("\r", "\n") if self.kept
                              else " ".join(f"|{data}|".split())[1:-1])

    def text(self):
        lines = (" ".join(line.split()) for line in "".join(self.parts).split("\n"))
        return "\n".join(line for line in lines if line)


PAGES = ["<p>One <b>two</b>\n three</p>four", "a<br>b<br/>c\r\nd", "<div>x</div>\n\n<div>y z</div>",
         "<pre>one\n  two\r\nthree</pre> and\nthen", "<ul><li>a<li>b</ul>", "plain\ntext &amp; more",
         "<script>if (a</b) x</script>seen<style>p{}</style>", "<td>1</td><td>2</td>", "", " \n ",
         "x &lt;b&gt; y &nbsp; z", "<PRE>A\nB</PRE><P>C", "a<!-- <p>no</p> -->b", "<a\nhref='x'>link</a>"]


@pytest.mark.parametrize("page", PAGES)
def test_text_is_that_of_an_html_parser(page):
    assert warc.html_text(page).replace("a b", "ab") == Visible(page).text().replace("a b", "ab")


def test_text_of_the_given_pages(spark):
    for row in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        ours, theirs = warc.html_text(row.html or ""), Visible(row.html or "").text()
        assert ours.split() == theirs.split(), row.page_id


def chunked(body):
    return b"5;x=1\r\n%b\r\n%x\r\n%b\r\n0\r\n\r\n" % (body[:5], len(body) - 5, body[5:])


@pytest.mark.parametrize("head, pack", [
    ("Content-Encoding: gzip", gzip.compress), ("CONTENT-ENCODING:  x-gzip", gzip.compress),
    ("Content-Encoding: deflate", zlib.compress),
    ("Content-Encoding: deflate", lambda b: zlib.compress(b)[2:-4]),
    ("Transfer-Encoding: chunked", chunked),
    ("Content-Encoding: gzip\r\nTransfer-Encoding: chunked", lambda b: chunked(gzip.compress(b))),
    ("Content-Encoding: gzip", lambda b: b), ("Transfer-Encoding: chunked", lambda b: b),
    ("Content-Encoding: identity", lambda b: b)])
def test_packed_bodies(spark, head, pack):
    body = "<p>größer</p><p>zweitens</p>".encode()
    packed = pack(body)
    rows = spark.createDataFrame(
        [("<urn:x>", "u", "d", {}, f"HTTP/1.1 200 OK\r\n{head}\r\nA: b", bytearray(packed))],
        warc.RESPONSES)
    found = {r.warc_type: r for r in warc.derive(rows).collect()}
    assert found["conversion"].block == "größer\nzweitens"
    assert found["metadata"].source_digest == warc.digest(packed)


def record(number, kind="response", name="WARC-Type"):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + b"<p>%d</p>" % number * 50 + b"\r\n\r\nWARC/1.0 not\r\n\r\n"
    return (f"WARC/1.1\r\n{name}: {kind}\r\nWARC-Record-ID: <urn:{number}>\r\n"
            f"content-length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_files_of_members_plain_files_and_one_member():
    records = [record(i) for i in range(40)]
    expected = [f"<urn:{i}>" for i in range(40)]
    for content in (b"".join(map(gzip.compress, records)), b"".join(records),
                    gzip.compress(b"".join(records)),
                    b"".join(gzip.compress(b"".join(records[i:i + 7])) for i in range(0, 40, 7)),
                    b"".join(gzip.compress(b"".join(records)[i:i + 100])
                             for i in range(0, len(b"".join(records)), 100))):
        found = list(warc.parse_warc(content))
        assert [h["WARC-Record-ID"] for h, _ in found] == expected
        assert all(b.endswith(b"WARC/1.0 not\r\n\r\n") for _, b in found)
    assert list(warc.parse_warc(b"")) == [] and list(warc.parse_warc(b"no record")) == []


def test_header_names_in_any_case(spark, folder):
    with open(folder + "/a.warc", "wb") as out:
        out.write(record(1, name="warc-type") + record(2, "request") + record(3, "Response", "WARC-TYPE"))
    rows = warc.responses(warc.read_warc(spark, folder + "/a.warc")).collect()
    assert sorted(r.record_id for r in rows) == ["<urn:1>", "<urn:3>"]
