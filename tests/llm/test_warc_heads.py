import base64
import gzip
import hashlib
import time

import pytest

from stridelake.llm import warc
from stridelake.llm.common import Scratch
from stridelake.llm.warc import plain_text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<html><head><title>T</title><body><p>Hello</p></body></html>", "T\nHello"),
        ("<head><meta charset=utf-8><link rel=x href=y>\n<style>p{}</style><script>1</script><!-- <body> --><title>T</title><p>Hello<p>you", "T\nHello\nyou"),
        ("<HEAD lang=en><TITLE>T</TITLE>Bare text<p>more", "T\nBare text\nmore"),
        ("<head><title>T</title></head><body><header>Top</header>Hello", "T\nTop\nHello"),
        ("<head><title>T <b></title></meta><noscript><p>no</noscript><body>Hello", "T\nHello"),
        ("<head></head>Hello", "Hello"),
        ("<head>", ""),
    ],
)
def test_a_head_without_end_tag_leaves_the_body(html, text):
    assert plain_text(html) == text


def test_a_long_head_is_read_once():
    assert plain_text("<head>" + "<meta name=a> \n" * 50_000 + "<p>Hello") == "Hello"
    assert plain_text("<head><title>" + "word " * 50_000 + "<p>Hello").endswith("Hello")


@pytest.mark.parametrize("unit", ["<", "<title>", "<title", "<p ", "<!--", "<head><title>", "<script>", "</title", "&#9", "<head>", "x", "&"])
def test_a_page_of_a_million_characters_takes_linear_time(unit):
    began = time.process_time()
    plain_text(unit * (1_000_000 // len(unit)))
    assert time.process_time() - began < 5


def test_markup_that_is_none():
    assert plain_text("a < b and c<d") == "a < b and c<d"
    assert plain_text("<title>T</title><p>x") == "T\nx"
    assert plain_text("&#" + "9" * 5000 + "; y") == "\ufffd y"
    assert plain_text('<a title="x<y">link</a> <!-- <p> a > b --> end') == "link end"
    assert plain_text("<P>One</P><script>if (a<b) { '<p>no' }</script >two<br/>three<!doctype x>") == "One\ntwo\nthree"
    assert plain_text("<body><p>x</p><title>Late</title>y") == "Late\nx\ny"
    assert plain_text("a<b>c</b>d <p") == "acd <p"


def own_parser(content):
    """Records of an unpacked file, by the format's grammar alone."""
    out = []
    while content:
        head, content = content.split(b"\r\n\r\n", 1)
        version, *lines = head.decode().split("\r\n")
        assert version == "WARC/1.1"
        fields = [line.split(": ", 1) for line in lines]
        size = int(dict(fields)["Content-Length"])
        out.append((dict(fields), content[:size]))
        assert content[size : size + 4] == b"\r\n\r\n"
        content = content[size + 4 :]
    return out


def test_files_hold_linked_triples_by_an_independent_parser(spark, tmp_path):
    sha1 = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
    pages = {"1": (" http://a.test/x y ", "<title>T</title><p>One<p>two &amp; three"), "2": (None, None), "3": ("http://b.test/", "plain"), "4": ("u", "<p>" + "w " * 300_000)}
    frame = spark.createDataFrame([(int(k), u, h, f"2024-01-0{k}T00:00:00Z", "x") for k, (u, h) in pages.items()], "page_id long, url string, html string, day string, record string")
    folder = f"file://{tmp_path}/warc"
    index = Scratch(spark, "index").save(warc.write_derivatives(warc.responses(frame, date="day"), folder, file_bytes=500), "index")
    rows = index.collect()
    texts = {"1": "T\nOne\ntwo & three", "2": "", "3": "plain", "4": ("w " * 300_000).strip()}
    assert sorted(r["key"] for r in rows) == ["1", "2", "3", "4"]
    for r in rows:
        packed = (tmp_path / "warc" / r["path"]).read_bytes()
        (page, http), (meta, body), (conv, text) = own_parser(gzip.decompress(packed[r["response_at"] : r["response_at"] + r["size"]]))
        assert [own_parser(gzip.decompress(packed[r[c] :]))[0][0]["WARC-Type"] for c in ("response_at", "meta_at", "text_at")] == ["response", "metadata", "conversion"]
        url, html = pages[r["key"]]
        assert page["WARC-Target-URI"] == meta["WARC-Target-URI"] == conv["WARC-Target-URI"] == (url or "").replace(" ", "%20")
        assert page["WARC-Date"] == meta["WARC-Date"] == conv["WARC-Date"] == f"2024-01-0{r['key']}T00:00:00Z"
        assert meta["WARC-Refers-To"] == conv["WARC-Refers-To"] == page["WARC-Record-ID"]
        assert http.split(b"\r\n\r\n", 1)[1] == (html or "").encode() and text.decode() == texts[r["key"]]
        said = dict(line.split(": ", 1) for line in body.decode().split("\r\n") if line)
        assert said["source-payload-digest"] == page["WARC-Payload-Digest"] == sha1((html or "").encode()) == conv["WARC-Source-Payload-Digest"]
        assert said["source-block-digest"] == page["WARC-Block-Digest"] == sha1(http) and said["conversion-block-digest"] == conv["WARC-Block-Digest"] == sha1(text)
        assert said["source-header-content-type"] == "text/html; charset=utf-8" and said["source-status"] == "HTTP/1.1 200 OK" and said["conversion-record-id"] == conv["WARC-Record-ID"]
    back = warc.read_derivatives(folder, index).collect()
    assert len(back) == 4 and all(r["linked"] for r in back)


def test_no_pages_give_no_files(spark, tmp_path):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/warc"
    index = Scratch(spark, "index").save(warc.write_derivatives(warc.responses(frame), folder), "index")
    assert index.count() == 0 and warc.read_derivatives(folder, index).count() == 0
