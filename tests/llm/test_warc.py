import hashlib
import html
import json
import random
from html.entities import html5

from newslake.llm import warc
from pyspark.sql import functions as F

SCHEMA = "page_id long, url string, html string, block string"
HTML = (
    "<html><head><title>A &amp; B</title><style>p{x}</style></head><body><!-- no --><h1>Head</h1>"
    "<p>One <b>two</b>&nbsp;three<br>four &lt;5&gt;</p><script>var t='</p>';</script>\n\n<ul><li><a href=\"/x?a=1&amp;b=2\">"
    "link</a></li></ul></body></html>"
)


def derived(spark, rows):
    return warc.derived(warc.responses(spark.createDataFrame(rows, SCHEMA)))


def test_records_of_a_page(spark):
    rows = {r.type: r for r in derived(spark, [(1, "http://a/b", HTML, "x")]).collect()}
    text, meta = rows["conversion"], rows["metadata"]
    assert text.block == "A & B\nHead\nOne two three\nfour <5>\nlink"
    digest = "sha256:" + hashlib.sha256(HTML.encode()).hexdigest()
    for r in (text, meta):
        assert r.content_length == len(r.block.encode())
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
        assert r.source_digest == digest and r.target_uri == "http://a/b"
    assert text.refers_to == meta.refers_to and len({text.record_id, meta.record_id, text.refers_to}) == 3
    told = json.loads(meta.block)
    assert told["title"] == "A & B" and told["links"] == ["/x?a=1&b=2"] and told["payload_digest"] == digest
    assert told["status"] == "HTTP/1.1 200 OK"
    assert {h["name"]: h["value"] for h in told["headers"]} == {
        "Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(HTML.encode())),
    }


def test_all_references_are_decoded(spark):
    rng = random.Random(4)
    texts = [f"a &{name} b" for name in html5] + [f"&#{n};&#x{n:x}" for n in [*range(300), 8217, 0x1F600, 0xFEFF, 0xD800]]
    texts += ["&#00065;", "&#x110000;", "&#99999999999999999999;", "&#x1ffff;", "&amp;copy;", "&#38;lt;", "&", "&&", "&#;", "&#x;"]
    parts = ["&", "#", "x", "amp", "not", "in", "it", ";", "copy", "=", "1", "27", "8217", "é", " ", "lt", "&notin;"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(2_000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, plain in rows.select("t", warc._plain(F.col("t"))).collect():
        assert plain == html.unescape(t).replace("\u00a0", " "), t


def test_references_in_records(spark):
    page = "<title>&copy; &#8217;</title><p>&copy; 1 &middot; &#x27;&amp;copy;</p><a href='/?a=1&copy=2&amp;b=&eacute;'>x</a>"
    rows = {r.type: r for r in derived(spark, [(1, "u", page, "x")]).collect()}
    assert rows["conversion"].block == "© ’\n© 1 · '&copy;\nx"
    told = json.loads(rows["metadata"].block)
    assert told["title"] == "© ’" and told["links"] == ["/?a=1&copy=2&b=é"]


def test_headers_without_blanks(spark):
    pages = warc.responses(spark.createDataFrame([(1, "u", "", "x")], SCHEMA))
    headers = "HTTP/1.1 200 a: b\r\nServer:x\r\nDate: 10:20:30 \r\nA:\t b:c\r\nEmpty:\r\nnone"
    meta = warc.derived(pages.withColumn("headers", F.lit(headers))).where("type = 'metadata'").first()
    told = json.loads(meta.block)
    assert [(h["name"], h["value"]) for h in told["headers"]] == [
        ("Server", "x"), ("Date", "10:20:30"), ("A", "b:c"), ("Empty", ""),
    ]
    assert told["status"] == "HTTP/1.1 200 a: b"


def test_odd_pages(spark):
    rows = [(1, None, None, "x"), (1, None, None, "x"), (2, "u\r\nWARC-Type: x", "", None), (None, "v", "<p>é" * 20_000, "x")]
    found = derived(spark, rows).collect()
    assert len(found) == 8
    assert len({r.record_id for r in found}) == 6
    assert {r.target_uri for r in found} == {"", "u WARC-Type: x", "v"}
    assert max(r.content_length for r in found) == 20_000 * 3 - 1
    assert derived(spark, [])  .count() == 0


def test_files_round_trip(spark, tmp_path):
    tricky = "WARC/1.1\r\nContent-Length: 3\r\n\r\n<pre>\n\n\n a\r\n</pre>é"
    pages = [(i, f"http://x/{i}", html, "x") for i, html in enumerate([HTML, tricky, "", "<title>x\r\n\r\ny</title>"])]
    records = derived(spark, pages).select(*warc.RECORD)
    warc.write(records.repartition(3), str(tmp_path / "out"))
    back = warc.read(spark, str(tmp_path / "out"))
    key = lambda df: sorted(map(tuple, df.select(*warc.RECORD).collect()))
    assert key(back) == key(records)


def test_file_is_a_warc(spark, tmp_path):
    warc.write(derived(spark, [(1, "http://a/b", HTML, "x")]).coalesce(1), str(tmp_path / "out"))
    (file,) = (tmp_path / "out").glob("part-*")
    data, records = file.read_bytes(), 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        assert lines[0] == "WARC/1.1" and fields["WARC-Refers-To"].startswith("<urn:uuid:")
        n = int(fields["Content-Length"])
        assert fields["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(rest[:n]).hexdigest()
        assert rest[n : n + 4] == b"\r\n\r\n"
        data, records = rest[n + 4 :], records + 1
    assert records == 2


def test_links_end_at_their_own_quote(spark):
    page = """<a href="/it's?x=1">a</a> <a class=x href='/say "hi"'>b</a> <a href=/plain>c</a> <A HREF = "">d</A> <a href="/a&amp;b">e</a>"""
    meta = derived(spark, [(1, "http://a/b", page, "x")]).where("type = 'metadata'").first()
    assert json.loads(meta.block)["links"] == ["/it's?x=1", '/say "hi"', "/plain", "", "/a&b"]
