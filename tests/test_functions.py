import io
import zipfile

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from corpusweft.config import Config
from corpusweft.functions import convert, html as H, http, robots as R, text as T, url as U, vectorised as V


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def one(spark, values, expr, kind="string"):
    return [r[0] for r in column(spark, values, kind).orderBy("i").select(expr(F.col("x"))).collect()]


def test_split(spark):
    urls = ["HTTP://A.org:80/p%20?q=1#f", "https://a.org", "https://a.org?x=1", "http://u@h.org/a b"]
    got = [tuple(r) for r in one(spark, urls, lambda c: U.url_parts(U.squeeze(c)))]
    assert got == [("http", "A.org:80", "/p?q=1"), ("https", "a.org", "/"), ("https", "a.org", "?x=1"), ("http", "u@h.org", "/ab")]


@pytest.mark.parametrize("lists,url,reason", [
    ({}, "https://fine.example.org/a/b.html", None),
    ({"blacklist": U.domain_list_regex(["bad.org"])}, "https://x.bad.org/abc", "host-blacklisted-domain"),
    ({"blacklist": U.domain_list_regex(["bad.org"])}, "https://notbad.org/abc", None),
    ({"exact_blacklist": ["a.bad.org"]}, "https://a.bad.org/abc", "host-blacklisted-domain"),
    ({"whitelist": U.domain_list_regex(["good.tk"])}, "https://good.tk/abcdef", None),
    ({"whitelist": U.domain_list_regex(["good.tk"])}, "https://evil.tk/abcdef", "host-blacklisted-TLD+not-white-domain"),
    ({"config": Config(tld_whitelist=r"\.cz$")}, "https://site.org/abc", "host-unaccepted-TLD"),
    ({}, None, "url-invalid-or-short"),
])
def test_lists(spark, lists, url, reason):
    assert one(spark, [url], lambda c: U.admission_reason(c, **lists)) == [reason]


def test_empty_pages(spark):
    d = spark.createDataFrame([("https://a.org/xyz", "a.org"), ("https://b.org/xyz", "a.org")], "u string, src string")
    reasons = lambda **k: [r[0] for r in d.select(U.admission_reason(F.col("u"), Config(**k), src_host=F.col("src"), empty_page=F.lit(True))).collect()]
    assert reasons() == [None, "host-empty-page"]
    assert reasons(empty_page_internal_links=False) == ["host-empty-page", "host-empty-page"]
    assert reasons(empty_page_external_links=True, tld_native=r"\.cz$") == [None, "host-empty-page"]


@pytest.mark.parametrize("base,link,want", [
    ("http://h.org/a/b.html", "../c", "http://h.org/c"), ("http://h.org/a/b", "c/", "http://h.org/a/c/"), ("http://h.org/a/b", "?q=1", "http://h.org/?q=1"),
    ("http://h.org/a/b", "//x.org./y", "http://x.org/y"), ("http://h.org", "/a//b/./c", "http://h.org/a/b/c"), ("http://h.org/a", "http://[bad/", None),
])
def test_resolve(base, link, want):
    assert U.resolve(base, link) == want


def test_resolve_standard():
    assert U.resolve("http://h.org/a/b", "?q=1", rfc3986=True) == "http://h.org/a/b?q=1"


@given(st.text(max_size=40), st.text(max_size=40))
def test_resolve_total(a, b):
    U.resolve("http://h.org/" + a, b)


def test_session_tail(spark):
    assert one(spark, ["/a?phpsessid=1&x=2", "/a;auth=z", "/a?utm_source=n", "/a?b=1"], U.session_stripped) == ["/a", "/a", "/a", "/a?b=1"]


def test_display(spark):
    d = spark.createDataFrame([("HTTPS", "A.blogspot.cz", "/x[1]<2>")], "s string, h string, p string")
    assert d.select(U.display_url(F.col("s"), F.col("h"), F.col("p"))).first()[0] == "https://a.blogspot.com/x%5B1%5D&lt;2&gt;"
    x = spark.createDataFrame([("http", "xn--bcher-kva.de", "/")], "s string, h string, p string")
    assert x.select(U.display_url(F.col("s"), F.col("h"), F.col("p"), True)).first()[0] == "http://bücher.de/"


def test_text(spark):
    assert one(spark, ["a b  c", "", None], T.token_count) == [3, 0, 0]
    assert one(spark, [0, 99, 100, 500, 1000, 5000, 10**4, 10**5, 10**6], T.length_bucket, "long") == ["0-100", "0-100", "100-500", "500-1k", "1k-5k", "5k-10k", "10k-100k", "100k-1M", "1M+"]
    assert one(spark, ["20200102030405", "x"], T.stamp_to_minutes) == ["2020-01-02 03:04", "x"]
    assert one(spark, ["<?xml version='1'?><p>", "<p>"], T.without_xml_header) == ["<p>", "<p>"]
    assert one(spark, ['<base target="x" href="http://a.org/b/">'], T.base_href) == ["http://a.org/b/"]
    assert one(spark, ['<meta charset="UTF-8">', "<meta http-equiv='content-type' content='text/html; charset=latin-1'>", "<p>"], T.meta_charset) == ["utf-8", "latin-1", None]
    assert one(spark, ['a"<\\ b>'], U.xml_value) == ["a&quot;&lt; b&gt;"]


RESPONSES = [
    (b"HTTP/1.1 200 OK\r\nA: 1\r\nA: 2\r\n\r\nhello", False, 200, b"hello", None),
    (b"HTTP/1.1 200\r\n\r\nhello", False, 200, b"hello", None),
    (b"200 OK\r\n\r\nhello", False, 200, b"hello", None),
    (b"200\n\nhello", False, 200, b"hello", None),
    (b"", False, None, b"", "empty-status"),
    (b"nonsense\r\n\r\n", False, None, b"", "bad-status"),
    (b"HTTP/1.1 302 Found\r\nLocation: /x\r\n\r\n", False, 302, b"", None),
    (b"HTTP/1.1 302 Found\r\n\r\n", False, 302, b"", "no-location"),
    (b"HTTP/1.1 308 P\r\nLocation: /x\r\n\r\n", False, 308, b"", "not-200"),
    (b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n2\r\nde\r\n0\r\n\r\n", False, 200, b"abcde", None),
    (b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\nzz\r\nabc", False, 200, b"", "bad-chunk"),
    (b"HTTP/1.1 200 OK\r\n\r\n<HTML>x", True, 200, b"", "robots-is-html"),
]


@pytest.mark.parametrize("data,robots,code,body,error", RESPONSES)
def test_response(data, robots, code, body, error):
    r = http.parse_response(data, robots)
    assert (r["code"], r["body"], r["error"]) == (code, body, error)
    assert r["headers"].get("a", "2") == "2"


def test_response_rows(spark):
    rows = [(1, "http://h.org/a", "/a", bytearray(b"HTTP/1.1 200 OK\r\nContent-Type: text/html; x\r\nContent-Length: 99999999\r\nLast-Modified: Tue, 05 Mar 2019 1\r\n\r\n" + b"x" * 300)),
            (2, "http://h.org/a", "/a", bytearray(b"HTTP/1.1 301 M\r\nLocation: b\r\n\r\n")), (3, "http://h.org/a", "/a", bytearray(b"HTTP/1.1 301 M\r\nLocation: /a\r\n\r\n")), (4, "http://h.org/a", "/a", None),
            (5, "http://h.org/robots.txt", "/robots.txt", bytearray(b"HTTP/1.1 200 OK\r\n\r\nUser-agent: *"))]
    d = spark.createDataFrame(rows, "id int, url string, path string, response binary")
    got = {r["id"]: r for r in http.parse_responses(d).collect()}
    assert [got[i]["reason"] for i in range(1, 6)] == ["too-large", "redirect", "redirect-to-self", "empty-status", None]
    assert got[1]["modified_date"] == "2019-03-05" and got[1]["file_type"] == "html" and got[2]["redirect_url"] == "http://h.org/b"
    status = http.robots_status(http.parse_responses(d).withColumn("redir_count", F.lit(0))).where("id in (2, 4, 5)").orderBy("id")
    assert [r["status"] for r in status.collect()] == ["REDIRECT", "FAIL", "FILE"]


ROBOTS = """# all
User-agent: Other
User-agent: weft
Crawl-delay: 5
Disallow: /private
Allow: /private/open   # never reached
Disallow: /*.gif$
Disallow: /a%2Fb

User-agent: *
Disallow: /

Sitemap: http://x/

Useragent: nobody
"""


def test_robots_parse():
    rules = R.parse_robots(ROBOTS)
    assert [(r["ruleset"], r["is_default"], r["allow"], r["path"]) for r in rules] == [(0, False, False, "/private"), (0, False, True, "/private/open"), (0, False, False, "/*.gif$"), (0, False, False, "/a%2Fb"), (1, True, False, "/")]
    assert rules[0]["delay"] == 5.0 and R.parse_robots(None) == [] and R.parse_robots("Disallow: /x") == []


@pytest.mark.parametrize("body,path,want", [
    (ROBOTS, "/private/open", False), (ROBOTS, "/x/y.gif", False), (ROBOTS, "/x.gif?1", True), (ROBOTS, "/pub", True), (ROBOTS, "/a%2fb/c", False),
    ("User-agent: *\nDisallow:", "/x", True), ("User-agent: *\nAllow:\nDisallow: /", "/x", False), ("User-agent: zz\nDisallow: /", "/x", True), ("User-agent: *\nDisallow: /a**b", "/aXb", False),
])
def test_robots_allow(spark, body, path, want):
    robots = spark.createDataFrame([("http", "h", body)], "scheme string, host string, body string")
    paths = spark.createDataFrame([("http", "h", path)], "scheme string, host string, path string")
    assert R.allowed_paths(paths, R.rules_table(robots, "corpusweft")).first()["allowed"] is want


def test_robots_status(spark):
    robots = spark.createDataFrame([("http", "a", "FILE", "User-agent: *\nDisallow: /x"), ("http", "b", "EMPTY", None), ("http", "c", "FAIL", None)], "scheme string, host string, status string, body string")
    paths = spark.createDataFrame([("http", h, p) for h in "abcd" for p in ("/x", "/y")], "scheme string, host string, path string")
    got = lambda ignore: sorted((r["host"], r["path"]) for r in R.filter_allowed(paths, robots, "corpusweft", ignore).collect())
    assert got(False) == [("a", "/y"), ("b", "/x"), ("b", "/y")]
    assert got(True) == [("a", "/y"), ("b", "/x"), ("b", "/y"), ("c", "/x"), ("c", "/y")]


PAGE = """<html><head><base href="http://b.org/d/"><title> A
 title </title><script>var x = "<p>no</p>";</script></head><body><h1>Head</h1><p>One <b>bold text<p>Two<br><br>Three <a href="x
y">link</a></p><a rel="nofollow" href="/no">n</a><select><option>opt</option></select></body>"""


def test_page():
    p = H.parse_page(PAGE)
    assert p["title"] == "A title" and p["base"] == "http://b.org/d/" and p["hrefs"] == ["x\ny"]
    assert [(q["text"], q["link_chars"]) for q in p["paragraphs"]][:4] == [("Head", 0), ("One bold text", 0), ("Two", 0), ("Three link", 4)]
    assert p["paragraphs"][0]["dom_path"].endswith("h1")
    assert H.parse_page(None)["paragraphs"] == [] and H.parse_page("")["title"] == ""


@given(st.text(alphabet="<>/ap bri\"'=&;!-", max_size=60))
def test_page_total(s):
    H.parse_page(s)


def test_links(spark):
    d = spark.createDataFrame([("http://h.org/", PAGE)], "url string, html string")
    r = H.page_links(d).first()
    assert (r["link"], r["host"], r["reason"]) == ("http://b.org/d/xy", "b.org", None)
    assert H.edges(H.page_links(d)).first().asDict() == {"src_scheme": "http", "src_host": "h.org", "scheme": "http", "host": "b.org", "path": "/d/xy"}


def test_links_of_pages_that_share_a_url(spark):
    d = spark.createDataFrame([("http://h.org/", '<a href="/x">1</a><a href="/x">2</a><a href="/y">3</a>'), ("http://h.org/", '<a href="/x">1</a>'), ("http://g.org/", '<a href="/x">1</a>'), ("http://g.org/", None)], "url string, html string")
    want = [("http://g.org/", "http://g.org/x"), ("http://h.org/", "http://h.org/x"), ("http://h.org/", "http://h.org/y")]
    assert sorted(map(tuple, H.regex_links(d).collect())) == want
    assert sorted((r["url"], r["link"]) for r in H.page_links(d).collect()) == want


def test_links_hold_few_pages(spark, monkeypatch):
    class Row(dict):
        live = 0

        def __del__(self):
            Row.live -= 1

    def parse(html):
        Row.live += 1
        return Row(base=f"http://h.org/{Row.live}", hrefs=["x"])

    monkeypatch.setattr(H, "parse_page", parse)
    monkeypatch.setattr(H, "links_of", V.sliced("array<string>")(H.links_of.__wrapped__))  # sent to workers anew
    d = spark.range(0, 400, 1, 1).select(F.concat(F.lit("http://h.org/"), "id").alias("url"), F.repeat(F.lit("x"), F.lit(20_000)).alias("html"))
    most, n = H.page_links(d).agg(F.max(F.regexp_extract("path", r"\d+", 0).cast("int")), F.count("link")).first()
    assert most < 120 and n == 400


def test_responses_come_in_few_rows(spark, monkeypatch):
    class Seen:
        rows = 0

    def parse(data, robots):
        Seen.rows += 1
        return {"code": Seen.rows, "message": None, "headers": {"a": "b"}, "body": data[:1], "error": None}

    monkeypatch.setattr(http, "parse_response", parse)
    sizes = V.sliced("int")(lambda data, robots: [len(data)] * len(data))
    d = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("x"), F.lit(20_000)).cast("binary").alias("x"), F.lit(False).alias("r"))
    most, n = d.select(sizes("x", "r").alias("k")).agg(F.max("k"), F.count("k")).first()
    assert most < 120 and n == 400
    got = d.select(V.sliced(http.PARSED)(http.response.__wrapped__)("x", "r").alias("p")).select("p.*").collect()
    assert [r["code"] for r in got] == list(range(1, 401)) and got[0]["headers"] == {"a": "b"} and got[0]["body"] == b"x"


def test_decode():
    assert H.decode_html("é".encode("latin-1") + b"<meta charset=latin-1>")[0].startswith("é")
    assert H.decode_html("é".encode())[0] == "é" and H.decode_html(b"\xff")[0] is None and H.decode_html(b"a<meta charset=nope>")[0]
    assert H.decode_text(b"\xe9", ("latin-1",)) == "é" and http.robots_text(b"\xe9") == "é"


def _zip(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n, t in files.items():
            z.writestr(n, t)
    return out.getvalue()


def test_docx():
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    item = lambda level, t: f'<w:p><w:pPr><w:numPr><w:ilvl w:val="{level}"/><w:numId w:val="1"/></w:numPr></w:pPr><w:r><w:t>{t}</w:t></w:r></w:p>'
    body = f'<w:p><w:r><w:t>A “q”</w:t><w:tab/><w:t>b</w:t></w:r><w:del><w:r><w:t>gone</w:t></w:r></w:del><w:r><w:rPr><w:vertAlign w:val="superscript"/></w:rPr><w:t>2</w:t></w:r></w:p>{item(0, "x")}{item(1, "y")}{item(1, "z")}{item(0, "v")}<w:p><w:hyperlink r:id="r1"><w:r><w:t>site</w:t></w:r></w:hyperlink></w:p>'
    levels = '<w:lvl w:ilvl="0"><w:start w:val="1"/><w:numFmt w:val="decimal"/><w:lvlText w:val="%1."/></w:lvl><w:lvl w:ilvl="1"><w:start w:val="1"/><w:numFmt w:val="lowerRoman"/><w:lvlText w:val="%1.%2)"/></w:lvl>'
    data = _zip({"word/document.xml": f"<w:document {w}><w:body>{body}</w:body></w:document>", "word/numbering.xml": f'<w:numbering {w}><w:abstractNum w:abstractNumId="0">{levels}</w:abstractNum><w:num w:numId="1"><w:abstractNumId w:val="0"/></w:num></w:numbering>', "word/_rels/document.xml.rels": '<R><x Id="r1" Target="http://s.org"/></R>'})
    assert convert.docx_text(data, show_links=True).split("\n\n") == ['A "q"\tb[2]', "1. x", "1.i) y", "1.ii) z", "2. v", "site [http://s.org]"]
    assert convert.convert(b"no zip", "docx") is None and convert.convert(None, "odt") is None and convert.convert(b"x", "exe") is None


def test_odt():
    t = 'xmlns:text="urn:oasis:names:tc:opendocument:xmlns:text:1.0"'
    assert convert.convert(_zip({"content.xml": f"<d {t}><text:p> a <s>b</s></text:p><text:p/><text:p>c</text:p></d>"}), "odt") == "a b\n\nc"
