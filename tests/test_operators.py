import gzip
import io
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusweft.config import LARGE, SMALL, Config
from corpusweft.operators import boilerplate as B, dedup, frontier, langid, stats, windows
from corpusweft.plans import crawl_round, reprocess
from corpusweft.sources import archive, prevertical, seeds, tables
from corpusweft.streaming import crawl, politeness


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_two_stage(spark):
    d = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", "x"), (4, "c", "y"), (5, "", "z"), (6, None, "z"), (7, "d", "")], "doc_id long, text string, html string")
    assert rows(dedup.two_stage(d), "doc_id") == [(1, "kept"), (2, "duplicate-text"), (3, "duplicate-raw"), (4, "kept"), (5, "no-text"), (6, "no-text"), (7, "kept")]
    once = dedup.without(d, dedup.exact_duplicates(d))
    assert dedup.exact_duplicates(once).count() == 0


def test_caps_lose_nothing(spark):
    d = spark.createDataFrame([(i, i % 3) for i in range(50)], "id int, k int")
    first, rest = windows.at_most(d, ["k"], ["id"], 5)
    assert first.count() == 15 and first.unionByName(rest).distinct().count() == 50
    assert rows(windows.keep_first(d, ["k"], ["id"]), "k") == [(0, 0), (1, 1), (2, 2)]


def test_numbered(spark):
    ids = random.Random(1).sample(range(10_000), 500)
    d = spark.createDataFrame([(i,) for i in ids], "id int").repartition(7)
    assert [r["seq"] for r in windows.numbered(d, ["id"]).orderBy("id").collect()] == list(range(500))


def test_language(spark):
    d = spark.createDataFrame([(1, "en", "the cat and the dog"), (2, "de", "der hund und die katze"), (3, "en", ""), (4, "en", None), (5, "de", "###")], "doc_id long, lang string, text string")
    m = langid.model(d)
    got = {r["doc_id"]: r["detected"] for r in langid.detect(d, m.where("gram not like '%#%'")).collect()}
    assert got == {1: "en", 2: "de", 3: None, 4: None, 5: None}
    assert {r["difference"] for r in langid.cosine_matrix(m).where("lang_a = lang_b").collect()} == {0.0}
    assert langid.model(d.where("doc_id = 1"), n=1).where("gram = 't'").first()["n"] == 3


def test_language_by_arrays_and_by_join(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").unionByName(spark.createDataFrame([(-1, None, "en", "a", 0), (-2, " \t\n ", "en", "a", 0), (-3, "x", None, "a", 0), (-4, "a\x00b 😀é", "fr", "a", 0)], "doc_id long, text string, lang string, source string, n_chars long"))
    m = langid.model(d)
    want = sorted(map(tuple, langid.grams(d, ["lang"]).groupBy("lang", "gram").count().collect()), key=repr)
    assert sorted(map(tuple, m.collect()), key=repr) == want
    one, two = (sorted(map(tuple, langid.detect(d, m, most=most).collect())) for most in (10**6, 0))
    assert one == two


def test_classes_by_sets_and_by_join(spark, sf):
    from corpusweft.functions import html as H

    p = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", F.lit("en").alias("lang"), H.parsed_page(F.col("html")).alias("p")).select("page_id", "lang", "p.paragraphs")
    stops = langid.stop_words(spark.read.parquet(f"{sf}/documents.parquet"), 100).select("lang", "word")
    one, two = (B.classify(p, stops, most=most).orderBy("page_id").collect() for most in (10**6, 0))
    assert one == two and len(one) == 50


def test_extraction_by_arrays_and_by_join(spark, sf, monkeypatch):
    docs, pages = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/pages.parquet")
    models, stops = langid.model(docs), langid.stop_words(docs, 100).select("lang", "word")
    for config in (Config(), Config(lang_diff_paragraph=0.3), Config(keep_bad=True, allow_neargood=False)):
        one = reprocess.extracted(pages, stops, models, config).orderBy("page_id").collect()
        with monkeypatch.context() as m:
            m.setattr(reprocess.gramcodes, "small_model", lambda *a, **k: None)
            two = reprocess.extracted(pages, stops, models, config).select(*one[0].__fields__).orderBy("page_id").collect()
        assert [(x[c], y[c]) for x, y in zip(one, two) for c in x.__fields__ if x[c] != y[c]] == []
    strict = reprocess.extracted(pages, stops, models, Config(lang_diff_paragraph=0.3)).agg(F.sum(F.length("text"))).first()[0]
    assert 0 < strict < reprocess.extracted(pages, stops, models).agg(F.sum(F.length("text"))).first()[0]


def counted(row):
    """A function of a page that returns row with, as title, how many of its rows are alive."""
    class Row(dict):
        live = 0

        def __del__(self):
            Row.live -= 1

    def parse(html, *more):
        Row.live += 1
        return Row(row, title=str(Row.live))

    return parse


def long_pages(spark, n=400):
    return spark.range(0, n, 1, 1).select(F.col("id").alias("page_id"), F.lit("en").alias("lang"), F.lit("http://h.org/").alias("url"), F.repeat(F.lit("x"), F.lit(20_000)).alias("html"))


def test_extraction_holds_few_pages(spark, monkeypatch):
    models, stops = spark.createDataFrame([("en", "abc", 1)], "lang string, gram string, n long"), spark.createDataFrame([("en", "the")], "lang string, word string")
    monkeypatch.setattr(reprocess, "extract_page", counted({"paragraphs": [], "hrefs": [], "base": None, "lang": None, "lang_diff": None, "text": ""}))
    most, n = reprocess.extracted(long_pages(spark), stops, models).agg(F.max(F.col("title").cast("int")), F.count("title")).first()
    assert most < 120 and n == 400


def test_classes_hold_few_pages(spark, monkeypatch):
    stops, parse = spark.createDataFrame([("en", "the")], "lang string, word string"), counted({})
    monkeypatch.setattr(B, "free_class", lambda p, *more: p | {"dom_path": (row := parse(None))["title"], "heading": False, "cfclass": "bad", "alive": row})
    p = long_pages(spark).withColumn("paragraphs", F.array(F.struct(F.col("html").alias("text"), F.lit(1).alias("words"), F.lit(0).alias("link_chars"), F.lit("p").alias("dom_path"))))
    for found in (lambda: B.classify(p, stops), lambda: B.classify(long_pages(spark), stops, html="html")):
        most, n = found().agg(F.max(F.col("paragraphs")[0]["dom_path"].cast("int")), F.count(F.col("paragraphs")[0]["text"])).first()
        assert most < 120 and n == 400


def test_classes_of_html(spark, sf):
    from corpusweft.functions import html as H

    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", F.lit("en").alias("lang"), "html").unionByName(spark.createDataFrame([(-1, "xx", None), (-2, None, "")], "page_id long, lang string, html string"))
    stops = langid.stop_words(spark.read.parquet(f"{sf}/documents.parquet"), 100).select("lang", "word")
    parsed = pages.select("page_id", "lang", H.parsed_page(F.col("html"))["paragraphs"].alias("paragraphs"))
    want = B.classify(parsed, stops).orderBy("page_id").collect()
    for most in (10**6, 0):
        assert B.classify(pages, stops, most=most, html="html").select("page_id", "lang", "paragraphs").orderBy("page_id").collect() == want


def test_paragraph_classes_parse_once(spark, sf):
    from corpusweft import queries

    assert queries.paragraph_classes(spark, sf)._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_runs_of_rows():
    import numpy as np
    import pyarrow as pa

    from corpusweft.functions import vectorised as V

    a = pa.array([[{"s": "abc", "i": 1}, {"s": None, "i": 2}], None, [], [{"s": "é", "i": 3}]], pa.list_(pa.struct([("s", pa.string()), ("i", pa.int32())])))
    assert V.row_bytes(a).tolist() == [3 + 2 * 16, 0, 0, 2 + 16] and V.row_bytes(a[1:]).tolist() == [0, 0, 18]
    assert V.row_bytes(pa.array([b"ab", None], pa.binary())).tolist() == [2, 0] and V.row_bytes(pa.array([], pa.string())).tolist() == []
    assert list(V.runs(np.array([1, 2, 9, 1, 1]), 3)) == [(0, 2), (2, 3), (3, 5)] and list(V.runs(np.array([], int), 3)) == []


def paragraph(text, links=0, path="body.p"):
    return {"text": text, "words": len(text.split()), "link_chars": links, "dom_path": path}


def test_classes(spark):
    good = "the cat and the dog sat on the mat with the other cat and the bird in the house of the king and queen today"
    ps = [paragraph("Title", path="body.h1"), paragraph(good), paragraph("short"), paragraph(good), paragraph("nav", 3), paragraph("© x"), paragraph("zz " * 40), paragraph("pick", path="body.select.option")]
    d = spark.createDataFrame([(1, "en", ps), (2, "xx", []), (3, None, None)], "id int, lang string, paragraphs array<struct<text:string,words:int,link_chars:int,dom_path:string>>")
    stops = spark.createDataFrame([("en", w) for w in "the and of in on with".split()], "lang string, word string")
    got = {r["id"]: r["paragraphs"] for r in B.classify(d, stops).collect()}
    assert [p["cfclass"] for p in got[1]] == ["short", "good", "short", "good", "bad", "bad", "bad", "bad"]
    assert [p["class"] for p in got[1]] == ["good", "good", "good", "good", "bad", "bad", "bad", "bad"]
    assert got[2] == [] and got[3] is None


@pytest.mark.parametrize("free,want", [
    (["good", "short", "good"], ["good", "good", "good"]), (["bad", "short", "good"], ["bad", "bad", "good"]), (["bad", "neargood", "bad"], ["bad", "bad", "bad"]),
    (["good", "neargood", "bad"], ["good", "good", "bad"]), (["bad", "neargood", "short", "good"], ["bad", "good", "good", "good"]), (["short"], ["bad"]), ([], []),
])
def test_revision(free, want):
    got = B.revise([{"text": "x" * 60, "heading": False, "cfclass": c} for c in free])
    assert [p["class"] for p in got] == want


def test_efficiency(spark):
    d = spark.createDataFrame([(19, 10**9, 0, 0), (100, 1000, 0, 0), (100, 10**6, 1999, 0), (100, 10**6, 2001, 0), (100, 10**6, 2001, 2001)], "count_downloaded long, bytes_downloaded long, bytes_cleaned long, bytes_primary long")
    assert [r[0] for r in d.select(stats.is_efficient()).collect()] == [True, True, False, True, True]
    assert [r[0] for r in d.select(stats.is_efficient(multilingual=True)).collect()] == [True, True, False, False, True]
    assert abs(SMALL.yield_threshold(1000) - 0.004) < 1e-12 and SMALL.load_cap(501) == 30 and SMALL.load_cap(9001) == 1 and SMALL.kept_paths == 80 and LARGE.max_selected == 100_000


def test_distances_equal_bfs(spark):
    rnd = random.Random(3)
    edges = [(f"n{rnd.randrange(40)}", f"n{rnd.randrange(40)}") for _ in range(70)]
    want, wave = {"n0": 0}, ["n0"]
    while wave:
        wave = [b for a in wave for x, b in edges if x == a and b not in want and not want.update({b: want[a] + 1})]
    got = frontier.distances(spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame([("n0",)], "node string"))
    assert dict(rows(got)) == want


def test_round(spark):
    none = spark.createDataFrame([], "scheme string, host string, path_key long")
    dom = spark.createDataFrame([("http", "a.org", 0, "ready", "10.0.0.1", "FILE", 0, 0, 0, 0, 0, 0, 0)], "scheme string, host string, distance int, status string, ip string, robots string, waited int, idle int, count_downloaded long, bytes_downloaded long, count_cleaned long, bytes_cleaned long, bytes_primary long")
    empty = spark.createDataFrame([], "scheme string, host string, path string, seq long")
    edges = spark.createDataFrame([(None, None, "http", "b.org", "/"), ("http", "a.org", "http", "a.org", "/x"), ("http", "a.org", "http", "c.org", "/y"), ("http", "a.org", "http", "a.org", "/x?sessid=1")], "src_scheme string, src_host string, scheme string, host string, path string")
    state, dumped = crawl_round.admit_edges(crawl_round.State(dom, empty, empty, none), edges, 1)
    assert {(r["host"], r["distance"], r["status"]) for r in state.domains.collect()} == {("a.org", 0, "ready"), ("b.org", 0, "new-ip"), ("c.org", 1, "new-ip")}
    assert dumped.count() == 0 and state.paths.where("host = 'a.org'").count() == 1
    batch, after = crawl_round.select_batch(state)
    assert rows(batch) == [("http", "a.org", "/x", "10.0.0.1", False)] and after.paths.where("host = 'a.org'").count() == 0
    meta = spark.createDataFrame([("http", "a.org", 10**6, 0)] * 200, "scheme string, host string, html_len long, txt_len long")
    assert crawl_round.evaluate(after, stats.domain_counters(meta)).domains.where("host = 'a.org'").first()["status"] == "bad"


def records():
    return [(i, f"http://h{i}.org/p?q={i}", "http", f"h{i}.org", f"/p?q={i}", None if i == 2 else "1.2.3.4", "20200102030405", b"HTTP/1.1 200 OK\r\nContent-Type: text/html", b"<html>" + bytes([65 + i]) * (300 * i) + b"</html>") for i in range(4)]


@pytest.mark.parametrize("kind", ["wpage", "arc", "arc-old"])
@pytest.mark.parametrize("packed", [False, True])
def test_archive(spark, tmp_path, kind, packed):
    out = io.BytesIO()
    archive.write_records(iter(records()), out, kind)
    data = b"broken line\n" + out.getvalue()
    path = tmp_path / ("a.gz" if packed else "a")
    path.write_bytes(gzip.compress(data) if packed else data)
    got = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in archive.read(spark, str(tmp_path), kind).orderBy("wpage_id").collect()]
    assert got == records()
    assert archive.read(spark, str(tmp_path), kind).select(archive.connect_timestamp()).first()[0].year == 2020


def test_archive_lists_and_files(spark, tmp_path):
    for name, part in (("a", records()[:2]), ("b", records()[2:])):
        with (tmp_path / name).open("wb") as f:
            archive.write_records(iter(part), f)
    both = archive.read(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert both.count() == 4 and archive.read(spark, [str(tmp_path / "b")]).count() == 2
    for kind in ("wpage", "arc"):
        out = str(tmp_path / f"out-{kind}")
        archive.write_files(both.coalesce(1), out, kind, most_bytes=300)
        got = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in archive.read(spark, out, kind).orderBy("wpage_id").collect()]
        assert got == records() and len([f for f in (tmp_path / f"out-{kind}").iterdir() if f.name.startswith("part-")]) > 1


def test_archive_cut_off():
    out = io.BytesIO()
    archive.write_records(iter(records()), out)
    assert len(list(archive.records(io.BufferedReader(io.BytesIO(out.getvalue()[:-1])), "wpage"))) == 3


def test_reprocess_archive(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"")
    with (tmp_path / "f").open("wb") as f:
        archive.write_records(iter(records()), f)
    pages, refused = reprocess.from_archive(archive.read(spark, str(tmp_path)))
    assert [r["page_id"] for r in pages.orderBy("page_id").collect()] == [1, 2, 3] and rows(refused.select("wpage_id", "reason")) == [(0, "too-small")]


def test_prevertical(spark, tmp_path):
    p = [{"text": "a <b", "heading": True, "class": "good", "cfclass": "short"}, {"text": "no", "heading": False, "class": "bad", "cfclass": "bad"}]
    d = spark.createDataFrame([(5, "T'x", None, "en", p)], "id long, title string, modified_date string, lang string, paragraphs array<struct<text:string,heading:boolean,class:string,cfclass:string>>")
    prevertical.write(prevertical.documents(d), str(tmp_path / "out"))
    r = prevertical.read(spark, str(tmp_path / "out")).withColumn("good", prevertical.good_paragraphs(F.col("body"))).first()
    assert r["doc_id"] == 5 and r["header"] == '<doc id="5" title="T&apos;x" lang="en">'
    assert r["body"].strip().split("\n") == ['<p heading="1" class="good" cfclass="short">a &lt;b</p>', '<p class="bad" cfclass="bad">no</p>'] and "no" not in r["good"]


def test_seeds(spark, tmp_path):
    (tmp_path / "s").write_text("# c\n\na.org/x\nhttps://b.org\n")
    (tmp_path / "dns").write_text("a.org 1.1.1.1\nhttps b.org 2.2.2.2\n")
    (tmp_path / "t").write_text("http a.org /robots.txt\n")
    (tmp_path / "u").write_text("http://a.org/robots.txt http a.org /robots.txt None\n")
    (tmp_path / "r").write_text("ROBOT_FILE http a.org /f\nROBOT_FAIL http b.org\n")
    (tmp_path / "l").write_text("x.org # c\n#\n")
    at = lambda n: str(tmp_path / n)
    assert rows(seeds.seed_urls(spark, at("s"))) == [(None, None, "http", "a.org", "/x"), (None, None, "https", "b.org", "/")]
    assert rows(seeds.dns_table(spark, at("dns"))) == [("http", "a.org", "1.1.1.1"), ("https", "b.org", "2.2.2.2")]
    assert rows(seeds.seed_triples(spark, at("t"))) == [("http", "a.org", "/robots.txt")]
    assert rows(seeds.url_tuples(spark, at("u"))) == [("http://a.org/robots.txt", "http", "a.org", "/robots.txt", None, True)]
    assert rows(seeds.robots_messages(spark, at("r")), "host") == [("http", "a.org", "FILE", "/f"), ("http", "b.org", "FAIL", None)]
    assert seeds.domain_list(spark, at("l")) == r"(?i)(?:^|\.)(?:x.org)$"


def test_tables(spark, tmp_path):
    d = spark.createDataFrame([("http", "a.org", None, 2, True, 10, 5, 2, 1)], "scheme string, host string, ip string, distance int, bad boolean, bytes_downloaded long, bytes_cleaned long, count_downloaded long, count_cleaned long")
    assert rows(tables.domain_lines(d.select(tables.domain_line().alias("value")))) == rows(d)
    tables.snapshot({"domains": d}, str(tmp_path), "v1")
    (tmp_path / "v2").mkdir()
    assert tables.versions(spark, str(tmp_path)) == ["v1"] and rows(tables.restore(spark, str(tmp_path), ["domains"])["domains"]) == rows(d)
    k = spark.createDataFrame([([1, -2],), ([],)], "k array<long>")
    assert rows(k.select(tables.unpack_keys(tables.pack_keys(F.col("k"))))) == rows(k)


def test_domain_records(spark, tmp_path):
    own = {"scheme": "http", "host": "a.org", "ip": "1.2.3.4", "distance": 2, "bad": False, "bytes_downloaded": 10, "bytes_cleaned": 5, "count_downloaded": 2, "count_cleaned": 1, "new_paths": ["/x", "/é?a b"], "path_keys": [1, -2, 10]}
    none = own | {"host": "b.org", "ip": None, "bad": True, "new_paths": [], "path_keys": []}
    for i, d in enumerate((own, none)):
        (tmp_path / str(i)).write_bytes(tables.domain_bytes(d))
    (tmp_path / "2").write_bytes(b"no record")
    (tmp_path / "3").write_bytes(b"http://c.org None 7 BAD 0 0 0 0 0 0\n\n\n")
    got = [r.asDict() for r in tables.domain_records(spark, str(tmp_path)).orderBy("host").collect()]
    assert got[:2] == [own, none] and (got[2]["host"], got[2]["distance"], got[2]["path_keys"]) == ("c.org", 7, []) and len(got) == 3


def test_logs(spark, tmp_path):
    d = spark.createDataFrame([("http", "a.org", "1.1.1.1")], "scheme string, host string, ip string")
    for batch in (1, 2, 2):  # a batch that is sent again counts once
        tables.append_log(d, str(tmp_path), "dns", batch)
    assert tables.read_log(spark, str(tmp_path), "dns").count() == 2
    q = d.withColumn("path", F.lit("/p")).unionByName(spark.createDataFrame([("http", "b.org", None, "/robots.txt")], "scheme string, host string, ip string, path string"))
    tables.queue_dump(q).coalesce(1).write.text(str(tmp_path / "q"))
    assert rows(seeds.url_tuples(spark, str(tmp_path / "q")), "host") == [("http://a.org/p", "http", "a.org", "/p", "1.1.1.1", False), ("http://b.org/robots.txt", "http", "b.org", "/robots.txt", None, True)]


def test_politeness():
    assert politeness.open_slots(0, 0) == SMALL.open_at_once and politeness.open_slots(SMALL.max_open, 0) == 0 and politeness.open_slots(0, SMALL.page_queue + 1) == 0
    assert politeness.cold_start(1, 10) == [1] * 10 + list(range(1, 10)) + [10] and politeness.seconds_left(100.0, 30.0, 110.0) == 20 and politeness.seconds_left(100.0, 5.0, 110.0) == 0


def test_a_hot_key_in_order(spark):
    n = 60_000
    d = spark.range(n).select("id", (F.col("id") % 3 * 0).alias("k"), ((F.col("id") * 7919) % n).cast("double").alias("at")).unionByName(spark.createDataFrame([(-1, None, 5.0)], "id long, k long, at double"))
    got = politeness.accept_in_order(d, "k", ["at", "id"], "at", 10.0)
    assert got.columns == ["id", "k", "at", "accepted"] and sorted(r["at"] for r in got.where("accepted and k = 0").collect()) == [float(x) for x in range(0, n, 10)]
    assert got.where("k is null and accepted").count() == 1


def test_polite_connections_keep_all(spark):
    d = spark.createDataFrame([(1, "a", "x", 0.0, 1), (2, "b", "x", 0.5, 1), (3, "c", "x", 5.0, 1), (4, "a", "x", 6.0, 2), (5, "b", "x", 7.5, 2), (6, "a", "x", 30.0, 3), (7, "z", "y", 0.0, 1), (8, "z", None, 0.0, 1)], "seq int, host string, ip string, at double, turn int")
    now, later = politeness.polite_connections(d, ["at", "seq"], batch="turn")
    assert [r["seq"] for r in now.orderBy("seq").collect()] == [1, 5, 6, 7, 8] and [r["seq"] for r in later.orderBy("seq").collect()] == [2, 3, 4]


def test_rotation_with_little_room(spark):
    q = spark.createDataFrame([("http", "a", "/1", 1)], "scheme string, host string, path string, seq int")
    w = spark.createDataFrame([("http", "a", "/2", 2), ("http", "b", "/3", 3), ("http", "dead", "/4", 4), ("http", "c", "/5", 5)], "scheme string, host string, path string, seq int")
    queue, waiting = frontier.rotate_waiting(q, w, w.where("host = 'dead'"), room=2)
    assert sorted(r["seq"] for r in queue.collect()) == [1, 2, 3] and [r["seq"] for r in waiting.collect()] == [5]


def test_redirects_are_edges(spark):
    from corpusweft.functions import http

    p = spark.createDataFrame([("http://a.org/x/y", "http://b.org/z", "redirect"), ("http://a.org/q", "http://b.org/z", "redirect"), ("http://a.org/", "http://c.org/f.zip", "redirect"), ("http://a.org/", None, None)], "url string, redirect_url string, reason string")
    edges, refused = http.redirect_edges(p)
    assert rows(edges) == [("http", "a.org", "http", "b.org", "/z")] and rows(refused) == [("http://c.org/f.zip", "path-bad-file-type")]


def finish(spark, q, table, n):
    """Stop a query when its table is full: one with timers or expiring state doesn't end by itself."""
    try:
        for _ in range(40):
            if spark.table(table).count() >= n or not q.isActive:
                break
            time.sleep(1)
    finally:
        q.stop()


def test_stream_equals_batch(spark, tmp_path):
    e = spark.createDataFrame([(i, f"k{i % 3}", float((i * 7) % 50)) for i in range(60)], "id long, k string, at double")
    e.coalesce(1).write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))
    q = crawl.polite(s, "k", 5.0).writeStream.format("memory").queryName("polite").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start()
    finish(spark, q, "polite", 60)
    batch = crawl.accept_in_order(e, "k", ["at", "id"], "at", 5.0)
    assert {(r["id"], r["accepted"]) for r in spark.table("polite").collect()} == {(r["id"], r["accepted"]) for r in batch.collect()}
    q = crawl.first_by_content(s.withColumn("text", F.col("k"))).select("k").writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "d")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r[0] for r in spark.table("once").collect()) == ["k0", "k1", "k2"]


def test_domain_states(spark, tmp_path):
    events = [("a", "robots", "FILE", 0, 0), ("a", "ip", "1.1.1.1", 0, 0), ("b", "ip", "NO_HOST", 0, 0), ("c", "ip", "1.1.1.1", 0, 0), ("c", "robots", "FAIL", 0, 0)]
    d = spark.createDataFrame([("http", *e) for e in events], "scheme string, host string, kind string, value string, size long, size2 long").coalesce(1)
    d.write.parquet(str(tmp_path / "in"))
    s = crawl.domain_states(spark.readStream.schema(d.schema).parquet(str(tmp_path / "in")), Config())
    q = s.writeStream.format("memory").queryName("states").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start()
    finish(spark, q, "states", 3)
    assert {(r["host"], r["status"]) for r in spark.table("states").collect()} == {("a", "ready"), ("b", "bad"), ("c", "bad")}
