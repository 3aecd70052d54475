"""Pages, records, work lists, sources and sinks on synthetic cases."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom import schema, sinks
from fieldloom.functions import text as X
from fieldloom.functions.links import absolutize, host_in
from fieldloom.operators import clean, dom, extract, frontier
from fieldloom.sources import tables

VENDOR = '<div class="vendor"><div class="vendorName"><a><strong> Acme </strong></a></div><div class="w35p bold">Address</div><div> 1 Road<br> Town </div><div class="w35p bold">Phone</div><div>  </div><div class="w35p bold">Tel After Hours</div><div>12</div><div class="w35p bold">Email</div><div><a href="mailto:a@x.example">m</a></div><div class="w35p bold">Website</div><div><a href=" http://w ">w</a></div><div class="w30p fl"><strong>AFTN</strong><div>ZZZ</div></div></div>'
PAGE = f"""<!DOCTYPE html><html><body>
<h1> ZZZZ - Example Field </h1><h2>Located in Sampleton, North, Nowhere, More</h2><h3>Codes: ICAO - ZZZZ, IATA - ZZX, old</h3>
<div class="clearfix mb20px mainInfo"><div class="table"><p class="bold">Customs</p><p class="w38p"> Yes </p></div>
<div class="table"><p class="bold">Customs</p><p class="w45p">No</p></div><div class="table"><p class="bold">Empty</p></div></div>
<div class="clearboth p3xp bold">Lat/Long&nbsp;</div><div class="clearboth p3px">N10&nbsp;</div><div class="clearboth p3xp bold">Alone</div>
<div class="results-content"><div class="clearfix result"><div class="w31p fl bold">TOWER</div><div class="w17p fl p3px"><div>121.7</div></div>
<div class="w30p fl p3px"><div class="clearfix">Phone:</div><div> +1 </div></div><div class="w22p fl p3px"><div><a href="https://t.example">t</a></div></div></div></div>
<div class="fbo">{VENDOR}</div>
<div class="bluePanelContent">{VENDOR.replace("Tel After Hours", "Fax")}</div>
<div class="bluePanelRow clearfix mbGrey"><div class="clearboth"><a><strong class="fs18px">Caterer</strong></a></div><div class="fl w35p bold">Email <a href="mailto:c@x.example">c</a></div><div>x</div></div>
<div class="bluePanelRow clearfix mbGrey noPaddingLR"><div class="fs18px bold">Hotel One</div><div>Phone</div><div>77</div>
<div class="w25p"><div class="fl w100p"> 1 Road <br>  <br>Sampleton</div></div><div class="w20p"><div class="fl w100p">5 Min</div><div class="fl w100p"> </div></div></div>
<div class="bluePanelContent"><input type="hidden" value="42"><div class="w30p fs18px bold">Cars</div><div class="w35p"><div class="fl w65p">99</div></div></div>
<div id="dnn_ctr422_VDC_ctl00_divRunwayDiagram"><p>x<img src="/r/1.jpg"></div></body></html>"""


def test_tree_repairs_and_selectors():
    t = dom.parse("<ul><li>a<li>b<ul><li>c</ul></ul><p>x<p>y<div>z</p>w</div><table><tr><td>1<td>2<tr><td>3</table><b>open<br/>end")
    assert [e.text() for e in dom.select(t, "ul li")] == ["a", "bc", "c"]
    assert [e.text() for e in dom.select(t, "p")] == ["x", "y", ""] and dom.select(t, "div::text") == ["z", "w"]
    assert [len(dom.select(r, "td")) for r in dom.select(t, "tr")] == [2, 1]
    assert dom.select(t, "b::text") == ["open", "end"]
    t = dom.parse('<div class="a b" id="i" data-x="https://q">T<i>1</i> <b>2</b>u</div><div class="a">Phone, fax</div>text<div>n</div>')
    assert dom.select(t, "#i::attr(data-x)") == ["https://q"] and len(dom.select(t, ".a")) == 2 and len(dom.select(t, "div.b.a")) == 1
    assert dom.select(t, '[data-x^="https"] i + b::text') == ["2"] and dom.select(t, '[data-x="https"]') == []
    assert dom.select(t, 'div:contains("Phone, f") + div::text') == ["n"] and dom.select(t, "b + i") == []
    assert dom.select(t, ".a::text, i::text") == ["T", " ", "u", "1", "Phone, fax"] and dom.first(t, "q::text", "d") == "d"
    assert dom.parse("").children == [] and dom.select(dom.parse("<a"), "a") == []
    with pytest.raises(ValueError):
        dom.select(t, "a > b")


def test_page_to_record():
    r = extract.item(PAGE, "https://h.example/p/ZZZZ", True, "img")
    assert r["_error"] is None
    assert r["Airport Details"] == {"Name": "ZZZZ - Example Field", "City": "Located in Sampleton", "Country": "North", "Link": "https://h.example/p/ZZZZ", "ICAO": "ZZZZ", "IATA": "ZZX, old"}
    assert r["Additional Airport Details"] == {"Customs": "No"} and r["Airport Information"] == {"Lat/Long": "N10", "Alone": "N/A"}
    assert r["Contact Information"] == [{"ContactName": "TOWER", "Frequency": "121.7", "Phone": "+1", "Fax": "N/A", "Email": "https://t.example", "Website": "https://t.example"}]
    assert r["FBO Information"] == [{"Name": "Acme", "Address": "1 Road  Town", "Phone": "", "Tel": "12", "Email": "a@x.example", "Website": " http://w ", "Aftn": "ZZZ", "Sita": "N/A"}]
    assert [h["Fax"] for h in r["Handler Inforamtion"]] == ["12"]
    assert [(c["Name"], c["Email"]) for c in r["Caterers Information"]] == [("Caterer", "c@x.example"), ("N/A", "N/A")]
    assert r["Hotel Info"] == [{"Name": "Hotel One", "Phone": "77", "Fax": "N/A", "Website": "N/A", "Address": "1 Road, Sampleton", "Distance": "5 Min", "PriceRange": "N/A"}]
    assert r["Car Rental Info"] == [{"SupplierId": "42", "CompanyName": "Cars", "Phone": "99", "Email": "N/A", "Website": "N/A"}]
    assert (r["Runway Diagram Url"], r["Runway Diagram Local Path"]) == ("https://h.example/r/1.jpg", "img/ZZZZ_runway_diagram.jpg")
    bare = extract.item("<h2>Only</h2><h3>IATA - X</h3>", None)
    assert bare["Airport Details"] == {"City": "Only", "Country": "N/A", "Link": None, "IATA": "X"} and bare["Runway Diagram Url"] is None and bare["Referer Url"] is None


def test_extract_clean_and_errors(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "https://h/p", PAGE), (2, None, None), (3, "u", "<h1>x" + "<div>" * 3000)], "id int, link string, html string")
    out = {r["id"]: r for r in clean.clean(extract.extract(pages, "id", "link", "html")).collect()}
    assert [c["Name"] for c in out[1]["Caterers Information"]] == ["Caterer"] and out[1]["Hotel Info"][0]["Email"] is None
    assert out[2]["Contact Information"] == [] and out[2]["_error"] is None and out[3]["Airport Details"]["Name"] == "x"
    monkeypatch.setattr(extract, "section", lambda page, name: 1 / 0)
    broken = extract.item(PAGE, "l")
    assert broken["_error"].startswith("ZeroDivisionError") and broken["Airport Details"]["ICAO"] == "ZZZZ" and broken["Hotel Info"] == []


def test_harvest(spark):
    index = '<div class="byCountry"><ul><li><a href="/c/1"> ONE </a><li><a href="c2">TWO</a></ul></div>'
    df = spark.createDataFrame([("https://h/x/", index, "k")], "url string, html string, country string")
    assert sorted(map(tuple, extract.index_links(df, ["country"], "url", "html").collect())) == [("k", "ONE", "https://h/c/1"), ("k", "TWO", "https://h/x/c2")]
    listing = '<div class="result clearfix"><div class="col1 w15p fl p10px">AAAA</div><div class="col2 w30p fl p10px"><a href="/p/1">N</a></div><div class="col3 w15p fl p10px">City <br>ST\xa0</div></div><div class="result clearfix"></div>'
    rows = extract.listing_rows(spark.createDataFrame([("https://h/x", listing, "k")], "url string, html string, Country string"), ["Country"], "url", "html").collect()
    assert [tuple(r) for r in rows] == [("k", "AAAA", "N", "City ", "ST\xa0", None, "https://h/p/1"), ("k", None, None, None, None, None, "https://h/x")]


def test_cleaning_cases(spark):
    t = T.StructType([T.StructField("Contact Information", T.ArrayType(schema.record(["ContactName", "Email"]))), T.StructField("FBO Information", T.ArrayType(schema.record(["Name", "CompanyName", "Email"])))])
    entries = [("N/A", None, None), (None, "N/A", None), ("", None, "mailto:a@x "), ("X", None, "https://x"), (None, "X", "N/A"), None]
    df = spark.createDataFrame([([("N/A", "mailto:k")], entries), (None, None)], t)
    out = clean.clean(df).collect()
    assert [tuple(e) for e in out[0]["FBO Information"]] == [("", None, "a@x"), ("X", None, "https://x"), (None, "X", "N/A")]
    assert out[0]["Contact Information"][0]["Email"] == "mailto:k" and out[1]["FBO Information"] is None
    assert clean.clean(clean.clean(df)).collect() == out
    chained = clean.chain(df, (300, lambda d: d.withColumn("b", F.col("a") + 1)), (100, lambda d: d.withColumn("a", F.lit(1))))
    assert chained.first()["b"] == 2


def test_images_after_the_store(spark):
    items = spark.createDataFrame([("u1", "p"), ("u1", None), ("u2", "p"), (None, "p")], "`Runway Diagram Url` string, `Runway Diagram Local Path` string")
    manifest = spark.createDataFrame([("u1", "b", True), ("u1", "a", False), ("u1", "c", True), ("u2", "z", False)], "url string, path string, ok boolean")
    assert sorted((r[0] or "", r[1] or "", r[2] or "") for r in clean.with_images(items, manifest).collect()) == [("", "p", ""), ("u1", "", ""), ("u1", "p", "b"), ("u2", "p", "")]


def test_records_of_both_layouts(spark):
    new = {"Airport Details": json.dumps({"Name": "n", "Link": "l"}), "Additional Airport Details": [{"Group": "g", "Entries": [{"Key": "K", "Value": 3}, {"Key": "K", "Value": "again"}]}, None], "Contact Information": {"ContactName": "c"}, "Car Rental Info": json.dumps([{"CompanyName": "q"}])}
    old = {"Airport Details": {"Name": "m"}, "Additional Airport Details": {"A": "b", "N": None}, "Handler Information": [{"Name": "h"}, None], "Runway Diagram": {"url": "u", "local_path": "lp", "image_name": "i", "referer": "r"}}
    df = spark.createDataFrame([(1, json.dumps(new)), (2, json.dumps(old)), (3, None), (4, "nonsense")], "id int, raw string")
    r = {x["id"]: x for x in schema.read_items(df, "id", "raw").collect()}
    assert r[1]["Airport Details"]["Link"] == "l" and r[1]["Additional Airport Details"] == {"K": "3"} and r[1]["Contact Information"][0]["ContactName"] == "c" and r[1]["Car Rental Info"][0]["CompanyName"] == "q"
    assert r[2]["Additional Airport Details"] == {"A": "b", "N": None} and r[2]["Handler Inforamtion"][0]["Name"] == "h" and r[2]["Runway Diagram Image Name"] == "i" and r[2]["Referer Url"] == "r"
    assert r[3]["Hotel Info"] is None and r[4]["Airport Details"] is None


def test_text_functions(spark):
    df = spark.createDataFrame([("\xa0 A\tb \n", "mailto:x mailto:y ", "a/b/c.d.csv", "YES")], "s string, m string, p string, f string")
    r = df.select(X.py_strip(F.col("s")), X.squeeze(F.col("s")), X.strip_mailto(F.col("m")), X.cut_mailto(F.col("m")), X.strip_extension(X.base_name(F.col("p"))), X.flag(F.col("f")), X.after_marker(F.col("p"), "b", 2, "."), X.after_marker(F.col("p"), "zz", 2)).first()
    assert tuple(r) == ("A\tb", "A b", "x y", "x mailto:y ", "c.d", True, "c", None)


def test_frontier(spark):
    from urllib.parse import urljoin

    base = "https://h.example/a/b"
    links = ["https://x", "/c", "../c/d", "", None, " ", "/x/../y", "/p//q", "?q=1", "//o.example/z", "HTTPS://Up/x", "é", "https://[bad"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(links)], "id int, `Airport Link` string")

    def want(x):
        return (x if x.startswith("http") else urljoin(base, x)).strip()

    got = {r["id"]: r["url"] for r in frontier.frontier(df, base, keep=["id"]).collect()}
    assert got == {i: want(x) for i, x in enumerate(links) if x}
    assert frontier.frontier(df, base, "gone").count() == 0 and frontier.frontier(df, base, "gone", ["id"]).columns == ["id", "url"]
    assert [r["id"] for r in frontier.first_n(df, 2, "id").collect()] == [0, 1] and frontier.first_n(df, 0, "id").count() == len(links)
    with pytest.raises(ValueError):
        frontier.first_n(df, -1, "id")
    names = spark.createDataFrame([(x,) for x in ["b", "a", None, "b", "Z", "é", "ab"]], "f string")
    assert sorted((r["rank"], r["f"], r["n"]) for r in frontier.ranked(names, "f").collect()) == [(1, None, 6), (2, "Z", 6), (3, "a", 6), (4, "ab", 6), (5, "b", 6), (6, "é", 6)]
    assert frontier.ranked(names.limit(0), "f").count() == 0
    urls = spark.createDataFrame([("https://A.aerodex.example:80/x",), ("https://aerodex.example.",), ("https://xaerodex.example/",), ("nope",), (None,), ("https://u@aerodex.example/?q",)], "u string")
    assert [r[0] for r in urls.select(host_in(F.col("u"), "aerodex.example")).collect()] == [True, True, False, False, False, True]
    assert urls.select(absolutize(F.lit(None).cast("string"), F.col("u"))).count() == 6
    assert [r[0] for r in spark.createDataFrame([(200, "a Log Out"), (401, "Log Out"), (None, None)], "s int, h string").select(frontier.logged_in(F.col("s"), F.col("h"))).collect()] == [True, False, False]
    assert frontier.unique(urls.union(urls), "u").count() == 6


@pytest.mark.parametrize("bound", ["10MB", "-1"])
def test_resume(spark, request, bound):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    links = spark.createDataFrame([(1, " a "), (2, "b"), (3, None), (4, "b"), (5, ""), (6, "c")], "id int, l string")
    done = spark.createDataFrame([("a",), (None,), ("",), ("c\xa0",), ("a",)], "l string")
    left = frontier.remaining(links, "l", done, "l")
    assert sorted(r["id"] for r in left.collect()) == [2, 3, 4, 5] and left.columns == ["id", "l"]
    assert tuple(frontier.progress(links, "l", left).first()) == (6, 4, 3)
    assert frontier.remaining(links, "l", done.limit(0), "l").count() == 6


def test_link_files(spark, tmp_path):
    head = "ICAO,Airport Name,City,State,Country,Airport Link\r\n"
    (tmp_path / "B.csv").write_bytes((head + 'AAAA,"N ""q"", x",é,NC\xa0,"C, D",https://x\r\n,,,,,https://x\r\n"","two\nlines",,,,\r\n').encode())
    (tmp_path / "A.csv").write_bytes(head.encode())
    (tmp_path / "skip.txt").write_text("x")
    rows = sorted(tables.read_links(spark, str(tmp_path)).collect(), key=lambda r: r["line_no"])
    assert [r["line_no"] for r in rows] == [1, 2, 3] and tuple(rows[0])[:6] == ("AAAA", 'N "q", x', "é", "NC\xa0", "C, D", "https://x")
    assert rows[1]["ICAO"] == "" and rows[2]["Airport Name"] == "two\nlines" and rows[0]["source_file"].endswith("B.csv")
    assert tables.read_links(spark, str(tmp_path / "none"), "empty").count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_links(spark, str(tmp_path / "none"))
    out = str(tmp_path / "out")
    sinks.write_survivors(tables.read_links(spark, str(tmp_path / "B.csv")).select(*schema.LINK_COLUMNS), out)
    again = tables.read_links(spark, out)
    assert sorted(tuple(r)[:6] for r in again.collect()) == sorted(tuple(r)[:6] for r in rows)
    sinks.write_links(again, str(tmp_path / "by"))
    assert {p.name for p in (tmp_path / "by").glob("group=*")} >= {"group=C, D"}


def test_feeds(spark, tmp_path):
    cases = {"empty": "[\n\n]", "one": '[{"a":"x][y"}]', "many": '[{"a":1}][{"a":2},{"a":3}]\n[\n]', "lines": '{"a":1}\n{"a":2}', "broken": '[{"a":1}] [{"a":', "blank": " "}
    for k, v in cases.items():
        (tmp_path / f"{k}.json").write_text(v)
    got = {}
    for r in tables.read_feeds(spark, str(tmp_path)).collect():
        got.setdefault(r["source_file"].split("/")[-1][:-5], []).append((r["record_no"], r["raw_json"], r["error"] is not None))
    assert sorted(got) == ["broken", "lines", "many", "one"] and len(got["many"]) == 3 and got["one"] == [(1, '{"a": "x][y"}', False)]
    assert sorted(got["broken"]) == [(1, '{"a": 1}', False), (2, None, True)]
    df = spark.createDataFrame([(("n", None), "e")], "`Airport Details` struct<Name:string,City:string>, Email string").withColumn("Fax", F.lit(None).cast("string"))
    assert sinks.export_array(df, str(tmp_path / "o" / "x.json")) == 1
    assert json.loads((tmp_path / "o" / "x.json").read_text()) == [{"Airport Details": {"Name": "n"}, "Email": "e", "Fax": None}]
    sinks.write_feed(df, str(tmp_path / "feed"))
    assert '"Fax":null' in "".join(p.read_text() for p in (tmp_path / "feed").glob("part*"))
    for _ in range(2):
        sinks.append_store(df, str(tmp_path / "store"))
    assert spark.read.parquet(str(tmp_path / "store")).count() == 2
    assert list(sinks.tee(df, None, lambda d: d.count(), lambda d: d.columns[1])) == [1, "Email"]
    sinks.per_input(df.withColumn("f", F.lit("/x/M.N.csv")), "f", str(tmp_path / "per"))
    assert (tmp_path / "per" / "source=M.N").exists()


def test_stream_of_link_files(spark, tmp_path):
    from fieldloom.operators.dedup_index import History
    from fieldloom.streaming.links import deduplicated, link_stream

    head = "ICAO,Airport Name,City,State,Country,Airport Link\n"
    for i, codes in enumerate((["aaaaabbbbb", "cccccddddd"], ["aaaaabbbbb", "cccccdddd0", "eeeeefffff"])):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{i}.csv").write_text(head + "".join(f"I,n,c,s,k,/Field-Info/x-{c}\n" for c in codes))
    h = History(spark, f"file://{tmp_path}/h")
    q = deduplicated(link_stream(spark, str(tmp_path / "in")), h, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert q.exception() is None and spark.read.parquet(str(tmp_path / "out")).where("later_id > first_id").count() == 2


def test_queries_and_sql_agree_at_the_smallest_size(spark):
    import duckdb

    import __spark_entry__ as e

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("link_rows", "country_ref", "airport_items", "feed_files", "detail_rows", "documents", "events"):
        con.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    sql, queries = e.oracle_sql(), e.queries()
    assert set(sql) <= set(queries)
    core = ("p1_found", "p1_values", "p3_found", "p4_found", "p5_found", "p5_profile")
    pages = ("page_details", "page_contacts", "page_hotels", "page_maps", "page_images")
    for name in (*core, *pages, "frontier_urls", "resume_left_anti", "items_clean", "csv_by_country", "json_arrays"):
        df = queries[name](spark, d)
        cols, got = df.columns, sorted(map(repr, (tuple(r) for r in df.collect())))
        want = sorted(map(repr, con.execute(f"select {', '.join(cols)} from ({sql[name]})").fetchall()))
        assert got == want, name
    assert e.entry(spark).count() > 0


def test_url_join_like_the_standard_library(spark):
    """Against the standard library, over references made of parts that matter."""
    from itertools import product
    from urllib.parse import urljoin

    from fieldloom.functions.links import url_join

    heads = ["", "/", "//", "./", "../", "../../", "../../../", "http:", "https:", "HTTPS://h.x", "mailto:", "//o.x/", "/a/", " ", "\t", "a:b", "1:b"]
    tails = ["", "c", "c/", "c/./d", "c/../d", "c//d", "..", ".", "c/..", "?q=1", "c?q=/../x", "#f", "c#f/../g", "?", "#", "c?q#f", "c d", "é", "c\n/d"]
    refs = sorted({a + b for a, b in product(heads, tails)})
    bases = ["https://h.example/a/b/c?x=1#y", "http://h.example", "https://h.example/a/b/", "https://h.example/", "", "/p/q", "https://h.example//a//b/c"]
    df = spark.createDataFrame(list(product(bases, refs)), "b string, r string")
    got = df.select("b", "r", url_join(F.col("b"), F.col("r")).alias("u")).collect()
    assert [(x["b"], x["r"], x["u"], urljoin(x["b"], x["r"])) for x in got if x["u"] != urljoin(x["b"], x["r"])] == []
    assert "ArrowEval" not in df.select(url_join(F.col("b"), F.col("r")))._jdf.queryExecution().toString()
    odd = spark.createDataFrame([("https://h.example/a", None), (None, "x"), ("https://h.example/a", "//[x/y")], "b string, r string")
    assert [x[0] for x in odd.select(url_join(F.col("b"), F.col("r"))).collect()] == ["https://h.example/a", "x", "//[x/y"]
