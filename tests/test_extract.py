import html
import json

from pyspark.sql import functions as F

from millrace.operators import extract


def test_links_and_titles(spark):
    page = "<title> A &amp;\n B</title><script>'<a href=\"no\">'</script><!-- <a href='no'> --><a class=x href='p.htm'>1</a><a href=\"/q?a=1&amp;b=2\">2</a><a href=\" \">3</a><A HREF=r.htm>4</A>"
    df = spark.createDataFrame([(1, "http://h/d/i.htm", page), (2, "http://h/", "")], "page_id long, url string, html string")
    got = [(r.href, r.absolute) for r in extract.links(df).orderBy("ord").collect()]
    assert got == [("p.htm", "http://h/d/p.htm"), ("/q?a=1&b=2", "http://h/q?a=1&b=2"), ("r.htm", "http://h/d/r.htm")]
    assert [r[0] for r in df.orderBy("page_id").select(extract.page_title(F.col("html"))).collect()] == ["A & B", ""]


def test_directory_pictures(spark):
    tags = ['<img src="a.jpg">', '<img src="b.jpg" width="200" height="300">', '<img src="c.jpg" width="250px" height="150">', '<img src="logo.png">', '<img src="d.gif">', '<img width=1 src="e.jpg" height=x>', "<img alt=none>"]
    df = spark.createDataFrame([("http://h/x/DDG-51.htm", "<title>USS</title>" + "".join(tags))], "url string, html string")
    rows = extract.directory_candidates(df, "maritimequest").orderBy("ord").collect()
    assert [r.image_url for r in rows] == ["http://h/x/a.jpg", "http://h/x/c.jpg"]
    assert all(r.has_hull_in_title and r.source == "maritimequest" and r.title == "USS" and len(r.source_id) == 16 for r in rows)
    assert extract.directory_candidates(df, "navsource").count() == 3


def test_search_json(spark):
    hit = lambda **x: f'<a m="{html.escape(json.dumps(x))}">'
    page = hit(murl="http://h/a.jpg", purl="http://h/p", t="DDG-51 & co") + '<a m="{&quot;murl&quot;: broken}">' + hit(purl="http://h/q") + hit(murl="http://x.alamy.com/b.jpg", purl="", t="")
    df = spark.createDataFrame([(1, page)], "page_id long, html string")
    rows = extract.search_results(df).orderBy("ord").collect()
    assert [(r.image_url, r.title) for r in rows] == [("http://h/a.jpg", "DDG-51 & co"), ("http://x.alamy.com/b.jpg", "")]
    got = extract.search_candidates(extract.search_results(df), "bing").collect()
    assert [(r.image_url, r.has_hull_in_title) for r in got] == [("http://h/a.jpg", True)]
    assert extract.search_candidates(extract.search_results(df), "usni", "alamy.com").count() == 1


def test_api(spark):
    search = json.dumps({"query": {"search": [{"title": "File:A.jpg"}, {"title": "Other"}]}})
    info = {"1": {"title": "File:A.jpg", "imageinfo": [{"thumburl": "http://h/t/A.jpg", "url": "http://h/A.jpg", "width": 800, "height": 600}]}, "2": {"title": "File:B.jpg", "imageinfo": [{"url": "http://h/B.jpg", "width": 10, "height": 600}]}}
    titles = extract.api_titles(spark.createDataFrame([(search,)], "body string"))
    found = extract.api_pictures(spark.createDataFrame([(json.dumps({"query": {"pages": info}}),)], "body string"))
    assert [(r.title, r.image_url) for r in extract.lookup(titles, found).collect()] == [("File:A.jpg", "http://h/t/A.jpg")]
