from pyspark.sql import functions as F

from penprint.operators import catalogue

PAGE = (
    "<html><head><script>var a='<span class=\"p\">no</span>';</script></head><body>skip"
    "<span class='nav p x'>One <b>two</b><span>three</span> &laquo;4&raquo; &#1078;&#x416;</span>"
    "<!-- <span class=\"p\">no</span> --><span class='pp'>no</span><span>no</span>"
    "<SPAN CLASS=p>5 &amp;lt; 6</SPAN><p>no</p></body></html>"
)


def test_page_text(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, ""), (3, "<span class=\"p\">open &unknown; a < b&#9999999;&#xD800;")], "id int, html string")
    rows = {r["id"]: r["text"] for r in catalogue.extract_page_text(pages).collect()}
    assert rows == {1: "One twothree «4» жЖ5 &lt; 6", 2: "", 3: "open &unknown; a < b\ufffd\ufffd"}


def test_assemble(spark):
    rows = [("w", i, 1000 + i, f"[{i}]") for i in range(600)] + [("v", 2, 5, "b"), ("v", 1, 9, "a")]
    pages = spark.createDataFrame(rows, "work string, page int, id int, text string").repartition(7)
    found = catalogue.assemble_works(pages, "work", "page", "id").collect()
    got = {r["work"]: (r["text"], r["n_pages"]) for r in found}
    assert got == {"v": ("ab", 2), "w": ("".join(f"[{i}]" for i in range(600)), 600)}
    small = catalogue.assemble_works(pages, "work", "page", "id", block=7).collect()
    assert {r["work"]: (r["text"], r["n_pages"]) for r in small} == got
    places = catalogue.ordered_pages(pages, "work", "page", "id").where("work = 'w'").orderBy("place").collect()
    assert [(r["place"], r["text"]) for r in places] == [(i, f"[{i}]") for i in range(600)]


def test_character_references(one):
    for given, want in [
        ("caf&eacute; &euro;5 &ouml;", "café €5 ö"), ("&CounterClockwiseContourIntegral;", "∳"), ("&bne; &nosuch; & &;", "=⃥ &nosuch; & &;"),
        ("&#0000000065;&#x0000041;&#99999999999999999999;", "AA\ufffd"), ("&amp;lt;", "&lt;"),
    ]:
        assert one(given, catalogue.unescape) == want


def test_urls(spark):
    df = spark.createDataFrame([("http://a.b/fr/12?page=3&x=1",), ("https://a.b/en/7/",), ("http://a.b/x?page=99999999999",)], "u string")
    got = [tuple(r) for r in df.select(catalogue.page_key("u"), catalogue.page_number("u")).collect()]
    assert got == [("fr/12", 3), ("en/7", 1), ("", 1)]


def test_titles(spark):
    tasks = spark.createDataFrame([("a",), ("b",), ("a",)], "title string")
    found = spark.createDataFrame([("b",), ("c",)], "title string")
    assert {r["title"]: r["known"] for r in catalogue.plan_titles(tasks, found).collect()} == {"a": False, "b": True}
    assert [r["title"] for r in catalogue.missing_titles(tasks, found).collect()] == ["a"]


def test_author_ids(spark):
    works = spark.createDataFrame([(i, f"author{(i * 7) % 12}") for i in range(40)], "ord int, author string")
    rows = {r["author"]: (r["author_id"], r["prefix"]) for r in catalogue.assign_author_ids(works, "author", "ord").collect()}
    assert rows["author0"] == (0, "author_id_00") and rows["author7"] == (1, "author_id_01")
    assert rows["author5"] == (11, "author_id_11")
    names = catalogue.author_names(spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "author_id int, author string"))
    assert {r["author_id"]: r["author"] for r in names.collect()} == {1: "b", 2: "c"}


def test_labels(spark):
    df = spark.createDataFrame([("b", 3), ("a", -1), ("c", 99)], "lang string, author int")
    rows = catalogue.map_labels(catalogue.encode_labels(df, "lang"), "author").orderBy("lang").collect()
    assert [r["label_id"] for r in rows] == [0, 1, 2]
    assert [r["name"] for r in rows] == ["не могу определить автора", "А. Чехов", None]
    assert rows[0]["lang"] == "a" and F is not None
