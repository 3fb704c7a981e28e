import html as escapes
import random
import re

import numpy as np
import pytest

from penprint.llm import pages

CASES = [
    ("<article><h1>T</h1><p>One  two<br>three</p><p>A&amp;B &lt;x&gt; &eacute;&#233;&#x1F600;</p></article>", ["T", "One two three", "A&B <x> éé😀"]),
    ("<body><nav><a>menu</a></nav><header>Site</header><main><p>Text <b>bold</b>er</p><aside>side</aside></main><footer>f</footer>", ["Text bolder"]),
    ("<article><header><h1>Head</h1></header><p>x</p><form><p>mail</p></form><div class='share-buttons'>s</div><footer>by me</footer></article>", ["Head", "x"]),
    ("<article><p>x</p></article><section id=comments><article><p>reader</p></article></section><div class='cookie-notice'>c</div>", ["x"]),
    ("<div class=sidebar><p>s</p></div><div id='content'><p>y</p><script>var a='<p>no</p>';</script><style>p{}</style></div><p>loose</p>", ["y"]),
    ("<p>no container</p><!-- <p>hidden</p> --><div hidden>h</div><div style='display: none'>i</div><ul><li>a</li><li>b</li></ul>", ["no container", "a", "b"]),
    ("<article><p>unclosed <b>bold<p>next<div>in</div>out", ["unclosed bold", "next", "in", "out"]),
    ("<article><p title='a > b'>q</p><textarea>t</textarea><p>5 < 6 &amp 7</p>", ["q", "5 < 6 & 7"]),
    ("plain text &nbsp; only", ["plain text only"]),
    ("", []),
    ("<script>never closed <p>x</p>", []),
]


@pytest.mark.parametrize("html, want", CASES)
def test_blocks(html, want):
    texts, kinds = pages.blocks_of(html)
    assert [t for t, k in zip(texts, kinds) if k != pages.FURNITURE] == want


def test_runs_equal_comparing_all_places():
    rng = np.random.default_rng(3)
    for length in (3, 5, 12):
        tokens = rng.integers(0, 4, 300).astype(np.uint64)
        page = np.sort(rng.integers(0, 9, 300))
        content = page.copy()
        content[page == 4] = 3  # equal streams count once
        covered, _ = pages.repeated(tokens, page, content, length)
        runs = {}
        for i in range(300 - length + 1):
            if page[i] == page[i + length - 1]:
                runs.setdefault(tokens[i : i + length].tobytes(), []).append(i)
        want = np.zeros(300, bool)
        for places in runs.values():
            if len({content[i] for i in places}) > 1:
                for i in places:
                    want[i : i + length] = True
        assert (covered == want).all()


def test_hosts_repeated_runs_and_odd_rows(spark):
    rng = random.Random(4)
    words = lambda n: " ".join(f"v{rng.randrange(5000)}" for _ in range(n))
    notice, link = words(20), words(15)
    rows, want = [], {}
    for k in range(40):  # no article: repeated runs go
        body = words(30)
        rows.append((k, f"http://big.example.com/{k}", f"<div>{notice}</div><p>{body}</p><p>{link} extra{k}</p>"))
        want[k] = f"{body}\nextra{k}"
    for k in range(40, 50):  # an article keeps what other pages repeat
        rows.append((k, f"https://other.example.com/{k}", f"<div>{notice}</div><article><p>{link}</p><p>own{k}</p></article>"))
        want[k] = f"{link}\nown{k}"
    rows.append((50, "http://alone.example.com/", f"<div>{notice}</div><p>{link}</p>"))
    want[50] = f"{notice}\n{link}"
    same = f"<p>{words(40)}</p>"  # copies of one page are one page
    for k in (51, 52):
        rows.append((k, "http://copies.example.com/" + str(k), same))
        want[k] = same[3:-4]
    long = words(60000)
    rows += [(53, None, None), (54, "not an address", ""), (55, "HTTP://U@Big.Example.com:80/z", f"<p>{notice}</p><p>{long}</p>"), (None, "http://q/", "<p>null id</p>"), (50, rows[50][1], rows[50][2])]
    want |= {53: "", 54: "", 55: long, None: "null id"}
    table = spark.createDataFrame([(*r, "keep", 1.5) for r in rows], "page_id bigint, url string, html string, host string, n_chars double").repartition(4)
    for shard in (pages.SHARD, 400):  # one suffix array a host, and many
        out = pages.extracted(table, shard=shard)
        assert out.columns == ["page_id", "url", "host", "text", "n_chars"]
        got = out.collect()
        assert len(got) == len(rows)
        for r in got:
            assert r["text"] == want[r["page_id"]] and r["n_chars"] == len(r["text"]) and r["host"] == "keep"
    assert pages.extracted(table.limit(0)).count() == 0


def test_pages_of_other_arrays_count_whether_they_have_articles_and_copies_do_not(spark):
    rng = random.Random(8)
    words = lambda n: " ".join(f"v{rng.randrange(5000)}" for _ in range(n))
    notice, link = words(20), words(15)
    own = words(30)
    rows, want = [(0, f"<div>{notice}</div><p>{own}</p>")], {0: own}  # the notice stands on article pages besides
    for k in range(1, 13):
        rows.append((k, f"<div>{notice}</div><article><p>{words(20)} own{k}</p></article>"))
        want[k] = rows[-1][1].split("<p>")[1][: -len("</p></article>")]
    body = words(30)
    for k in range(20, 32):  # copies: what only they have stays, what another page has goes
        rows.append((k, f"<p>{link}</p><p>{body}</p>"))
        want[k] = body
    rows.append((32, f"<p>{link}</p><p>alone</p>"))
    want[32] = "alone"
    table = spark.createDataFrame([(k, f"http://host.example.com/{k}", h) for k, h in rows], "page_id bigint, url string, html string").repartition(3)
    for shard in (pages.SHARD, 300):  # one suffix array, and about twenty
        got = {r["page_id"]: r["text"] for r in pages.extracted(table, shard=shard).collect()}
        assert got == want


def test_query_gives_the_articles(spark, small):
    got = {r["page_id"]: r for r in pages.op1_pages(spark, small).collect()}
    rows = spark.read.parquet(f"{small}/pages.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        body = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)[1]
        blocks = [" ".join(escapes.unescape(re.sub(r"</?b>|<br>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        text = "\n".join(b for b in blocks if b)
        assert got[r["page_id"]]["text"] == text and got[r["page_id"]]["n_chars"] == len(text)


def test_runs_in_most_articles_of_a_host_go_and_shared_passages_stay(spark):
    rng = random.Random(9)
    words = lambda n: " ".join(f"v{rng.randrange(5000)}" for _ in range(n))
    notice, passage = words(20), words(30)
    rows, want = [], {}
    for k in range(40):  # in the articles of most pages, of all kinds of marks
        body = words(60) + (f" {passage} " if k < 8 else " ") + words(20)
        advert = f"<p class=x>{notice}</p>" if k % 4 else ""
        rows.append((k, f"http://most.example.com/{k}", f"<article><p>{body}</p>{advert}<p>end{k}</p></article>"))
        want[k] = f"{body}\nend{k}"
    for k in range(40, 44):  # few pages
        body = words(60)
        rows.append((k, f"http://few.example.com/{k}", f"<article><p>{body}</p><p>{notice}</p></article>"))
        want[k] = f"{body}\n{notice}"
    copy = words(60)
    for k in range(50, 70):  # copies of one article are one page
        body = copy if k < 66 else words(40)
        rows.append((k, f"http://copies.example.com/{k}", f"<article><p>{body}</p><p>{notice}</p></article>"))
        want[k] = body
    for k in range(70, 82):  # more than half of the article: it stays
        rows.append((k, f"http://short.example.com/{k}", f"<article><p>{notice}</p><p>own{k}</p></article>"))
        want[k] = f"{notice}\nown{k}"
    for k in range(90, 102):  # an open page of a host whose articles hold a notice
        body = words(60)
        rows.append((k, f"http://mixed.example.com/{k}", f"<article><p>{body}</p><p>{notice}</p></article>" if k % 6 else f"<p>{body}</p><p>{notice}</p>"))
        want[k] = body
    for k in range(110, 120):  # in articles of fewer than five streams
        body = copy if k < 117 else words(30)
        rows.append((k, f"http://same.example.com/{k}", f"<article><p>{body}</p><p>{notice}</p></article>"))
        want[k] = f"{body}\n{notice}"
    rows += [(130, "http://most.example.com/none", None), (131, "http://most.example.com/empty", "")]
    want |= {130: "", 131: ""}
    table = spark.createDataFrame([(k, u, h) for k, u, h in rows], "page_id bigint, url string, html string").repartition(4)
    for shard in (pages.SHARD, 1500):
        got = {r["page_id"]: r["text"] for r in pages.extracted(table, shard=shard).collect()}
        assert [k for k in want if got[k] != want[k]] == []
