import random

import duckdb
import pytest
from pyspark.sql import functions as F

from penprint.llm import revisits

URLS = {
    "HTTP://www.Example.com:80/a/?b=2&a=1&utm_source=x#top": "example.com/a?a=1&b=2",
    "https://user:pw@example.com:443/a?ref=1": "example.com/a",
    "https://example.com:80/A//": "example.com:80/A",
    " http://example.com ": "example.com",
    "http://example.com/?": "example.com",
    "no address": None,
    "": None,
    None: None,
}


@pytest.mark.parametrize("url", URLS)
def test_canonical(spark, url):
    assert spark.createDataFrame([(url,)], "u string").select(revisits.canonical(F.col("u"))).first()[0] == URLS[url]


SCHEMA = (
    "record_id bigint, url string, ts bigint, kind string, status int, etag string, last_modified string, digest string, "
    "headers map<string,string>, body string, source string"
)


def brute(rows):
    out = {}
    for r in rows:
        i, url, ts, kind, _, etag, modified, digest = r[:8]
        key = URLS.get(url)
        if kind != "revisit":
            out[i] = ("response", None)
            continue
        full = [f for f in rows if f[3] == "response" and f[4] == 200 and f[9] is not None and key and URLS.get(f[1]) == key and None not in (f[2], ts) and f[2] < ts]
        if not full:
            out[i] = ("no_earlier", None)
            continue
        f = max(full, key=lambda f: (f[2], f[0]))
        pairs = [(x and x.removeprefix("W/"), y and y.removeprefix("W/")) for x, y in ((etag, f[5]), (modified, f[6]), (digest, f[7]))]
        known = [x == y for x, y in pairs if x is not None and y is not None]
        out[i] = ("resolved", f[0]) if known and known[0] else ("mismatch", None)
    return out


def test_latest_earlier_response_and_odd_rows(spark):
    rng = random.Random(8)
    rows = []
    urls = [u for u in URLS]
    for i in range(300):
        url = urls[0] if rng.random() < 0.5 else rng.choice(urls)  # one address holds half of the rows
        kind = rng.choice(["response", "revisit", "revisit", None] if rng.random() < 0.1 else ["response", "revisit"])
        body = rng.choice([f"body{i}", f"body{i}", "", None]) if kind == "response" else None
        headers = rng.choice([None, {}, {"Date": f"d{i}", "ETAG": "h", "Content-Type": "t"}, {"date": "old", "Vary": "v", "Content-Length": str(i)}])
        pick = lambda *v: rng.choice(v)
        rows.append((i, url, rng.choice([None, *range(12)]), kind, rng.choice([200, 200, 404]) if kind == "response" else 304,
                     pick(None, "e1", 'W/e1', "e2"), pick(None, "m1", "m2"), pick(None, "s1", "s2"), headers, body, "x"))
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r["record_id"]: r for r in revisits.resolved(table).collect()}
    by = {r[0]: r for r in rows}
    want = brute(rows)
    assert len(got) == len(rows) and sum(o == "resolved" for o, _ in want.values()) > 20
    for i, (outcome, source) in want.items():
        r = got[i]
        assert (r["outcome"], r["source_id"], r["source"]) == (outcome, source, "x")
        own = {k.lower(): v for k, v in (by[i][8] or {}).items()}
        if outcome == "resolved":
            stored = {k.lower(): v for k, v in (by[source][8] or {}).items()}
            assert r["body"] == by[source][9] and r["status"] == 200
            assert r["headers"] == {**stored, **{k: v for k, v in own.items() if k in revisits.PERMITTED}}
        else:
            assert r["body"] == by[i][9] and r["headers"] == own and r["status"] == by[i][4]
    assert revisits.resolved(table.limit(0)).count() == 0


def test_clashing_header_names_and_repeated_rows(spark):
    rows = [(1, "http://a/", 1, "response", 200, "e", None, None, {"Date": "1", "X": "stored"}, "b", "s"), (2, "http://a/", 2, "revisit", 304, "e", None, None, {"DATE": "2", "x": "not permitted"}, None, "s")]
    out = revisits.resolved(spark.createDataFrame([*rows, rows[1]], SCHEMA)).where("kind = 'revisit'").collect()
    assert [(r["body"], r["headers"]) for r in out] == [("b", {"date": "2", "x": "stored"})] * 2


def test_repeated_ids_neither_double_nor_mix_revisits(spark):
    def row(i, url, ts, kind, etag, body):
        return (i, url, ts, kind, 200 if kind == "response" else 304, etag, None, None, None, body, "s")

    rows = [
        row(1, "http://a/", 1, "response", "e", "at a"), row(1, "http://a/", 1, "response", "e", "at a"), row(2, "http://a/", 2, "revisit", "e", None),
        row(1, "http://b/", 1, "response", "f", "at b"), row(3, "http://b/", 5, "revisit", "f", None), row(1, "http://a/", 7, "response", "g", "later"),
        row(4, "http://a/", 9, "revisit", "g", None), row(5, "http://a/", 4, "revisit", "g", None), row(6, "http://c/", 1, "response", "h", "x"),
        row(6, "http://c/", 1, "response", "h", "y"), row(7, "http://c/", 2, "revisit", "h", None), row(7, "http://c/", 2, "revisit", "h", None),
    ]
    out = revisits.resolved(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert len(out) == len(rows)
    got = sorted((r["record_id"], r["outcome"], r["source_id"], r["body"]) for r in out if r["kind"] == "revisit" and r["record_id"] < 7 and r["body"])
    assert got == [(2, "resolved", 1, "at a"), (3, "resolved", 1, "at b"), (4, "resolved", 1, "later")]
    assert [r["outcome"] for r in out if r["record_id"] == 5] == ["mismatch"]
    both = [r["body"] for r in out if r["record_id"] == 7]
    again = {r["body"] for r in revisits.resolved(spark.createDataFrame(rows[::-1], SCHEMA)).where("record_id = 7").collect()}
    assert len(both) == 2 and len({*both, *again}) == 1


def test_query_equals_its_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{small}/pages.parquet'")
    columns = "record_id, url_key, outcome, source_id, status, body_md5, n_chars, headers"
    want = con.execute(f"SELECT {columns} FROM ({revisits.SQL})").fetchall()
    assert sorted(map(tuple, revisits.op3_revisits(spark, small).collect())) == sorted(want)
