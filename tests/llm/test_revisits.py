import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import revisits as R

SCHEMA = "record_id long, url string, time long, kind string, etag string, last_modified string, headers map<string,string>, block int"


@pytest.mark.parametrize(
    ("url", "key"),
    [
        ("HTTP://WWW.Example.com:80/a/?b=2&utm_source=x&a=1#top", "example.com/a?a=1&b=2"),
        ("https://user:pw@example.com/", "example.com"), ("example.com", "example.com"), ("https://m.x.org/A/B.html?ref=1", "m.x.org/A/B.html"),
        ("http://x.org?q=1", "x.org?q=1"), ("", None), ("http:///a", None), (None, None),
    ],
)
def test_canonical_urls(spark, url, key):
    frame = spark.createDataFrame([(url,)], "url string")
    assert frame.select(R.canonical_url(F.col("url")).alias("k")).first()["k"] == key


def brute(rows, keys):
    out = []
    for r in rows:
        if r[3] != "revisit":
            continue
        key, found = keys[r[1]], None
        if key is not None and r[2] is not None:
            order = lambda x: (x[2], x[0] is not None, x[0] or 0, x[3] == "revisit")
            earlier = [x for x in rows if x[3] == "response" and keys[x[1]] == key and x[2] is not None and order(x) < order(r)]
            found = max(earlier, key=order, default=None)
        if key is None:
            status = "no url"
        elif found is None:
            status = "no earlier response"
        elif r[4] is not None and found[4] is not None:
            status = "merged" if r[4].removeprefix("W/") == found[4].removeprefix("W/") else "validator mismatch"
        elif r[5] is not None and found[5] is not None:
            status = "merged" if r[5] == found[5] else "validator mismatch"
        else:
            status = "no validator"
        headers = None
        if status == "merged":
            own = {k.lower(): v for k, v in (r[6] or {}).items() if k.lower() in R.PERMITTED}
            headers = {**{k.lower(): v for k, v in (found[6] or {}).items()}, **own}
        out.append((r[0], key, status, found and found[0], found and found[2], headers))
    return out


def test_revisits_equal_brute_force(spark):
    rng = random.Random(12)
    urls = ["http://a.org/x", "https://www.a.org/x/#f", "http://b.org/", "http://b.org?utm_a=1", "http://c.org/p?z=1&a=2", None, "http://d.org"]
    rows = []
    for i in range(400):
        url = urls[0] if i % 3 == 0 else rng.choice(urls)
        headers = None if i % 11 == 0 else {"Date": str(i), "ETag": f"e{i}", "Content-Length": "5", "X": str(i)}
        rows.append((
            None if i in (20, 21) else i, url, None if i % 37 == 0 else rng.randrange(60), rng.choice(["response", "revisit", "revisit", "request"]),
            rng.choice([None, '"a"', 'W/"a"', '"b"']), rng.choice([None, "mon", "tue"]), headers, 7,
        ))
    frame = spark.createDataFrame(rows, SCHEMA)
    keys = {r["url"]: r["k"] for r in frame.select("url", R.canonical_url(F.col("url")).alias("k")).distinct().collect()}
    found = [tuple(r) for r in R.resolve_revisits(frame.repartition(3)).collect()]

    def plain(row):
        return str((*row[:5], row[5] and sorted(row[5].items())))

    assert sorted(map(plain, found)) == sorted(map(plain, brute(rows, keys)))


def test_names_in_two_spellings_and_nothing(spark):
    rows = [(1, "http://a.org", 1, "response", "t", None, {"A": "1", "a": "2"}, 0), (2, "http://a.org", 2, "revisit", "t", None, None, 0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert R.resolve_revisits(frame).first()["headers"] == {"a": "1"}
    assert R.resolve_revisits(frame.limit(0)).count() == 0
