import random

import duckdb
from pyspark.sql import functions as F

from quarterline.llm import warc
from quarterline.llm.queries import ORACLES, QUERIES


def test_canonical_addresses(spark):
    cases = [
        ("http://www.Example.com/a/?utm_source=x&b=2&a=1#f", "example.com/a?a=1&b=2"), ("https://example.com:443/a", "example.com/a?"), ("HTTP://u:p@example.com:80", "example.com?"),
        ("https://example.com:8080//", "example.com:8080?"), ("example.com/a", None), ("", None), (None, None), ("http:///x", None), ("http://e.com/?ref=q&&reference=z", "e.com?reference=z"),
    ]
    got = spark.createDataFrame(cases, "url string, want string").select("url", "want", warc.canonical(F.col("url")).alias("got")).collect()
    assert [(r["url"], r["got"]) for r in got] == [(r["url"], r["want"]) for r in got]


def brute(records):
    full = [r for r in records if r["kind"] == "response" and r["status"] == 200 and r["record_id"] is not None]
    out = []
    for r in records:
        if r["kind"] != "revisit":
            continue
        before = [f for f in full if f["url"] == r["url"] and r["url"] and r["captured"] is not None and f["captured"] is not None and f["captured"] < r["captured"]]
        if not before:
            out.append((r["record_id"], None, "unmatched", None))
            continue
        f = max(before, key=lambda x: (x["captured"], x["record_id"]))
        new = {k.lower(): v for k, v in (r["headers"] or {}).items() if v is not None}
        old = {k.lower(): v for k, v in (f["headers"] or {}).items() if v is not None}
        verdict = "unproven"
        for name in ("etag", "last-modified"):
            if name in new and name in old:
                verdict = "resolved" if new[name].removeprefix("W/") == old[name].removeprefix("W/") else "changed"
                break
        merged = old | {k: v for k, v in new.items() if k in warc.PERMITTED}
        out.append((r["record_id"], f["record_id"], verdict, tuple(sorted(merged.items())) if verdict == "resolved" else None))
    return sorted(out, key=repr)


def log(n, hot):
    r, out = random.Random(hot), []
    for i in range(n):
        url = "http://hot.example/" if r.random() < hot else f"http://h{r.randrange(12)}.example/p"
        headers = {"ETag": f"t{r.randrange(3)}"} if r.random() < 0.7 else {"Last-Modified": f"d{r.randrange(2)}"} if r.random() < 0.8 else {}
        headers |= {"Date": str(i), "X-Own": str(i), "CACHE-control": "no" if i % 2 else None}
        kind = r.choice(["response", "revisit", "revisit", "request"])
        out.append({"record_id": i, "url": url, "captured": r.randrange(n // 2), "kind": kind, "status": 404 if r.random() < 0.1 else 200, "headers": headers, "body": f"b{i}"})
    return out + [
        {"record_id": 9001, "url": None, "captured": 5, "kind": "revisit", "status": 304, "headers": {}, "body": None},
        {"record_id": 9002, "url": "http://hot.example/", "captured": None, "kind": "revisit", "status": None, "headers": None, "body": None},
        {"record_id": None, "url": "http://hot.example/", "captured": 1, "kind": "response", "status": 200, "headers": None, "body": None},
        {"record_id": 9003, "url": "http://hot.example/", "captured": 99999, "kind": None, "status": 200, "headers": {}, "body": None},
    ]


def test_against_brute_force(spark):
    for hot in (0.0, 0.4, 0.95):
        records = log(300, hot)
        df = spark.createDataFrame(records, warc.RECORD)
        got = warc.resolve(df.repartition(5)).collect()
        assert sorted([(r["record_id"], r["response_id"], r["verdict"], tuple(sorted(r["headers"].items())) if r["headers"] is not None else None) for r in got], key=repr) == brute(
            [r for r in records])


def test_bodies_and_repeats(spark):
    records = log(60, 0.5)
    df = spark.createDataFrame(records + records[:40], warc.RECORD)
    got = warc.with_bodies(warc.resolve(df), df).collect()
    revisits = [r for r in records + records[:40] if r["kind"] == "revisit"]
    assert len(got) == len(revisits)
    assert all(r["body"] == (f"b{r['response_id']}" if r["verdict"] == "resolved" else None) for r in got)
    assert warc.resolve(spark.createDataFrame([], warc.RECORD)).count() == 0


def test_query_against_its_sql(spark, sf_small):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf_small}/pages.parquet'")
    df = QUERIES["op3_revisits"](spark, sf_small)
    want = con.execute(f"select {', '.join(df.columns)} from ({ORACLES['op3_revisits']})").fetchall()
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)


def test_log_has_several_responses_of_an_address(spark, sf_small):
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    got = warc.resolve(warc.captures(pages)).collect()
    assert {r["verdict"] for r in got} == {"resolved", "changed", "unproven", "unmatched"}
    resolved = [r for r in got if r["verdict"] == "resolved"]
    assert {r["response_id"] % 8 for r in resolved} == {0, 1}  # first and second responses
    assert all(r["captured"] > r["response_captured"] for r in resolved) and not any(r["response_id"] % 8 == 2 for r in got if r["response_id"] is not None)
    latest = {r["record_id"]: r["response_id"] for r in got}
    assert all(latest[i] % 8 == 0 for i in latest if i % 8 == 5 and latest[i] is not None)  # a response at the same second is not earlier
    assert warc.captures(pages.limit(0)).count() == 0


def test_tables_that_are_over_are_removed(spark, sf_small):
    from quarterline.llm import common

    before = len(common._STAGED)
    resolved = warc.resolve(warc.captures(spark.read.parquet(f"{sf_small}/pages.parquet")))
    kept = [path for _, path in common._STAGED[before:]]
    assert kept and not [p for p in kept for name in ("warc-ranges", "warc-carried", "warc-matched") if name in p]
    assert resolved.count() > 0
