"""Not-modified revisits: each is resolved against the latest earlier full response of its canonical address.

Records are dealt by ranges of (address, time), so an address with a third of all records spreads over many tasks;
the last response of each range and address is carried on to the ranges that follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterline.llm.common import discard, staged

# Headers of a 304 response that replace the stored ones, and parameters that only track visitors.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]
TRACKING = "^(utm_[a-z]+|gclid|fbclid|ref)(=|$)"

RECORD = "record_id long, url string, captured long, kind string, status int, headers map<string,string>, body string"


def canonical(url: Column) -> Column:
    """Host without www, port 80 or 443 and user; path without a closing slash; sorted query without tracking.

    Scheme and fragment do not count. Null where there is no scheme and host.
    """
    authority = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(url, r"^[^:]*://[^/?#]*([^?#]*)", 1), r"/+$", "")
    query = F.filter(F.split(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    return F.when(host != "", F.concat(host, path, F.lit("?"), F.array_join(F.array_sort(query), "&")))


def _header(name: str) -> Column:
    return F.get(F.map_values(F.map_filter("headers", lambda k, v: F.lower(k) == name)), 0)


def resolve(records: DataFrame) -> DataFrame:
    """A row per revisit record: record_id, address, captured, response_id, response_captured, verdict, headers.

    ``records``: record_id, url, captured, kind (response or revisit), status, headers. A full response has kind
    response and status 200. The response is the latest captured strictly before the revisit; of one time the larger
    record_id. Entity tags decide where both have one (weakly compared), else the dates of last modification.
    verdict: resolved, changed (validators differ), unproven (none in common), unmatched (no earlier response; also
    null or malformed addresses and null times). headers: the response's, overlaid by the revisit's permitted ones,
    names in small letters; null unless resolved. Records of other kinds, null record_ids among them, are ignored.
    Repeated records: responses count once, revisits come back each. An empty table gives an empty result.
    """
    rows = records.select(
        "record_id", canonical(F.col("url")).alias("address"), "captured", F.col("kind").alias("kind"),
        F.regexp_replace(_header("etag"), "^W/", "").alias("etag"), _header("last-modified").alias("modified"), "headers",
        ((F.col("kind") == "response") & (F.col("status") == 200) & F.col("record_id").isNotNull()).alias("full"))
    rows = rows.where("full or kind = 'revisit'").withColumn("full", F.coalesce("full", F.lit(False)))
    usable = rows.where("address is not null and captured is not null")
    # at one time revisits come before responses, which are not strictly earlier
    order = ["captured", "full", "record_id"]
    ranged = staged(usable.repartitionByRange("address", "captured").withColumn("part", F.spark_partition_id()), "warc-ranges")
    found = F.when(F.col("full"), F.struct("captured", "record_id", "etag", "modified", "headers"))
    tails = ranged.where("full").groupBy("part", "address").agg(F.max(F.struct("captured", "record_id")).alias("tail"))
    places = ranged.select("part", "address").distinct().join(tails, ["part", "address"], "left")
    before = Window.partitionBy("address").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = staged(places.withColumn("carried", F.last("tail", ignorenulls=True).over(before)).drop("tail"), "warc-carried")
    within = Window.partitionBy("part", "address").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    near = ranged.select("part", "address", "captured", "record_id", "etag", "modified", "headers", "full",
                         F.last(F.when(F.col("full"), F.struct("captured", "record_id")), ignorenulls=True).over(within).alias("near"))
    revisits = staged(near.where("not full").join(carried, ["part", "address"]).withColumn("at", F.coalesce("near", "carried")).drop("near", "carried", "part", "full"), "warc-matched")
    discard(records.sparkSession, carried)
    lost = rows.where("kind = 'revisit' and (address is null or captured is null)").select(
        "address", "captured", "record_id", "etag", "modified", "headers", F.lit(None).cast("struct<captured:bigint,record_id:bigint>").alias("at"))
    responses = staged(ranged.where("full").select(
        F.col("record_id").alias("response_id"), F.col("captured").alias("response_captured"), F.col("address").alias("response_address"),
        F.col("etag").alias("r_etag"), F.col("modified").alias("r_modified"), F.col("headers").alias("r_headers"),
    ).dropDuplicates(["response_id", "response_captured", "response_address"]), "warc-responses")
    named = revisits.unionByName(lost).withColumns({"response_id": F.col("at.record_id"), "response_captured": F.col("at.captured"), "response_address": F.when(F.col("at").isNotNull(), F.col("address"))})
    # many revisits may name one response: both sides are read from files, so the join can split it
    named = staged(named.drop("at"), "warc-named")
    discard(records.sparkSession, ranged, revisits)
    joined = named.join(responses, ["response_id", "response_captured", "response_address"], "left")
    verdict = (F.when(F.col("response_id").isNull(), "unmatched")
               .when(F.col("etag").isNotNull() & F.col("r_etag").isNotNull(), F.when(F.col("etag") == F.col("r_etag"), "resolved").otherwise("changed"))
               .when(F.col("modified").isNotNull() & F.col("r_modified").isNotNull(), F.when(F.col("modified") == F.col("r_modified"), "resolved").otherwise("changed"))
               .otherwise("unproven"))

    def small(headers: str) -> Column:
        """Names in small letters; the last of equal names counts, a null value does not."""
        entries = F.filter(F.map_entries(F.coalesce(F.col(headers), F.create_map().cast("map<string,string>"))), lambda e: e["value"].isNotNull())
        return F.aggregate(entries, F.create_map().cast("map<string,string>"), lambda acc, e: F.map_concat(
            F.map_filter(acc, lambda k, v: k != F.lower(e["key"])), F.create_map(F.lower(e["key"]), e["value"])))

    stored = F.map_filter(small("r_headers"), lambda k, v: ~F.array_contains(F.map_keys("new"), k))
    joined = joined.withColumn("verdict", verdict).withColumn("new", F.map_filter(small("headers"), lambda k, v: k.isin(PERMITTED)))
    return joined.select("record_id", "address", "captured", "response_id", "response_captured", "verdict",
                         F.when(F.col("verdict") == "resolved", F.map_concat(stored, "new")).alias("headers"))


def with_bodies(resolved: DataFrame, records: DataFrame) -> DataFrame:
    """``resolved`` with the response's ``body`` (null unless resolved)."""
    keys = ["response_id", "response_captured", "address"]
    bodies = records.where("kind = 'response' and status = 200 and record_id is not null").select(
        F.col("record_id").alias("response_id"), F.col("captured").alias("response_captured"), canonical(F.col("url")).alias("address"), "body",
        F.monotonically_increasing_id().alias("row"))
    resolved, bodies = staged(resolved, "warc-resolved"), staged(bodies, "warc-bodies")
    discard(records.sparkSession)
    # repeated records are told apart by their rows' numbers, so bodies are shuffled once
    once = staged(bodies.groupBy(*keys).agg(F.min("row").alias("row")), "warc-bodies-once")
    out = resolved.join(once, keys, "left").join(bodies.select("row", "body"), "row", "left").drop("row")
    return out.withColumn("body", F.when(F.col("verdict") == "resolved", F.col("body")))


DAY = 86_400


def captures(pages: DataFrame) -> DataFrame:
    """A crawl log of ``pages`` (page_id, url, html): two or more records of each page's address, in no order.

    Page p is fetched at second 60 p (404 where there is no html). Every second page is fetched again ten days later
    with a changed body, tag and date; every fourth fails ten days after that. Not-modified revisits, under another
    spelling of the address: of every fifth page a second before its first response; of every page 1 to 9 days after
    it, with the tag (weak, one in three), another (one in eleven) or none (one in seven); of every second page at the
    second of its second response, which is not earlier; and of every third after 25 days, with the tag of its latest
    response, but one in seven with the first's and one in five without any validator.
    """
    p, html = F.col("page_id"), F.col("html")
    start = 60 * p
    bodies = [html, F.concat(F.lit("<!-- 2 -->"), F.substring("html", 1, 64))]
    tags = [F.concat(F.lit('"'), F.substring(F.md5(b), 1, 16), F.lit('"')) for b in bodies]
    days = [F.concat(F.lit("day "), F.floor((start + k * 10 * DAY) / DAY).cast("string")) for k in (0, 1)]
    again = F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again"))
    none = F.lit(None).cast("string")

    def response(n: int, at: Column, status: Column | int, k: int) -> Column:
        headers = F.create_map(F.lit("ETag"), tags[k], F.lit("Last-Modified"), days[k], F.lit("Date"), at.cast("string"), F.lit("Content-Type"), F.lit("text/html"))
        return F.struct((8 * p + n).alias("record_id"), F.col("url"), at.alias("captured"), F.lit("response").alias("kind"),
                        (F.lit(status) if isinstance(status, int) else status).alias("status"), headers.alias("headers"), bodies[k].alias("body"))

    def revisit(n: int, at: Column, tag: Column, date: Column) -> Column:
        headers = F.create_map(F.lit("etag"), tag, F.lit("last-modified"), date, F.lit("date"), at.cast("string"), F.lit("x-cache"), F.lit("hit"))
        return F.struct((8 * p + n).alias("record_id"), again.alias("url"), at.alias("captured"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"),
                        headers.alias("headers"), none.alias("body"))

    second, late = p % 2 == 0, start + 25 * DAY
    found = F.when(html.isNull(), 404).otherwise(200)
    usual = F.when(p % 11 == 0, F.lit('"other"')).when(p % 7 == 0, none).when(p % 3 == 0, F.concat(F.lit("W/"), tags[0])).otherwise(tags[0])
    last = F.when(p % 5 == 0, none).when(second & (p % 7 != 0), tags[1]).otherwise(tags[0])
    records = [
        response(0, start, found, 0), F.when(second, response(1, start + 10 * DAY, found, 1)), F.when(p % 4 == 0, response(2, start + 20 * DAY, 500, 1)),
        F.when(p % 5 == 0, revisit(3, start - 1, tags[0], days[0])), revisit(4, start + DAY * (1 + p % 9), usual, days[0]),
        F.when(second, revisit(5, start + 10 * DAY, tags[0], days[0])), F.when(p % 3 == 0, revisit(6, late, last, F.when(p % 5 != 0, days[0])))]
    return pages.select(F.explode(F.filter(F.array(*records), lambda r: r.isNotNull())).alias("r")).select("r.*")
