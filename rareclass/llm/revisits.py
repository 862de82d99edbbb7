"""Not-modified revisits of web captures, resolved to the response that they repeat.

Every revisit takes the latest earlier full response of its canonical URL. A URL's timeline
is cut into spans of time: the last response of each span is carried to later spans through
one row per span, so the captures of a URL that fills a third of the table are spread over
many groups. Payloads stay where they are; only validators and headers move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Response headers that a not-modified answer may update (RFC 9110, RFC 9111).
PERMITTED = ["age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
# Query parameters that do not name a page.
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"
SPAN_SECONDS = 30 * 86400


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, ``www.``, default port, fragment, tracking parameters and last slashes.

    Parameters are sorted; the host is lower-cased and the path is not. A null or blank URL is null.
    """
    bare = F.regexp_replace(F.substring_index(F.trim(url), "#", 1), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_extract(bare, "^[^/?]*", 0)
    rest = F.regexp_replace(bare, "^[^/?]*", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^?]*", 0), "/+$", "")
    params = F.array_sort(F.filter(
        F.split(F.regexp_replace(rest, r"^[^?]*\??", ""), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    clean = F.regexp_replace(F.regexp_replace(F.lower(host), r"^www\.", ""), ":(80|443)$", "")
    query = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise("")
    return F.when(host != "", F.concat(clean, path, query))


def _plain(headers: Column) -> Column:
    """Header entries with lower-case names, without null values."""
    named = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    none = F.array().cast("array<struct<key:string,value:string>>")
    return F.filter(F.coalesce(named, none), lambda e: e["value"].isNotNull())


def _merged(old: Column, new: Column) -> Column:
    """Entries of the response, those that the revisit may update replaced."""
    allowed = F.filter(new, lambda e: e["key"].isin(PERMITTED))
    both = F.concat(old, allowed)
    last = F.filter(both, lambda e, i: ~F.exists(
        F.slice(both, i + 2, F.size(both)), lambda later: later["key"] == e["key"]))
    return F.array_sort(last)


def weak_tag(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), "^W/", "")


def resolve_revisits(records: DataFrame, span_seconds: int = SPAN_SECONDS) -> DataFrame:
    """One row per revisit: ``(record_id, url_key, response_id, status, headers)``.

    ``records`` has ``record_id, kind ('response' or 'revisit'), url, captured_at`` (seconds),
    ``etag, last_modified, headers map<string,string>``. The response is the latest one of the
    canonical URL that was captured before the revisit, the greatest id on ties. ``status``:
    ``no_response`` without one; ``mismatch`` if the revisit's etag (weak comparison), or
    without an etag its last-modified date, is not the response's; ``unchecked`` without
    either; else ``resolved``. ``headers`` are sorted entries of the response with the
    permitted ones of the revisit on top, null unless resolved or unchecked. A null URL or time
    finds nothing. Repeated records are rows of their own.
    """
    rows = records.select(
        F.col("record_id").cast("bigint").alias("record_id"), (F.col("kind") == "response").alias("full"), "kind",
        canonical_url(F.col("url")).alias("url_key"), F.col("captured_at").cast("bigint").alias("at"),
        "etag", "last_modified", _plain(F.col("headers")).alias("entries"))
    placed = rows.where("url_key is not null and at is not null and kind in ('response', 'revisit')").withColumn(
        "span", F.floor(F.col("at") / span_seconds))
    response = F.struct("at", "record_id", "etag", "last_modified", "entries")
    # The last response of each span, and for each span the one carried into it.
    ends = placed.groupBy("url_key", "span").agg(F.max_by(F.when(F.col("full"), response), F.when(
        F.col("full"), F.struct("at", "record_id"))).alias("end"))
    before = Window.partitionBy("url_key").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("url_key", "span", F.last("end", ignorenulls=True).over(before).alias("carried"))
    # At equal times a response comes after the revisits, which are not later than it.
    order = (Window.partitionBy("url_key", "span").orderBy("at", "full", "record_id")
             .rowsBetween(Window.unboundedPreceding, 0))
    inside = placed.withColumn("inside", F.last(F.when(F.col("full"), response), ignorenulls=True).over(order)).where("not full")
    own = ["record_id", "url_key", "etag", "last_modified", "entries"]
    asked = inside.join(carried, ["url_key", "span"]).select(*own, F.coalesce("inside", "carried").alias("old"))
    nothing = F.lit(None).cast(asked.schema["old"].dataType)
    lost = rows.where("kind = 'revisit' and (url_key is null or at is null)").select(*own, nothing.alias("old"))
    same_tag = weak_tag(F.col("etag")) == weak_tag(F.col("old.etag"))
    same_date = F.col("last_modified") == F.col("old.last_modified")
    status = (F.when(F.col("old").isNull(), "no_response")
              .when(F.col("etag").isNotNull(), F.when(same_tag, "resolved").otherwise("mismatch"))
              .when(F.col("last_modified").isNotNull(), F.when(same_date, "resolved").otherwise("mismatch"))
              .otherwise("unchecked"))
    return (asked.union(lost).withColumn("status", status).select(
        "record_id", "url_key", F.col("old.record_id").alias("response_id"), "status",
        F.when(F.col("status").isin("resolved", "unchecked"), _merged(F.col("old.entries"), F.col("entries"))).alias("headers")))
