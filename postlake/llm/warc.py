"""Resolve not-modified revisit records against earlier full responses.

A revisit says that a capture was answered 304: nothing changed since a
response the archive already holds. Each revisit is joined as-of, by
canonical URL, to the latest earlier full (status 200) response; its
validators must agree with that response's, and the resolved record is the
stored response with those headers replaced that a 304 may update.

The as-of join reads narrow columns only. A URL's timeline is cut into time
buckets: the last response of each bucket is an aggregate, carried over
later buckets by a window with one row per URL and bucket, so a URL with a
very large share of all captures is spread over its buckets. Payload and
headers of the chosen responses are joined in at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Headers of a 304 that update the stored response.
PERMITTED_HEADERS = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")

BUCKET_SECONDS = 6 * 3600
_URL = r"^\s*([A-Za-z][A-Za-z0-9+.-]*)://([^/?#\s]*)([^?#\s]*)(\?[^#\s]*)?(#.*)?\s*$"


def canonical_url(url: Column) -> Column:
    """A key for URLs that mean the same page.

    Scheme, user, fragment, a leading ``www.`` and the scheme's default port
    go; the host is lower-cased; an empty path is ``/``; query parameters are
    sorted and empty ones dropped. Text that is no absolute URL is its trimmed
    self; null stays null."""
    part = lambda i: F.regexp_extract(url, _URL, i)
    host = F.regexp_replace(F.lower(part(2)), r"^.*@", "")
    port = F.when(F.lower(part(1)) == "http", F.regexp_replace(host, r":(80)?$", "")).when(
        F.lower(part(1)) == "https", F.regexp_replace(host, r":(443)?$", "")).otherwise(host)
    path = F.when(part(3) == "", "/").otherwise(part(3))
    params = F.array_sort(F.filter(F.split(F.substring(part(4), 2, 1 << 30), "&", -1), lambda p: p != ""))
    query = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise("")
    return F.when(F.regexp_like(url, F.lit(_URL)),
                  F.concat(F.regexp_replace(port, r"^www\.", ""), path, query)).otherwise(F.trim(url))


def _headers(column: Column) -> Column:
    """Header entries with lower-case names; of names equal but for case, the
    spelling that sorts last counts."""
    entries = F.transform(F.array_sort(F.coalesce(F.map_entries(column), F.array().cast("array<struct<key:string,value:string>>"))),
                          lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    later = lambda e, i: F.exists(F.slice(entries, i + 2, 1 << 30), lambda x: x["key"] == e["key"])
    return F.filter(entries, lambda e, i: e["key"].isNotNull() & ~later(e, i))


def _value(entries: Column, name: str) -> Column:
    return F.get(F.filter(entries, lambda e: e["key"] == name), F.lit(0))["value"]


def _weak(etag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(F.trim(etag), r"^[Ww]/", "")


def resolve_revisits(records: DataFrame, permitted: tuple[str, ...] = PERMITTED_HEADERS,
                     bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """One row per revisit of ``records (record_id, record_type, uri, date,
    status, headers map, payload)``.

    Returns ``(record_id, uri, canonical_uri, date, outcome, response_id,
    response_date, matched_by, headers, payload)``. The response is the latest
    with the same canonical URL and a strictly earlier date (equal dates: the
    larger record id). If both hold an ETag, those must agree (weak
    comparison); else if both hold Last-Modified, those must. Outcomes:
    ``resolved`` (with merged headers and the payload), ``mismatch``,
    ``no_validator`` (nothing to compare) and ``no_response`` (none earlier, or
    the revisit lacks a URL or date). Headers are lower-case names to values.
    Other record types and responses of another status are ignored; records
    with one id are taken for the same response, repeated revisits keep their
    rows; other columns are not read; an empty table gives an empty table.
    """
    entries = _headers(F.col("headers"))
    narrow = records.select(
        "record_id", "record_type", "uri", "date", "status", canonical_url(F.col("uri")).alias("canonical_uri"),
        _value(entries, "etag").alias("etag"), _value(entries, "last-modified").alias("modified"),
        entries.alias("entries"))
    is_response = (F.col("record_type") == "response") & (F.col("status") == 200)
    responses = narrow.where(is_response & F.col("date").isNotNull() & F.col("canonical_uri").isNotNull()).select(
        "canonical_uri", "date", "record_id", "etag", "modified")
    revisits = narrow.where(F.col("record_type") == "revisit").select(
        "record_id", "uri", "canonical_uri", "date", "etag", "modified", "entries")

    bucket = F.floor(F.unix_seconds("date") / bucket_seconds).alias("bucket")
    found = F.struct("date", "record_id", "etag", "modified")
    events = responses.select("canonical_uri", bucket, "date", F.lit(1).alias("kind"), "record_id",
                              found.alias("response"), F.lit(None).cast(revisits.select(F.struct("*")).schema[0].dataType)
                              .alias("revisit")).unionByName(
        revisits.where(F.col("canonical_uri").isNotNull() & F.col("date").isNotNull()).select(
            "canonical_uri", bucket, "date", F.lit(0).alias("kind"), "record_id",
            F.lit(None).cast(responses.select(found).schema[0].dataType).alias("response"),
            F.struct("*").alias("revisit")))
    within = Window.partitionBy("canonical_uri", "bucket").orderBy("date", "kind", "record_id").rowsBetween(
        Window.unboundedPreceding, -1)
    across = Window.partitionBy("canonical_uri").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = events.groupBy("canonical_uri", "bucket").agg(F.max("response").alias("last")).select(
        "canonical_uri", "bucket", F.last("last", ignorenulls=True).over(across).alias("carried"))
    joined = events.withColumn("here", F.last("response", ignorenulls=True).over(within)).where("kind = 0").join(
        carried, ["canonical_uri", "bucket"]).select("revisit.*", F.coalesce("here", "carried").alias("response"))
    rest = revisits.where(F.col("canonical_uri").isNull() | F.col("date").isNull()).withColumn(
        "response", F.lit(None).cast(responses.select(found).schema[0].dataType))

    tags = F.col("etag").isNotNull() & F.col("response.etag").isNotNull()
    dates = F.col("modified").isNotNull() & F.col("response.modified").isNotNull()
    judged = joined.unionByName(rest).withColumn(
        "matched_by", F.when(tags, F.when(_weak(F.col("etag")) == _weak(F.col("response.etag")), "etag")).when(
            dates & (F.col("modified") == F.col("response.modified")), "last-modified")).withColumn(
        "outcome", F.when(F.col("response.record_id").isNull(), "no_response").when(
            F.col("matched_by").isNotNull(), "resolved").when(tags | dates, "mismatch").otherwise("no_validator"))

    stored = records.where(is_response).select(
        F.col("record_id").alias("response_id"), entries.alias("stored"), "payload").dropDuplicates(["response_id"])
    judged = judged.withColumns({"response_id": F.col("response.record_id"), "response_date": F.col("response.date")})
    # a revisit without a payload joins by its own id, which no response has,
    # so that unresolved ones do not all meet at the NULL key
    resolved = F.col("outcome") == "resolved"
    use = F.when(resolved, F.col("response_id")).otherwise(F.concat(F.lit("\0"), F.col("record_id")))
    whole = judged.withColumn("use", use).join(stored.withColumnRenamed("response_id", "use"), "use", "left")
    updates = F.filter("entries", lambda e: e["key"].isin(list(permitted)))
    kept = F.filter("stored", lambda e: ~F.exists(updates, lambda u: u["key"] == e["key"]))
    merged = F.when(resolved, F.map_from_entries(F.concat(kept, updates)))
    return whole.select("record_id", "uri", "canonical_uri", "date", "outcome", "response_id", "response_date",
                        "matched_by", merged.alias("headers"), F.when(resolved, F.col("payload")).alias("payload"))
