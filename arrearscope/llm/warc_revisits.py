"""Not-modified revisits resolved to the full response they stand for.

An as-of join by canonical url: a revisit belongs to the latest earlier full response. Captures are
range-partitioned by (url, time), so a url with a third of all captures spreads over many tasks. Inside a
partition the latest response runs along in order; what a partition needs from those before it is a
summary of one row for each url and partition. The validators of both sides must agree, then the
permitted headers of the revisit replace those of the response.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrearscope.sources.storage import stored

#: Header fields a not-modified answer may update; those that describe a body it doesn't have stay.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that don't name a resource.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Without scheme, fragment, ``www``, default port, closing slash and tracking parameters; the rest sorted. Null stays null."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "^[A-Za-z][A-Za-z0-9+.-]*://", ""), "#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), r"^www[0-9]*\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, r"^[^?]*\?(.*)$", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.concat(host, F.when(path == "", "/").otherwise(path), F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept)))


def _opaque(tag: Column) -> Column:
    """An entity tag without its weakness mark: revalidation compares weakly."""
    return F.regexp_replace(tag, "^W/", "")


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """One row for each revisit: record_id, url, canonical, refers_to, state and headers.

    ``captures``: record_id, url, captured (long), kind (``response`` or ``revisit``), etag, last_modified, digest (of the
    payload) and headers (map with lower-case names). State is

    - ``resolved``: the latest earlier response of the url agrees in every validator both sides have, and in one at least;
      headers are its own, updated by the permitted ones,
    - ``mismatch`` or ``unverified``: one differs, or there is none in common; ``refers_to`` names that response, headers are null,
    - ``missing``: no earlier response, or no url or time to look one up.

    Of captures at the same time the smaller record_id is earlier (a null one first). Repeated revisits are each returned;
    repeated responses are equal. Null headers are none. Other kinds are no captures. Further columns are not read.
    """
    spark = captures.sparkSession
    empty = F.create_map().cast("map<string,string>")
    known = captures.filter(F.col("kind").isin("response", "revisit")).select(
        "record_id", "url", canonical_url(F.col("url")).alias("canonical"), "captured", "kind", "etag", "last_modified", "digest",
        F.coalesce("headers", empty).alias("headers"))
    placeable = F.col("canonical").isNotNull() & F.col("captured").isNotNull()
    lost = known.filter(~placeable & (F.col("kind") == "revisit")).select(
        "record_id", "url", "canonical", F.lit(None).cast("long").alias("refers_to"), F.lit("missing").alias("state"),
        F.lit(None).cast("map<string,string>").alias("headers"))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = known.filter(placeable).repartitionByRange(parts, "canonical", "captured", "record_id")
    # stored, as a partition's number has to mean the same rows in both uses below
    placed = stored(ranged.withColumn("part", F.spark_partition_id()), "captures")
    response = F.when(F.col("kind") == "response", F.struct(
        "captured", "record_id", "etag", "last_modified", "digest", "headers"))
    inside = Window.partitionBy("part", "canonical").orderBy("captured", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    ends = placed.filter(F.col("kind") == "response").groupBy("part", "canonical").agg(F.max_by(
        F.struct("captured", "record_id", "etag", "last_modified", "digest", "headers"), F.struct("captured", "record_id")).alias("end"))
    # the latest response of the partitions before, for every (partition, url) that has revisits
    needs = placed.select("part", "canonical").distinct().join(ends, ["part", "canonical"], "left")
    before = Window.partitionBy("canonical").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = needs.select("part", "canonical", F.last("end", ignorenulls=True).over(before).alias("carry")).filter(
        F.col("carry").isNotNull())
    found = placed.withColumn("near", F.last(response, ignorenulls=True).over(inside)).filter(
        F.col("kind") == "revisit").join(carried, ["part", "canonical"], "left").withColumn("full", F.coalesce("near", "carry"))

    def agrees(own: Column, other: Column) -> Column:
        return F.when(own.isNotNull() & other.isNotNull(), own == other)

    checks = F.filter(F.array(
        agrees(_opaque(F.col("etag")), _opaque(F.col("full.etag"))), agrees(F.col("last_modified"), F.col("full.last_modified")),
        agrees(F.col("digest"), F.col("full.digest"))), lambda c: c.isNotNull())
    state = F.when(F.col("full").isNull(), "missing").when(F.size(checks) == 0, "unverified").when(
        F.forall(checks, lambda c: c), "resolved").otherwise("mismatch")
    updates = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(F.col("full.headers"), lambda k, _: ~F.map_contains_key(updates, k)), updates)
    return found.withColumn("state", state).select(
        "record_id", "url", "canonical", F.col("full.record_id").alias("refers_to"), "state",
        F.when(F.col("state") == "resolved", merged).alias("headers")).unionByName(lost)


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """A crawl's captures from page_id, url and html: each page is fetched at 100 page_id and revisited later.

    Pages whose url ends in ``#top`` were fetched by an earlier crawl that isn't here; those with ``.html`` are
    revisited with a weak tag, those with ``utm_source`` once more after they have changed.
    """
    tag = F.concat(F.lit('"'), F.md5(F.col("html").cast("binary")), F.lit('"'))

    def capture(k: int, kind: str, when: Column, etag: Column, **headers: str) -> Column:
        names = {n.replace("_", "-"): F.lit(v) for n, v in headers.items()}
        named = F.create_map(*(x for n, v in names.items() for x in (F.lit(n), v)), F.lit("date"),
                             (F.col("page_id") * 100 + 10 * k).cast("string"))
        return F.when(when, F.struct(
            (F.col("page_id") * 4 + k).alias("record_id"), (F.col("page_id") * 100 + 10 * k).alias("captured"),
            F.lit(kind).alias("kind"), etag.alias("etag"), named.alias("headers")))

    url = F.coalesce("url", F.lit(""))
    kinds = F.array(
        capture(0, "response", ~url.endswith("#top"), tag, content_type="text/html", cache_control="max-age=60", server="one"),
        capture(1, "revisit", F.lit(True), tag, content_length="0", cache_control="max-age=600", server="two"),
        capture(2, "revisit", url.contains(".html"), F.concat(F.lit("W/"), tag), vary="accept"),
        capture(3, "revisit", url.contains("utm_source"), F.lit('"changed"'), cache_control="no-store"))
    each = pages.filter(F.col("page_id").isNotNull()).select("url", F.explode(F.filter(kinds, lambda c: c.isNotNull())).alias("c"))
    return each.select("c.record_id", "url", "c.captured", "c.kind", "c.etag", F.lit(None).cast("string").alias("last_modified"),
                       F.lit(None).cast("string").alias("digest"), "c.headers")


def headers_text(headers: Column) -> Column:
    """``name: value`` lines by name."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
