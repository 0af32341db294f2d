"""Set-based changes of crawl tables.

Each operator returns rows to append, or a new version of the rows it was given;
nothing is written to a store here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkweft.functions.text import content_hash
from linkweft.functions.url import (
    file_type,
    is_document,
    page_class,
    url_fits,
    url_host,
)
from linkweft.operators.lookups import first_sites
from linkweft.plans.session import written
from linkweft.plans.skew import HOT_ROWS, number_rows, skew_lookup
from linkweft.sources.schema import NO_TEXT, conform


def next_id(table: DataFrame, key: str = "id") -> int:
    """Highest id in use, 0 for an empty table; a job that scans the id column."""
    return table.agg(F.max(key)).first()[0] or 0


# Types whose values, and one for NULL, are told apart by 64 and 33 bits.
_LONGS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_INTS = _LONGS[:3]


def _discovery(found: DataFrame) -> Column:
    """The order of (seen_at, tie), NULL first, as one number if both are whole numbers, else as a struct.

    Spark combines numbers by hashing; of structs it would sort all rows with their URLs.
    """
    kinds = found.schema["seen_at"].dataType, found.schema["tie"].dataType
    if not (isinstance(kinds[0], _LONGS) and isinstance(kinds[1], _INTS)):
        return F.struct("seen_at", "tie")
    high = F.coalesce(F.col("seen_at").cast("decimal(20,0)"), F.lit(str(-(1 << 63) - 1)).cast("decimal(20,0)"))
    low = F.coalesce(F.col("tie").cast("long"), F.lit(-(1 << 31) - 1)) + F.lit(1 << 32)
    return (high * F.lit(1 << 34).cast("decimal(11,0)") + low.cast("decimal(11,0)")).cast("decimal(38,0)")


def add_frontier(
    found: DataFrame,
    page: DataFrame,
    now: Column,
    base: int | None = None,
    site_col: str = "site_id",
) -> DataFrame:
    """New FRONTIER rows for URLs which no page has yet.

    `found` has (url, seen_at, tie, site_id): `seen_at` is an integer order of
    discovery, `tie` orders rows of one `seen_at`.  A URL found often counts once,
    where it was seen first.  URLs of 3000 characters or more are left out.
    """
    seen = found.where(url_fits(F.col("url"))).withColumn("_order", _discovery(found))
    kept = {"site_id": site_col, "seen_at": "seen_at", "tie": "tie"}
    first = seen.groupBy("url").agg(*[F.min_by(c, "_order").alias(k) for k, c in kept.items()])
    new = first.join(page.select("url"), "url", "left_anti")
    start = next_id(page) if base is None else base
    numbered = number_rows(new, "seen_at", ["tie", "url"], out="id", base=start)
    return conform(
        numbered.withColumns(
            {
                "page_type_code": F.lit("FRONTIER"),
                "html_content": F.lit(""),
                "http_status_code": F.lit(0),
                "hash_code": F.lit(""),
                "accessed_time": now,
            }
        ),
        "page",
    )


def add_site(found: DataFrame, site: DataFrame, base: int | None = None) -> DataFrame:
    """New site rows for the hosts of (url, seen_at) which no site has yet."""
    hosts = (
        found.select(url_host(F.col("url")).alias("domain"), "seen_at")
        .where(F.col("domain").isNotNull())
        .groupBy("domain")
        .agg(F.min("seen_at").alias("seen_at"))
    )
    new = hosts.join(site.select("domain"), "domain", "left_anti")
    start = next_id(site) if base is None else base
    numbered = number_rows(new, "seen_at", ["domain"], out="id", base=start)
    return conform(
        numbered.withColumns(
            {"robots_content": F.lit(NO_TEXT), "sitemap_content": F.lit(NO_TEXT)}
        ),
        "site",
    )


def add_link(found: DataFrame, link: DataFrame) -> DataFrame:
    """New edges: distinct (from_page, to_page) which `link` lacks."""
    pair = ["from_page", "to_page"]
    distinct = found.select(*pair).dropna().dropDuplicates(pair)
    return conform(distinct.join(link.select(*pair), pair, "left_anti"), "link")


def add_image(found: DataFrame, image: DataFrame, now: Column, base: int | None = None) -> DataFrame:
    """New image rows for (page_id, pos, filename, content_type), without data."""
    start = next_id(image) if base is None else base
    numbered = number_rows(found, "page_id", ["pos"], out="id", base=start)
    return conform(numbered.withColumn("accessed_time", now), "image")


def add_page_data(page: DataFrame, page_data: DataFrame, base: int | None = None) -> DataFrame:
    """New rows, without data, for the pages which are documents by URL."""
    documents = page.where(is_document(F.col("url"))).select(
        F.col("id").alias("page_id"), file_type(F.col("url")).alias("data_type_code")
    )
    start = next_id(page_data) if base is None else base
    return conform(number_rows(documents, "page_id", out="id", base=start), "page_data")


def seen_hashes(fetched: DataFrame, settled: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add (original_id, seen_before) to rows with (id, hash_code).

    A hash was seen before if a settled page has it or a fetched row of lower id.
    Both sides are reduced to one row per hash where they are read; of the settled
    pages only (id, hash_code) is scanned.
    """
    here = fetched.groupBy("hash_code").agg(
        F.min("id").alias("first_here"), F.count(F.lit(1)).alias("copies")
    )
    there = (
        settled.where(F.col("hash_code") != "")
        .groupBy("hash_code")
        .agg(F.min("id").alias("first_there"))
    )
    groups = here.join(there, "hash_code", "left")
    found = skew_lookup(
        fetched, groups, "hash_code", ["id"], count_col="copies", hot_rows=hot_rows
    )
    earlier_here = F.when(F.col("first_here") < F.col("id"), F.col("first_here"))
    original = F.coalesce("first_there", earlier_here)
    return found.select(
        *fetched.columns, original.alias("original_id"), original.isNotNull().alias("seen_before")
    )


def apply_fetch(
    page: DataFrame,
    captures: DataFrame,
    site: DataFrame,
    settled: DataFrame,
    now: Column,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Pages with a capture (url, html) as fetched: the page columns but for the
    content, plus `captured_html` and `original_id`.

    Site by host, type by ending and hash, status 200.  The content to store is
    `captured_html`, or nothing for a binary page.  The hashes are written first, below the
    shared folder, as they count twice.
    """
    # all is decided on keys and hashes; the content joins last, so it moves once
    hosts = page.select("id", "url", url_host(F.col("url")).alias("domain"))
    placed = skew_lookup(hosts, first_sites(site), "domain", ["id"], hot_rows=hot_rows)
    hashes = captures.select("url", content_hash(F.col("html")).alias("hash_code"))
    keys = written(placed.select("id", "url", "site_id").join(hashes, "url"), "fetch-keys")
    classed = seen_hashes(keys, settled, hot_rows)
    classed = classed.join(captures.select("url", F.col("html").alias("captured_html")), "url")
    kind = page_class(F.col("url"), F.col("seen_before"))
    return classed.select(
        "id",
        "site_id",
        kind.alias("page_type_code"),
        "url",
        F.lit(200).alias("http_status_code"),
        "hash_code",
        now.cast("timestamp_ntz").alias("accessed_time"),
        "captured_html",
        "original_id",
    )


def set_page_status(page: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Pages with (url, status) outcomes taken over: type HTML and that status."""
    joined = page.join(outcomes.select("url", F.col("status").alias("_status")), "url", "left")
    hit = F.col("_status").isNotNull()
    return joined.select(
        *[
            F.when(hit, F.lit("HTML")).otherwise(F.col(c)).alias(c)
            if c == "page_type_code"
            else F.coalesce("_status", c).cast("int").alias(c)
            if c == "http_status_code"
            else F.col(c)
            for c in page.columns
        ]
    )


def set_site_robots(site: DataFrame, texts: DataFrame) -> DataFrame:
    """Sites with (domain, robots_content, sitemap_content) taken over, nulls too."""
    new = texts.select(
        "domain",
        F.struct("robots_content", "sitemap_content").alias("_new"),
    )
    hit = F.col("_new").isNotNull()
    joined = site.join(new, "domain", "left")
    return joined.select(
        "id",
        "domain",
        *[
            F.when(hit, F.col("_new")[c]).otherwise(F.col(c)).alias(c)
            for c in ("robots_content", "sitemap_content")
        ],
    )


def referenced_pages(link: DataFrame, image: DataFrame, page_data: DataFrame) -> DataFrame:
    """Distinct ids of pages which another table refers to."""
    ids = [
        link.select(F.col("from_page").alias("id")),
        link.select(F.col("to_page").alias("id")),
        image.select(F.col("page_id").alias("id")),
        page_data.select(F.col("page_id").alias("id")),
    ]
    return ids[0].union(ids[1]).union(ids[2]).union(ids[3]).distinct()


def delete_pages(page: DataFrame, urls: DataFrame, referenced: DataFrame) -> DataFrame:
    """Pages without those of the given URLs; referenced pages stay."""
    doomed = (
        page.select("id", "url")
        .join(urls.select("url"), "url", "left_semi")
        .join(referenced.select("id"), "id", "left_anti")
    )
    return page.join(doomed.select("id"), "id", "left_anti")
