"""Rows generated from pages: tokens, links, images, regex matches.

Each operator reads a page once and explodes once; the HTML itself is projected
away before the explode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweft.functions import html as H
from linkweft.functions.text import decode_entities
from linkweft.functions.url import (
    FALLBACK_URL,
    SCOPE,
    ending,
    image_fits,
    resolve_link,
    url_host,
)
from linkweft.plans.once import compute_once, let

# Attribute which holds the target, and rank in link order, per kind of link.
LINK_KINDS = ("onclick", "area", "link", "a")


def html_tokens(pages: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, pos, kind, value) of every token of `html`, pos from 0."""
    keys = keys or ["page_id"]
    return pages.select(*keys, F.posexplode(H.bare_tokens(F.col("html"))).alias("pos", "t")).select(
        *keys, "pos", "t.kind", "t.value"
    )


def onclick_target(script: Column) -> Column:
    """Text between the first two single quotes of a script which changes location."""
    moves = F.contains(script, F.lit("location.href")) | F.contains(
        script, F.lit("document.location")
    )
    quoted = F.regexp_extract(script, r"(?s)^[^']*'([^']*)'", 1)
    return F.when(moves & F.rlike(script, F.lit(r"(?s)^[^']*'[^']*'")), quoted)


def _link_values(tags: Column) -> Column:
    """ARRAY<STRUCT<kind, rank, pos, value>>: attributes of start tags which may hold a link."""
    wanted = r"(?is)^<(?:a|area|link)[\s/>]|\sonclick\s*="
    tags = F.filter(tags, lambda t: F.rlike(t, F.lit(wanted)))

    def found(tag: Column, pos: Column) -> Column:
        def one(kind: Column, rank: Column, value: Column) -> Column:
            return F.struct(
                kind.alias("kind"), rank.alias("rank"), pos.alias("pos"), value.alias("value")
            )

        def of_name(name: Column) -> Column:
            rank = F.array_position(F.array(*map(F.lit, LINK_KINDS)), name).cast("int")
            return F.array(
                one(F.lit("onclick"), F.lit(1), H.raw_attribute(tag, "onclick")),
                one(name, rank, F.when(rank > 1, H.raw_attribute(tag, "href"))),
            )

        return let(H.tag_name(tag), of_name)

    return F.filter(F.flatten(F.transform(tags, found)), lambda c: c["value"].isNotNull())


def _image_values(tags: Column) -> Column:
    """ARRAY<STRING>: the source of each image among start tags, NULL if it has none."""
    images = F.filter(tags, lambda t: F.rlike(t, F.lit(r"(?is)^<img[\s/>]")))
    return F.transform(images, lambda t: decode_entities(H.raw_attribute(t, "src")))


def _link_text(kind: Column, value: Column) -> Column:
    """A link as written on a page, references decoded, NULL for a script that holds none."""
    return let(decode_entities(value), lambda v: F.when(kind == "onclick", onclick_target(v)).otherwise(v))


def page_references(pages: DataFrame) -> DataFrame:
    """(page_id, page_host, links, images): what the tags of each page refer to, as arrays.

    The page is cut into tags once for both; `reference_links` and `reference_images` give the
    rows of `page_links` and `page_images`.
    """
    host = url_host(F.col("url")).alias("page_host")
    tags = compute_once(pages.select("page_id", host, "html"), {"tags": H.opening_tags(F.col("html"))})
    values = {"links": _link_values(F.col("tags")), "images": _image_values(F.col("tags"))}
    return tags.select("page_id", "page_host", *[v.alias(k) for k, v in values.items()])


def page_hrefs(
    pages: DataFrame, kinds: tuple[str, ...] = LINK_KINDS, keep: tuple[str | Column, ...] = ()
) -> DataFrame:
    """(page_id, keep, kind, rank, pos, link): links as written, references decoded.

    `pos` counts the link tags of a page, `rank` the kinds in the order in which
    they are taken up.
    """
    values = _link_values(H.opening_tags(F.col("html")))
    wanted = F.filter(values, lambda c: c["kind"].isin(*kinds))
    return _hrefs(pages.select("page_id", *keep, F.explode(wanted).alias("_c")))


def _hrefs(rows: DataFrame) -> DataFrame:
    """Rows with a link value `_c` as those of `page_hrefs`."""
    link = _link_text(F.col("_c.kind"), F.col("_c.value"))
    rows = compute_once(rows.select("*", "_c.kind", "_c.rank", "_c.pos"), {"link": link})
    return rows.where(F.col("link").isNotNull()).drop("_c")


def page_anchors(pages: DataFrame) -> DataFrame:
    return page_hrefs(pages, ("a",))


def page_areas(pages: DataFrame) -> DataFrame:
    return page_hrefs(pages, ("area",))


def page_link_tags(pages: DataFrame) -> DataFrame:
    return page_hrefs(pages, ("link",))


def page_onclick_links(pages: DataFrame) -> DataFrame:
    return page_hrefs(pages, ("onclick",))


def page_links(
    pages: DataFrame,
    scope: str = SCOPE,
    fallback: str = FALLBACK_URL,
    host: str | None = None,
) -> DataFrame:
    """Distinct (page_id, url, first_at) of the in-scope links of pages.

    All four kinds of link are read in one pass.  `first_at` orders the links of
    a page: onclick, area, link, a; by position within a kind.  The page host is
    taken from `url`, or from the column named by `host`.
    """
    page_host = (F.col(host) if host else url_host(F.col("url"))).alias("page_host")
    return _first_links(page_hrefs(pages, keep=(page_host,)), scope, fallback)


def reference_links(references: DataFrame, scope: str = SCOPE, fallback: str = FALLBACK_URL) -> DataFrame:
    """`page_links` of pages from their `page_references`."""
    hrefs = _hrefs(references.select("page_id", "page_host", F.explode("links").alias("_c")))
    return _first_links(hrefs, scope, fallback)


def _first_links(hrefs: DataFrame, scope: str, fallback: str) -> DataFrame:
    url = resolve_link(F.col("link"), F.col("page_host"), F.col("kind") == "link", scope, fallback)
    at = F.col("rank").cast("long") * F.lit(1 << 32) + F.col("pos")
    resolved = compute_once(hrefs, {"url": url, "at": at})
    return (
        resolved.where(F.col("url").isNotNull())
        .groupBy("page_id", "url")
        .agg(F.min("at").alias("first_at"))
    )


def page_images(pages: DataFrame) -> DataFrame:
    """(page_id, pos, filename, content_type) of every image, repeats kept.

    A `page_type_code` column, if there is one, excludes duplicates.
    """
    if "page_type_code" in pages.columns:
        pages = pages.where(F.col("page_type_code") != "DUPLICATE")
    sources = _image_values(H.opening_tags(F.col("html")))
    return _image_rows(pages.select("page_id", F.posexplode(sources).alias("pos", "filename")))


def reference_images(references: DataFrame) -> DataFrame:
    """`page_images` of pages from their `page_references`."""
    return _image_rows(references.select("page_id", F.posexplode("images").alias("pos", "filename")))


def _image_rows(images: DataFrame) -> DataFrame:
    return images.where(image_fits(F.col("filename"))).select(
        "page_id", "pos", "filename", ending(F.col("filename")).alias("content_type")
    )


def regex_find_all(
    pages: DataFrame, text: str, pattern: str, group: int = 1, keys: list[str] | None = None
) -> DataFrame:
    """(keys, match_no, match): all matches of a pattern in order, numbered from 1."""
    keys = keys or ["page_id"]
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group))
    return pages.select(*keys, F.posexplode(found).alias("at", "match")).select(
        *keys, (F.col("at") + 1).alias("match_no"), "match"
    )
