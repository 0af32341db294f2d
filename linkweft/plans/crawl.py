"""Crawl rounds over captured pages, and the extraction dispatcher.

A round takes the whole frontier at once.  What one page after the other decides by
lookups (is the URL known, the host, the content hash) is decided here by joins on
url, host and hash, and the result is a set of rows to append.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweft.functions.robots import robots_valid
from linkweft.functions.url import FALLBACK_URL, SCOPE, url_host
from linkweft.operators import changes, dom, records
from linkweft.operators.lookups import frontier_available, url_to_page, with_politeness_key
from linkweft.operators.pages import page_references, reference_images, reference_links
from linkweft.operators.robots import robots_allowed
from linkweft.operators.summaries import next_per_host, rows_in_time
from linkweft.operators.template import page_template
from linkweft.plans.skew import HOT_ROWS
from linkweft.plans.session import work_dir
from linkweft.sources.schema import Store, conform, is_waiting
from linkweft.sources.store import COMPACT_ROUNDS, NUMBERED, compact_store, read_store, rounds, save_round, seed_store, state

FORBIDDEN, UNREACHED = 403, 404

Stage = Callable[[str, DataFrame], DataFrame]


def written_stage(spark: SparkSession, folder: str) -> Stage:
    """Stage which writes each step below a folder and reads it from there."""

    def stage(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    return stage


def frontier_outcomes(
    frontier: DataFrame, site: DataFrame, captures: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """(id, url, site_id, outcome): FETCH, 403 as robots forbid, 404 without capture.

    Rules count as soon as they are known; a host without rules is allowed.
    """
    checked = robots_allowed(
        frontier.select("id", "url", "site_id"), site, ["id"], hot_rows=hot_rows
    )
    return _checked_outcomes(checked, captures)


def _checked_outcomes(checked: DataFrame, captures: DataFrame) -> DataFrame:
    """`frontier_outcomes` of rows that have `allowed` already."""
    reached = captures.select("url", F.lit(True).alias("reached"))
    forbidden = ~F.coalesce("allowed", F.lit(True))
    outcome = (
        F.when(forbidden, F.lit(FORBIDDEN))
        .when(F.col("reached").isNull(), F.lit(UNREACHED))
        .otherwise(F.lit(200))
    )
    return checked.join(reached, "url", "left").select("id", "url", "site_id", outcome.alias("status"))


def valid_robots(robots: DataFrame) -> DataFrame:
    """(domain, robots_content, sitemap_content) of fetched texts that are robots rules.

    One row per domain: texts that are some other page count as not fetched.
    """
    return (
        robots.where(robots_valid(F.col("robots_content")))
        .groupBy("domain")
        .agg(F.min(F.struct("robots_content", "sitemap_content")).alias("t"))
        .select("domain", "t.*")
    )


def crawl_round(store: Store, captures: DataFrame, now: Column, **options) -> Store:
    """`crawl_changes` with the whole new frontier in `page` and all sites in `site`."""
    delta = crawl_changes(store, captures, now, **options)
    left_over = store["page"].where(is_waiting()).join(delta["page"].select("id"), "id", "left_anti")
    return {**delta, "page": delta["page"].unionByName(left_over), "site": upserted(store["site"], delta["site"])}


def upserted(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """Rows with the changed ones in place of those of the same id."""
    return rows.join(changes.select("id"), "id", "left_anti").select(*changes.columns).unionByName(changes)


def crawl_changes(
    store: Store,
    captures: DataFrame,
    now: Column,
    scope: str = SCOPE,
    fallback: str = FALLBACK_URL,
    keep_unreached: bool = False,
    in_flight: DataFrame | None = None,
    busy: DataFrame | None = None,
    host_ip: DataFrame | None = None,
    robots: DataFrame | None = None,
    one_per_host: bool = False,
    turn_seconds: float | None = None,
    hot_rows: int = HOT_ROWS,
    stage: Stage | None = None,
    bases: dict[str, int] | None = None,
) -> Store:
    """One turn for every page of the frontier; returns the rows that change.

    `captures` has (url, html), one row per URL.  In the result `page` holds the
    rows that left the frontier and those new in it, `site` new and changed sites, and
    `link`, `image`, `page_data` the new rows.  `bases` has the highest id of each table
    where the caller knows it, else it is looked up.  `keep_unreached` leaves pages
    without capture in the frontier, as a stream of captures needs it; then only the
    frontier rows that have a capture are looked at.  Rows whose URL is in `in_flight`,
    or whose host (or its address by `host_ip`) is in `busy`, wait for the next round;
    each of the two may be given alone.  `robots` has the fetched texts (domain,
    robots_content, sitemap_content); the hosts of the frontier become sites with them
    before their pages are decided.  `one_per_host` takes the earliest row of each host (or
    address) only, as a polite turn does.  `turn_seconds` is the time of the round: of each
    host it takes the rows that the delay of its robots rules leaves time for; rows that the
    rules forbid need no turn.
    Steps which several results need are written by `stage`, below the shared folder
    unless it says otherwise, so that no result computes them again.
    """
    page, site = store["page"], store["site"]
    bases = bases or {}
    stage = stage or written_stage(page.sparkSession, work_dir(page.sparkSession, "stage"))
    waiting = is_waiting()
    frontier, settled = page.where(waiting), page.where(~waiting)
    taken = frontier
    if keep_unreached:
        taken = taken.join(captures.select("url"), "url", "left_semi").select(*frontier.columns)
    if in_flight is not None or busy is not None or one_per_host:
        taken = frontier_available(taken, in_flight, busy, host_ip, hot_rows)
        if one_per_host:
            turn = stage("turn", next_per_host(taken).select("id"))
            taken = taken.join(turn, "id", "left_semi")
        taken = taken.select(*frontier.columns)
    if robots is not None:
        hosts = taken.select("url", F.col("id").alias("seen_at"))
        known = site.unionByName(changes.add_site(hosts, site, bases.get("site")))
        named = stage("named_sites", known.join(hosts.select(url_host(F.col("url")).alias("domain")).distinct(), "domain", "left_semi"))
        changed = stage("robots", changes.set_site_robots(conform(named, "site"), valid_robots(robots)))
        site = upserted(site, changed)
    if turn_seconds is None:
        decided = frontier_outcomes(taken, site, captures, hot_rows)
    else:
        ruled = stage("ruled", robots_allowed(taken.select("id", "url", "site_id"), site, ["id"], hot_rows))
        forbidden = F.coalesce(~F.col("allowed"), F.lit(False))
        turns = rows_in_time(with_politeness_key(ruled.where(~forbidden), host_ip), turn_seconds)
        in_turn = turns.select("id").unionByName(ruled.where(forbidden).select("id"))
        decided = _checked_outcomes(ruled.join(in_turn, "id", "left_semi"), captures)
    outcomes = stage("outcomes", decided)

    to_fetch = outcomes.where(F.col("status") == 200)
    found_hosts = to_fetch.select("url", F.col("id").alias("seen_at"))
    site_base = bases.get("site") if robots is None else None
    new_sites = stage("sites", changes.add_site(found_hosts, site, site_base))
    sites = site.unionByName(new_sites)
    fetched = stage(
        "fetched", changes.apply_fetch(to_fetch, captures, sites, settled, now, hot_rows)
    )

    refused = outcomes.where(F.col("status") == FORBIDDEN)
    unreached = outcomes.where(F.col("status") == UNREACHED)
    failed = refused if keep_unreached else refused.unionByName(unreached)
    failed_pages = changes.set_page_status(
        taken.join(failed.select("id"), "id", "left_semi"), failed.select("url", "status")
    )

    # pages whose content is new are read for links and images
    fresh = fetched.where(F.col("page_type_code") != "DUPLICATE").select(
        F.col("id").alias("page_id"), "site_id", "url", F.col("captured_html").alias("html")
    )
    references = stage("references", page_references(fresh))
    links = stage("links", reference_links(references, scope, fallback))
    referrer = fetched.select(F.col("id").alias("page_id"), "site_id")
    found = links.join(referrer, "page_id").select(
        "url", F.col("page_id").alias("seen_at"), F.col("first_at").alias("tie"), "site_id"
    )
    new_frontier = stage("new_frontier", changes.add_frontier(found, page, now, bases.get("page")))

    known = page.select("id", "url").unionByName(new_frontier.select("id", "url"))
    edges = url_to_page(
        links.select(F.col("page_id").alias("from_page"), "url"),
        known,
        ["from_page"],
        hot_rows=hot_rows,
    ).select("from_page", "to_page")
    copies = fetched.where(F.col("page_type_code") == "DUPLICATE").select(
        F.col("id").alias("from_page"), F.col("original_id").alias("to_page")
    )
    stored_html = F.when(F.col("page_type_code") != "BINARY", F.col("captured_html"))
    return {
        "site": new_sites if robots is None else upserted(changed, new_sites),
        "page": conform(fetched.withColumn("html_content", stored_html), "page")
        .unionByName(conform(failed_pages, "page"))
        .unionByName(new_frontier),
        "link": changes.add_link(edges.unionByName(copies), store["link"]),
        "image": changes.add_image(reference_images(references), store["image"], now, bases.get("image")),
        "page_data": changes.add_page_data(fetched, store["page_data"], bases.get("page_data")),
    }


def merge_round(store: Store, delta: Store) -> Store:
    """The tables after a round."""
    settled = store["page"].where(~is_waiting())
    return {
        **store,
        "site": delta["site"],
        "page": settled.unionByName(delta["page"]),
        **{t: store[t].unionByName(delta[t]) for t in ("link", "image", "page_data")},
    }


def seed_crawl(spark: SparkSession, urls: DataFrame, now: Column) -> Store:
    """Empty tables whose frontier holds the given (url, seen_at), each URL once."""
    store = seed_store(spark, ())
    found = urls.select("url", "seen_at", F.lit(0).alias("tie"), F.lit(1).alias("site_id"))
    return {**store, "page": changes.add_frontier(found, store["page"], now, base=0)}


def highest_ids(marker: dict) -> dict[str, int]:
    return {t: marker[f"top_{t}"] for t in NUMBERED}


class Crawled(dict):
    """The tables of a crawl; `finished` tells whether its frontier is empty."""

    finished: bool


def crawl_rounds(
    spark: SparkSession,
    captures: DataFrame,
    now: Column,
    root: str | None = None,
    seeds: DataFrame | None = None,
    max_rounds: int | None = None,
    page_budget: int | None = None,
    **options,
) -> Crawled:
    """Rounds until the frontier is empty, unless a budget of rounds or pages is given.

    Each round is written below `root` before the next one reads it, so plans stay
    short and a lost executor costs at most one round.  An interrupted run goes on
    from its last complete round.  A crawl that a budget ended, or whose remaining
    frontier rows all wait (`busy`, `in_flight`), is not `finished`.
    """
    root = root or work_dir(spark, "crawl")
    if rounds(spark, root) is None:
        start = seed_store(spark) if seeds is None else seed_crawl(spark, seeds, now)
        save_round(start, root, 0)
    first, number = rounds(spark, root)
    last = None if max_rounds is None else number + max_rounds
    before = None
    while True:
        store = Crawled(read_store(spark, root))
        known = state(spark, root)
        counts = known["waiting"], known["settled"]
        store.finished = counts[0] == 0
        used_up = number == last or bool(page_budget and counts[1] >= page_budget)
        if store.finished or used_up or counts == before:
            return store
        if number - known["base"] >= COMPACT_ROUNDS:
            compact_store(spark, root)
            number += 1
            last = last and last + 1
            store = Crawled(read_store(spark, root))
        before, number = counts, number + 1
        stage = written_stage(spark, f"{root}/stage/round={number}")
        delta = crawl_changes(store, captures, now, stage=stage, bases=highest_ids(known), **options)
        save_round(delta, root, number, first)


EXTRACTORS: dict[tuple[str, str], Callable[[DataFrame], DataFrame]] = {
    ("article", "regex"): records.article_regex,
    ("product", "regex"): records.product_regex,
    ("book", "regex"): records.book_regex,
    ("article", "path"): dom.article_path,
    ("product", "path"): dom.product_path,
    ("book", "path"): dom.book_path,
}


def extract_all(pages: DataFrame, kind: str, strategy: str, group: str = "grp") -> DataFrame:
    """Records of pages of one kind by `regex` or `path`, or their `template`."""
    if strategy == "template":
        return page_template(pages, group)
    return EXTRACTORS[kind, strategy](pages)


