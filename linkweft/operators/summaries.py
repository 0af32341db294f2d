"""Counts over the crawl, frontier order, politeness schedule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkweft.functions.url import url_host
from linkweft.plans.skew import number_rows
from linkweft.sources.schema import Store, is_waiting

def frontier_length(page: DataFrame) -> DataFrame:
    return page.where(is_waiting()).agg(F.count(F.lit(1)).alias("frontier"))


def pages_num(page: DataFrame) -> DataFrame:
    return page.where(~is_waiting()).agg(F.count(F.lit(1)).alias("pages"))


def crawl_summary(store: Store) -> DataFrame:
    """(what, rows): frontier, pages, sites, page data, images, links."""
    both = store["page"].agg(
        F.count_if(is_waiting()).alias("frontier"), F.count_if(~is_waiting()).alias("pages")
    )
    pages = both.select(
        F.expr("stack(2, 'frontier', frontier, 'pages', pages) as (what, rows)")
    )
    others = [
        store[table].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("what"), "rows")
        for name, table in (
            ("sites", "site"),
            ("page_data", "page_data"),
            ("images", "image"),
            ("links", "link"),
        )
    ]
    return reduce(DataFrame.unionByName, others, pages)


def site_domains(site: DataFrame) -> DataFrame:
    return site.orderBy("id").select("id", "domain")


def frontier_order(page: DataFrame) -> DataFrame:
    """(id, url) of the frontier, first in first out."""
    return page.where(is_waiting()).select("id", "url").orderBy("id")


def next_per_host(available: DataFrame) -> DataFrame:
    """(host, id, url): the earliest available row of each host.

    A minimum, combined before the shuffle, so a host with most of the frontier
    costs one row per task.
    """
    host = F.col("busy_key") if "busy_key" in available.columns else url_host(F.col("url"))
    return (
        available.select(host.alias("host"), "id", "url")
        .groupBy("host")
        .agg(F.min(F.struct("id", "url")).alias("first"))
        .select("host", "first.id", "first.url")
    )


def rows_in_time(available: DataFrame, seconds: float, least_delay: float = 1.0) -> DataFrame:
    """The rows of `available` (id, url, delay, maybe busy_key) whose turn comes within `seconds`.

    The first row of a host is taken at once, the others follow in id order, `delay` seconds
    apart, and `least_delay` at least.  That bounds the turns of any host by a constant, so a
    task hands on at most so many rows of a host, whatever its share of the frontier (Spark
    does this for constants up to `spark.sql.optimizer.windowGroupLimitThreshold`).
    """
    host = F.col("busy_key") if "busy_key" in available.columns else url_host(F.col("url"))
    gap = F.greatest(F.coalesce(F.col("delay").cast("double"), F.lit(0.0)), F.lit(float(least_delay)))
    turn = F.row_number().over(Window.partitionBy("_host").orderBy("id"))
    ranked = available.withColumn("_host", host).withColumn("_turn", turn)
    most = int(seconds // least_delay) + 1
    in_time = (F.col("_turn") <= most) & ((F.col("_turn") - 1) * gap <= seconds)
    return ranked.where(in_time).select(*available.columns)


def fetch_schedule(available: DataFrame, parts: int | None = None) -> DataFrame:
    """(id, url, host, start_at): earliest second each row may be fetched.

    `available` has (id, url, delay); rows of one host keep `delay` seconds apart
    in id order.
    """
    rows = available.select("id", "url", url_host(F.col("url")).alias("host"), "delay")
    turns = number_rows(rows, "id", within=["host"], out="turn", parts=parts)
    return turns.select(
        "id", "url", "host", ((F.col("turn") - 1) * F.col("delay")).cast("long").alias("start_at")
    )
