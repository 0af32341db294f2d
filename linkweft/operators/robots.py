"""Robots rules and decisions for whole tables of sites and URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweft.functions import robots as R
from linkweft.functions.url import url_host
from linkweft.plans.skew import HOT_ROWS, skew_lookup


def site_policy(sites: DataFrame) -> DataFrame:
    """(domain, rules, delay), one row per domain; its earliest site counts."""
    first = sites.groupBy("domain").agg(F.min_by("robots_content", "id").alias("robots_content"))
    text = F.col("robots_content")
    return first.select(
        "domain", R.robots_rules(text).alias("rules"), R.robots_delay(text).alias("delay")
    )


def robots_rules(sites: DataFrame) -> DataFrame:
    """(domain, rule_no, allow, prefix) of the rules which apply to every agent."""
    return sites.select(
        "domain", F.explode(R.robots_rules(F.col("robots_content"))).alias("r")
    ).select("domain", "r.*")


def robots_sitemaps(sites: DataFrame) -> DataFrame:
    """(domain, sitemap): the first sitemap of each site that names one."""
    first = F.get(R.robots_sitemaps(F.col("robots_content")), F.lit(0))
    return sites.select("domain", first.alias("sitemap")).where(F.col("sitemap").isNotNull())


def robots_crawl_delay(sites: DataFrame) -> DataFrame:
    return sites.select("domain", R.robots_delay(F.col("robots_content")).alias("delay"))


def robots_allowed(
    urls: DataFrame,
    sites: DataFrame,
    spread_by: list[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add (delay, allowed) to rows with a `url`.

    The rules of a domain travel as one array, so a URL meets its rules without
    a row per rule.  A host without site row gives (5, NULL): not yet known.
    """
    known = urls.columns
    keyed = urls if "host" in known else urls.withColumn("host", url_host(F.col("url")))
    policy = site_policy(sites).withColumnRenamed("domain", "host")
    found = skew_lookup(keyed, policy, "host", spread_by or ["url"], hot_rows=hot_rows)
    return found.select(
        *known,
        F.coalesce("delay", F.lit(R.DEFAULT_DELAY)).alias("delay"),
        F.when(F.col("_matched"), R.allowed_by(F.col("rules"), F.col("url"))).alias("allowed"),
    )
