"""Queries over page markup and robots texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkweft.functions import robots as R
from linkweft.operators import pages as P
from linkweft.operators import robots as RO
from linkweft.queries import checksql as S
from linkweft.queries.inputs import derived, table, with_inputs
from linkweft.queries.registry import query

SCOPE = "example."


@query("html_tokens", f"select page_id, cast(pos as int) as pos, kind, value from ({S.tokens('pages')})")
def html_tokens(spark, sf):
    return P.html_tokens(table(spark, sf, "pages"))


LINKS = f"{with_inputs('d_rich')}, tags as ({S.tags('d_rich')}), links as ({S.LINKS})"


def _kind(kind: str) -> str:
    return f"{LINKS} select page_id, kind, link from links where kind = '{kind}'"


@query("page_anchors", _kind("a"))
def page_anchors(spark, sf):
    return P.page_anchors(derived(spark, sf, "d_rich")).select("page_id", "kind", "link")


@query("page_areas", _kind("area"))
def page_areas(spark, sf):
    return P.page_areas(derived(spark, sf, "d_rich")).select("page_id", "kind", "link")


@query("page_link_tags", _kind("link"))
def page_link_tags(spark, sf):
    return P.page_link_tags(derived(spark, sf, "d_rich")).select("page_id", "kind", "link")


@query("page_onclick_links", _kind("onclick"))
def page_onclick_links(spark, sf):
    return P.page_onclick_links(derived(spark, sf, "d_rich")).select("page_id", "kind", "link")


PAGE_HOST = "split_part(url, '/', 3)"


@query(
    "page_links",
    f"""{LINKS} select distinct page_id, target as url from (
      select page_id, {S.resolve('link', PAGE_HOST, "(kind = 'link')", SCOPE)} as target from links)
    where target is not null""",
)
def page_links(spark, sf):
    return P.page_links(derived(spark, sf, "d_rich"), scope=SCOPE).select("page_id", "url")


@query(
    "page_images",
    f"""{with_inputs('d_rich')}, tags as ({S.tags('d_rich')})
    select page_id, src as filename, split_part(src, '.', -1) as content_type
    from (select page_id, {S.attribute('tag', 'src')} as src from tags where name = 'img')
    where length(src) <= 255 and length(split_part(src, '.', -1)) <= 50""",
)
def page_images(spark, sf):
    return P.page_images(derived(spark, sf, "d_rich")).drop("pos")


@query(
    "regex_find_all",
    """select page_id, cast(n as int) as match_no, match from (
      select page_id, unnest(found) as match, unnest(generate_series(1, len(found))) as n
      from (select page_id, regexp_extract_all(html, '<li><a href="([^"]*)">', 1) as found from pages))""",
)
def regex_find_all(spark, sf):
    return P.regex_find_all(table(spark, sf, "pages"), "html", '<li><a href="([^"]*)">')


@query(
    "robots_rules",
    f"{with_inputs('d_site')}, {S.robots()} "
    "select domain, cast(rule_no as int) as rule_no, allow, prefix from rules",
)
def robots_rules(spark, sf):
    return RO.robots_rules(derived(spark, sf, "d_site"))


@query(
    "robots_sitemaps",
    f"{with_inputs('d_site')}, {S.robots()} "
    "select domain, min_by(value, no) as sitemap from lines where key = 'sitemap' group by domain",
)
def robots_sitemaps(spark, sf):
    return RO.robots_sitemaps(derived(spark, sf, "d_site"))


@query(
    "robots_crawl_delay",
    f"{with_inputs('d_site')}, {S.robots()} select domain, delay from delays",
)
def robots_crawl_delay(spark, sf):
    return RO.robots_crawl_delay(derived(spark, sf, "d_site"))


@query(
    "robots_valid",
    f"{with_inputs('d_site')} select id, coalesce(contains(substr(repeat(' ', cast(id % 600 as int)) "
    "|| robots_content, 1, 300), 'User-agent'), false) as valid from d_site",
)
def robots_valid(spark, sf):
    text = F.concat(F.repeat(F.lit(" "), F.pmod("id", F.lit(600)).cast("int")), "robots_content")
    return derived(spark, sf, "d_site").select(
        "id", F.coalesce(R.robots_valid(text), F.lit(False)).alias("valid")
    )


# URLs of stored pages and of hosts without a site
_URLS = "select id, url from d_page union all select page_id, url from pages"


def _all_urls(spark, sf):
    known = derived(spark, sf, "d_page").select("id", "url")
    return known.unionByName(table(spark, sf, "pages").select(F.col("page_id").alias("id"), "url"))


@query(
    "robots_allowed",
    f"""{with_inputs('d_site', 'd_page')}, {S.robots()},
    urls as (select id, url, {S.host('url')} as domain, {S.robots_path('url')} as path from ({_URLS})),
    decided as (
      select u.url, min_by(r.allow, r.rule_no) as allow
      from urls u join rules r on r.domain = u.domain and starts_with(u.path, r.prefix)
      group by u.url)
    select u.id, u.url, coalesce(d.delay, 5) as delay,
      case when d.domain is not null then coalesce(a.allow, true) end as allowed
    from urls u left join delays d on d.domain = u.domain left join decided a on a.url = u.url""",
)
def robots_allowed(spark, sf):
    return RO.robots_allowed(_all_urls(spark, sf), derived(spark, sf, "d_site"), ["id"])
