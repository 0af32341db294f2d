"""Queries which replay the crawl, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweft.functions.url import canonical_url, url_host
from linkweft.operators.lookups import _union
from linkweft.plans import crawl as C
from linkweft.plans.session import work_dir, written
from linkweft.queries import checksql as S
from linkweft.queries.inputs import derived, table, with_inputs
from linkweft.queries.pages import LINKS, PAGE_HOST
from linkweft.queries.registry import query
from linkweft.queries.store import derived_store, now
from linkweft.sources.schema import SEED_SITE, Store, is_waiting
from linkweft.streaming import ingest as I

SCOPE = "example."


def _seeds(spark, sf) -> DataFrame:
    pages = table(spark, sf, "pages")
    return pages.select(
        canonical_url(F.col("url")).alias("url"), F.col("page_id").alias("seen_at")
    )


@query(
    "seed_crawl",
    f"""with found as (
      select {S.canonical('url')} as url, min(page_id) as seen_at from pages group by 1)
    select row_number() over (order by seen_at, url) as id, 1 as site_id, 'FRONTIER' as page_type_code, url
    from found""",
)
def seed_crawl(spark, sf):
    store = C.seed_crawl(spark, _seeds(spark, sf), now())
    return store["page"].select("id", "site_id", "page_type_code", "url")


def _stored(spark, sf) -> tuple[Store, DataFrame]:
    """The derived store and its captures; pages and captures are written, as a round reads them several times."""
    store, captures = derived_store(spark, sf), derived(spark, sf, "d_capture")
    return {**store, "page": written(store["page"], "pages")}, written(captures, "captures")


def _rows(store) -> DataFrame:
    """The tables of a store as (table_name, key, value)."""

    def rows(name: str, key: str, *values: str) -> DataFrame:
        parts = [F.coalesce(F.col(v).cast("string"), F.lit("-")) for v in values]
        return store[name].select(
            F.lit(name).alias("table_name"),
            F.col(key).alias("key"),
            F.concat_ws("|", *parts).alias("value"),
        )

    return _union(
        [
            rows("site", "id", "domain"),
            rows("page", "id", "site_id", "page_type_code", "url", "http_status_code", "hash_code"),
            rows("link", "from_page", "to_page"),
            rows("image", "id", "page_id", "filename", "content_type"),
            rows("page_data", "id", "page_id", "data_type_code"),
        ]
    )


@query(
    "crawl_round",
    f"""{with_inputs('d_site', 'd_page', 'd_capture', 'd_link', 'd_image', 'd_page_data', 'd_rich')},
    {S.robots()},
    waiting as (select id, url, site_id, host, {S.robots_path('url')} as path from d_page
      where page_type_code = 'FRONTIER'),
    decided as (
      select w.id, min_by(r.allow, r.rule_no) as allow
      from waiting w join rules r on r.domain = w.host and starts_with(w.path, r.prefix) group by w.id),
    outcome as (
      select w.*, c.html, sha256(c.html) as h, case when not coalesce(d.allow, true) then 403
        when c.url is null then 404 else 200 end as status
      from waiting w left join decided d using (id) left join d_capture c on c.url = w.url),
    fetched as (
      select o.id, s.id as site_id, o.url, o.host, o.html, o.h, min(o.id) over (partition by o.h) as original,
        case when upper(split_part(o.url, '.', -1)) in ('PDF', 'DOC', 'DOCX', 'PPT', 'PPTX') then 'BINARY'
          when o.id > min(o.id) over (partition by o.h) then 'DUPLICATE' else 'HTML' end as kind
      from outcome o left join d_site s on s.domain = o.host where status = 200),
    hrefs as (
      select id, site_id, host, unnest(found) as link, unnest(generate_series(1, len(found))) as n
      from (select *, regexp_extract_all(html, '<a href="([^"]*)"', 1) as found from fetched
        where kind <> 'DUPLICATE')),
    links as (
      select id, site_id, url, min(n) as n from (
        select id, site_id, n, {S.resolve('link', 'host', 'false', SCOPE)} as url from hrefs)
      where url is not null group by id, site_id, url),
    new_urls as (
      select url, min(row(id, n)) as o, min_by(site_id, row(id, n)) as site_id from links
      where url not in (select url from d_page) group by url),
    new_pages as (
      select (select max(id) from d_page) + row_number() over (order by o, url) as id, site_id, url from new_urls),
    known as (select id, url from d_page union all select id, url from new_pages),
    edges as (
      select l.id as from_page, k.id as to_page from links l join known k on k.url = l.url
      union select id, original from fetched where kind = 'DUPLICATE'),
    images as (
      select id as page_id, unnest(found) as filename, unnest(generate_series(1, len(found))) as n
      from (select *, regexp_extract_all(html, '<img src="([^"]*)"', 1) as found from fetched
        where kind <> 'DUPLICATE'))
    select 'site' as table_name, id as key, domain as value from d_site
    union all select 'page', id, concat_ws('|', coalesce(cast(site_id as varchar), '-'), kind, url, '200', h) from fetched
    union all select 'page', id, concat_ws('|', site_id, 'HTML', url, status, '') from outcome where status <> 200
    union all select 'page', id, concat_ws('|', site_id, 'FRONTIER', url, '0', '') from new_pages
    union all select 'link', from_page, cast(to_page as varchar) from (
      select * from edges except select from_page, to_page from d_link)
    union all select 'image', (select max(id) from d_image) + row_number() over (order by page_id, n),
      concat_ws('|', page_id, filename, split_part(filename, '.', -1)) from images
    union all select 'page_data', (select max(id) from d_page_data) + row_number() over (order by id),
      concat_ws('|', id, upper(split_part(url, '.', -1))) from fetched where kind = 'BINARY'""",
)
def crawl_round(spark, sf):
    store, captures = _stored(spark, sf)
    stage = C.written_stage(spark, work_dir(spark, "stage"))
    return _rows(C.crawl_round(store, captures, now(), scope=SCOPE, stage=stage))


# what a crawl of all pages holds: links lead to pages without a capture, which only a batch crawl settles
_CRAWLED = f"""{LINKS},
    urls as (select min(page_id) as page_id, {S.canonical('url')} as url, min({S.host('url')}) as host from pages group by 2),
    targets as (
      select distinct u.url as source, target from (
        select page_id, {S.resolve('link', PAGE_HOST, "(kind = 'link')", SCOPE)} as target from links) l
      join urls u using (page_id) where target is not null)
    select 'page' as table_name, url as key, 'HTML|200' as value from urls
    union all select distinct 'page', target, '{{new_page}}' from targets where target not in (select url from urls)
    union all select 'link', source, target from targets
    union all select distinct 'site', host, null from urls
    union all select 'site', '{SEED_SITE}', null
    union all select 'image', u.url, src
      from (select page_id, {S.attribute('tag', 'src')} as src from tags where name = 'img') join urls u using (page_id)
      where length(src) <= 255 and length(split_part(src, '.', -1)) <= 50
    union all select 'page_data', url, upper(split_part(url, '.', -1)) from urls
      where upper(split_part(url, '.', -1)) in ('PDF', 'DOC', 'DOCX', 'PPT', 'PPTX')"""


@query("crawl_rounds", _CRAWLED.format(new_page="HTML|404"))
def crawl_rounds(spark, sf):
    captures = derived(spark, sf, "d_rich").withColumn("url", canonical_url(F.col("url")))
    captures = captures.groupBy("url").agg(F.min_by("html", "page_id").alias("html"))
    store = C.crawl_rounds(spark, captures, now(), seeds=_seeds(spark, sf), scope=SCOPE)
    return _by_url(store)


def _captured(spark, sf) -> DataFrame:
    """The pages in as many files as the session shuffles to, as a stream in two batches.

    Pages of one canonical URL are in one file, so it is the least page_id that counts.
    """
    folder = work_dir(spark, "captures")
    pages = derived(spark, sf, "d_rich").select("page_id", "url", "html")
    files = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pages.repartition(files, canonical_url(F.col("url"))).write.parquet(folder)
    return I.read_captures(spark, folder, files_per_batch=-(-files // 2))


@query("ingest_stream", _CRAWLED.format(new_page="FRONTIER|0"))
def ingest_stream(spark, sf):
    root = work_dir(spark, "stream")
    I.ingest_stream(_captured(spark, sf), root, now(), scope=SCOPE).awaitTermination()
    return _by_url(I.read_store(spark, root))


def _by_url(store) -> DataFrame:
    """The rows of a store as (table_name, key, value), pages named by URL instead of id."""
    page = store["page"]

    def url_of(column: str) -> DataFrame:
        return page.select(F.col("id").alias(column), F.col("url").alias(f"{column}_url"))

    state = F.concat_ws("|", "page_type_code", "http_status_code")
    parts = [
        page.select("url", state),
        store["link"].join(url_of("from_page"), "from_page").join(url_of("to_page"), "to_page").select(
            "from_page_url", "to_page_url"
        ),
        store["site"].select("domain", F.lit(None).cast("string")),
        store["image"].join(url_of("page_id"), "page_id").select("page_id_url", "filename"),
        store["page_data"].join(url_of("page_id"), "page_id").select("page_id_url", "data_type_code"),
    ]
    names = ("page", "link", "site", "image", "page_data")
    return _union(
        [
            part.toDF("key", "value").select(F.lit(name).alias("table_name"), "key", "value")
            for name, part in zip(names, parts)
        ]
    )


@query(
    "stream_url_dedupe",
    f"select distinct {S.canonical('url')} as url, {S.host('url')} as host from pages",
)
def stream_url_dedupe(spark, sf):
    folder = work_dir(spark, "unique")
    unique = I.stream_url_dedupe(_captured(spark, sf)).select(
        "url", url_host(F.col("url")).alias("host")
    )
    sink = unique.writeStream.format("parquet").option("checkpointLocation", f"{folder}-state")
    sink.trigger(availableNow=True).start(folder).awaitTermination()
    return spark.read.parquet(folder)


# documents fetched again as a stream with times, while the English ones are stored
@query(
    "stream_new_urls",
    f"""{with_inputs('d_doc')},
    urls as (select {S.canonical('url')} as url, lang from d_doc)
    select distinct url from urls where url not in (select url from urls where lang = 'en')""",
)
def stream_new_urls(spark, sf):
    folder, files = work_dir(spark, "new-urls"), max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    docs = derived(spark, sf, "d_doc")
    seen = docs.select("url", F.timestamp_seconds(F.col("id") + 1_000_000_000).alias("seen_at"))
    seen.repartition(files, "url").write.parquet(f"{folder}/in")
    stored = docs.where("lang = 'en'").select(canonical_url(F.col("url")).alias("url"))
    stored.write.parquet(f"{folder}/known")
    stream = spark.readStream.schema(seen.schema).option("maxFilesPerTrigger", -(-files // 2)).parquet(f"{folder}/in")
    known = spark.read.schema(stored.schema).parquet(f"{folder}/known")
    unique = I.stream_url_dedupe(stream, "seen_at", "36500 days", known).select("url")
    sink = unique.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state")
    sink.trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
    return spark.read.schema(unique.schema).parquet(f"{folder}/out")


# seconds of a round in which hosts keep the delays of their robots rules
TURN_SECONDS = 12


@query(
    "crawl_polite_round",
    f"""{with_inputs('d_site', 'd_page', 'd_capture')}, {S.robots()},
    waiting as (select id, url, host, {S.robots_path('url')} as path from d_page where page_type_code = 'FRONTIER'),
    decided as (
      select w.id, min_by(r.allow, r.rule_no) as allow
      from waiting w join rules r on r.domain = w.host and starts_with(w.path, r.prefix) group by w.id),
    ruled as (select w.*, coalesce(d.allow, true) as allow from waiting w left join decided d using (id)),
    turns as (
      select p.id, (row_number() over (partition by p.host order by p.id) - 1) * greatest(coalesce(d.delay, 5), 1) as start_at
      from ruled p left join delays d on d.domain = p.host where p.allow)
    select r.id, cast(case when not r.allow then 403 when t.start_at > {TURN_SECONDS} then 0
      when c.url is null then 404 else 200 end as int) as status
    from ruled r left join turns t using (id) left join d_capture c on c.url = r.url""",
)
def crawl_polite_round(spark, sf):
    store, captures = _stored(spark, sf)
    waiting = store["page"].where(is_waiting()).select("id")
    after = C.crawl_round(store, captures, now(), scope=SCOPE, turn_seconds=TURN_SECONDS)
    status = F.coalesce("http_status_code", F.lit(0)).cast("int").alias("status")
    return after["page"].join(waiting, "id", "left_semi").select("id", status)
