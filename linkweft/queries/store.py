"""Queries over the crawl tables: reading, lookups, changes, checks, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweft.functions import text as T
from linkweft.functions.url import url_host
from linkweft.operators import changes as C
from linkweft.operators import lookups as L
from linkweft.operators import summaries as A
from linkweft.operators.pages import page_images as images_of
from linkweft.operators.robots import robots_allowed
from linkweft.plans.session import work_dir
from linkweft.queries import checksql as S
from linkweft.queries.inputs import derived, table, with_inputs
from linkweft.queries.registry import query
from linkweft.sources import schema as SC
from linkweft.sources import store as ST

NOW = "2024-01-01 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def derived_store(spark: SparkSession, sf: str) -> SC.Store:
    names = ("site", "page", "page_data", "image", "link")
    store = {n: SC.conform(derived(spark, sf, f"d_{n}"), n) for n in names}
    enums = {n: SC.enum_table(spark, n) for n in ("data_type", "page_type")}
    return {**enums, **store}


def _page(spark, sf) -> DataFrame:
    return derived(spark, sf, "d_page")


ALL = ("d_site", "d_page", "d_page_data", "d_image", "d_link")


# --- sources and sinks -----------------------------------------------------------
def _columns(name: str) -> str:
    return ",".join(c.strip().split(" ")[0] for c in SC.COLUMNS[name].split(","))


@query(
    "crawl_schema",
    with_inputs(*ALL)
    + " "
    + " union all ".join(
        f"select '{n}' as table_name, '{_columns(n)}' as columns, count(*) as rows from d_{n}"
        for n in ("site", "page", "page_data", "image", "link")
    ),
)
def crawl_schema(spark, sf):
    store = derived_store(spark, sf)
    counts = [
        store[n].agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(n).alias("table_name"), F.lit(",".join(store[n].columns)).alias("columns"), "rows"
        )
        for n in ("site", "page", "page_data", "image", "link")
    ]
    return L._union(counts)


@query(
    "enum_tables",
    f"""{with_inputs('d_page')} select t.code, count(p.id) as pages
    from (values ('HTML'), ('BINARY'), ('DUPLICATE'), ('FRONTIER')) t(code)
    left join d_page p on p.page_type_code = t.code group by t.code""",
)
def enum_tables(spark, sf):
    return SC.enum_usage(_page(spark, sf))


_PAGE_COLUMNS = "id, site_id, page_type_code, url, html_content, http_status_code, hash_code"


@query(
    "scan_pages",
    f"{with_inputs('d_page')} select {_PAGE_COLUMNS} from d_page "
    "where page_type_code <> 'FRONTIER' order by id",
)
def scan_pages(spark, sf):
    return ST.scan_pages(derived_store(spark, sf)["page"]).drop("accessed_time")


@query(
    "scan_sites",
    f"{with_inputs('d_site')} select id, domain, robots_content, sitemap_content from d_site order by id",
)
def scan_sites(spark, sf):
    return ST.scan_sites(derived_store(spark, sf)["site"])


@query(
    "scan_images",
    f"{with_inputs('d_image')} select id, page_id, filename, content_type from d_image order by id",
)
def scan_images(spark, sf):
    return ST.scan_images(derived_store(spark, sf)["image"]).drop("data", "accessed_time")


@query(
    "scan_page_data",
    f"{with_inputs('d_page_data')} select id, page_id, data_type_code from d_page_data order by id",
)
def scan_page_data(spark, sf):
    return ST.scan_page_data(derived_store(spark, sf)["page_data"]).drop("data")


@query(
    "scan_links",
    f"{with_inputs('d_link')} select from_page, to_page from d_link order by from_page, to_page",
)
def scan_links(spark, sf):
    return ST.scan_links(derived_store(spark, sf)["link"])


@query(
    "load_html_files",
    "select sha256(html) as content_hash, length(html) as n_chars from pages",
)
def load_html_files(spark, sf):
    folder = work_dir(spark, "html")
    ST.save_html_files(table(spark, sf, "pages"), folder)
    saved = ST.load_html_files(spark, folder)
    body = F.regexp_replace("html", "\r$", "")
    return saved.select(T.content_hash(body).alias("content_hash"), F.length(body).alias("n_chars"))


@query(
    "reset_store",
    f"""{with_inputs(*ALL)}
    select 'before' as state, 'page' as table_name, count(*) as rows from d_page
    union all select 'before', 'site', count(*) from d_site
    union all select 'before', 'link', count(*) from d_link
    union all from (values ('after', 'page', 4), ('after', 'site', 1), ('after', 'link', 0))""",
)
def reset_store(spark, sf):
    root = work_dir(spark, "store")

    def counts(state: str) -> DataFrame:
        store = ST.read_store(spark, root)
        return L._union(
            [
                store[n].agg(F.count(F.lit(1)).alias("rows")).select(
                    F.lit(state).alias("state"), F.lit(n).alias("table_name"), "rows"
                )
                for n in ("page", "site", "link")
            ]
        )

    ST.save_round(derived_store(spark, sf), root, 0)
    before = counts("before")
    ST.reset_store(spark, root)
    return before.unionByName(counts("after"))


# --- lookups ---------------------------------------------------------------------
@query(
    "url_to_page",
    f"""{with_inputs('d_found', 'd_page')}
    select f.seen_at, f.tie, f.url, p.id as to_page from d_found f left join d_page p on p.url = f.url""",
)
def url_to_page(spark, sf):
    rows = derived(spark, sf, "d_found").select("seen_at", "tie", "url")
    return L.url_to_page(rows, _page(spark, sf), ["seen_at", "tie"])


@query(
    "page_to_site",
    f"""{with_inputs('d_page', 'd_site')}
    select p.id, p.host, s.id as site_id from d_page p left join d_site s on s.domain = p.host""",
)
def page_to_site(spark, sf):
    return L.page_to_site(_page(spark, sf), derived(spark, sf, "d_site"))


@query(
    "hash_exists",
    f"""{with_inputs('d_page')}
    select id, hash_code, hash_code <> '' and id > min(id) over (partition by hash_code) as seen_before
    from d_page""",
)
def hash_exists(spark, sf):
    return L.hash_exists(_page(spark, sf))


_DOCS = "with h as (select doc_id as id, sha256(text) as hash_code from documents)"


def _docs(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), T.content_hash(F.col("text")).alias("hash_code")
    )


@query(
    "duplicate_of",
    f"{_DOCS} select id, first as original_id from (select id, min(id) over (partition by hash_code) "
    "as first from h) where first < id",
)
def duplicate_of(spark, sf):
    return L.duplicate_of(_docs(spark, sf))


@query(
    "duplicate_links",
    f"""{with_inputs('d_page')} select id as from_page, first as to_page from (
      select id, min(id) over (partition by hash_code) as first from d_page where hash_code <> '')
    where first < id""",
)
def duplicate_links(spark, sf):
    return L.duplicate_links(_page(spark, sf))


_FREE = """
    busy as (
      select distinct 'h' || (case when c_custkey % 3 = 0 then 0 else c_custkey end) || '.example.com' as host
      from customer where c_mktsegment = 'BUILDING' and c_acctbal > 0),
    free as (
      select id, url, host from d_page
      where page_type_code = 'FRONTIER' and priority <> '1-URGENT' and host not in (select host from busy))"""


def _available(spark, sf) -> DataFrame:
    """Frontier without urgent orders (in flight) and without the hosts of some customers."""
    page = _page(spark, sf)
    frontier = page.where(SC.is_waiting()).select("id", "url", "host")
    in_flight = page.where(F.col("priority") == "1-URGENT").select("url")
    customers = table(spark, sf, "customer").where(
        (F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 0)
    )
    home = F.when(F.col("c_custkey") % 3 == 0, 0).otherwise(F.col("c_custkey"))
    busy = customers.select(F.concat(F.lit("h"), home, F.lit(".example.com")).alias("busy_key"))
    return L.frontier_available(frontier, in_flight, busy)


@query(
    "frontier_available",
    f"{with_inputs('d_page')}, {_FREE} select id, url, host as busy_key from free",
)
def frontier_available(spark, sf):
    return _available(spark, sf).drop("host")


# sites of even number share an address, of which every fifth is busy
_ADDRESS = "'10.0.0.' || cast(id % 50 as varchar)"


@query(
    "frontier_by_address",
    f"""{with_inputs('d_page', 'd_site')},
    address as (select domain as host, min({_ADDRESS}) as ip from d_site where id % 2 = 0 group by domain),
    keyed as (
      select p.id, p.url, coalesce(a.ip, p.host) as busy_key
      from d_page p left join address a using (host) where page_type_code = 'FRONTIER')
    select * from keyed where busy_key not in (select {_ADDRESS} from d_site where id % 5 = 0)""",
)
def frontier_by_address(spark, sf):
    site = derived(spark, sf, "d_site")
    address = F.concat(F.lit("10.0.0."), (F.col("id") % 50).cast("string"))
    host_ip = site.where("id % 2 = 0").groupBy(F.col("domain").alias("host")).agg(F.min(address).alias("ip"))
    busy = site.where("id % 5 = 0").select(address.alias("busy_key"))
    frontier = _page(spark, sf).where(SC.is_waiting()).select("id", "url", "host")
    return L.frontier_available(frontier, None, busy, host_ip).drop("host")


# --- checks ----------------------------------------------------------------------
def _fk_sql(references) -> str:
    parts = []
    for child, column, parent, key in references:
        parents = (
            f"select {key} as k from d_{parent}"
            if parent in ("page", "site")
            else "select k from (values "
            + ", ".join(f"('{c}')" for c in (SC.PAGE_TYPES if parent == "page_type" else SC.DATA_TYPES))
            + ") t(k)"
        )
        parts.append(
            f"select '{child}.{column}' as constraint_name, cast({column} as varchar) as value, "
            f"count(*) as child_rows from d_{child} where {column} is not null "
            f"and {column} not in ({parents}) group by {column}"
        )
    return f"{with_inputs(*ALL)} " + " union all ".join(parts)


@query("fk_violations", _fk_sql(SC.REFERENCES))
def fk_violations(spark, sf):
    return L.fk_violations(derived_store(spark, sf))


@query(
    "enum_violations",
    _fk_sql([r for r in SC.REFERENCES if r[2] in ("page_type", "data_type")]),
)
def enum_violations(spark, sf):
    return L.enum_violations(derived_store(spark, sf))


_UNIQUE = [(t, k) for t, k in SC.UNIQUE_KEYS if t not in ("page_type", "data_type")]


@query(
    "unique_violations",
    f"{with_inputs(*ALL)} "
    + " union all ".join(
        f"select '{t}({','.join(k)})' as constraint_name, concat_ws(',', {', '.join(k)}) as value, "
        f"count(*) as rows from d_{t} group by {', '.join(k)} having count(*) > 1"
        for t, k in _UNIQUE
    ),
)
def unique_violations(spark, sf):
    return L.unique_violations(derived_store(spark, sf))


@query(
    "length_violations",
    f"{with_inputs(*ALL)} "
    + " union all ".join(
        f"select '{t}.{c}' as constraint_name, cast(id as varchar) as row_key, length({c}) as length "
        f"from d_{t} where length({c}) > {n}"
        for t, c, n in SC.MAX_LENGTHS
        if t not in ("page_type", "data_type")
    ),
)
def length_violations(spark, sf):
    return L.length_violations(derived_store(spark, sf))


# --- changes ---------------------------------------------------------------------
@query(
    "add_frontier",
    f"""{with_inputs('d_found', 'd_page')},
    first as (
      select url, min(row(seen_at, tie)) as o, min_by(site_id, row(seen_at, tie)) as site_id
      from d_found where length(url) < 3000 and url not in (select url from d_page) group by url)
    select (select max(id) from d_page) + row_number() over (order by o, url) as id, site_id,
      'FRONTIER' as page_type_code, url, '' as html_content, 0 as http_status_code, '' as hash_code
    from first""",
)
def add_frontier(spark, sf):
    page = _page(spark, sf)
    return C.add_frontier(derived(spark, sf, "d_found"), page, now()).drop("accessed_time")


@query(
    "add_site",
    f"""{with_inputs('d_page', 'd_site')},
    found as (
      select {S.host('url')} as domain, min(seen_at) as seen_at
      from (select url, id as seen_at from d_page union all select url, page_id from pages) group by 1)
    select (select max(id) from d_site) + row_number() over (order by seen_at, domain) as id, domain,
      'NULL' as robots_content, 'NULL' as sitemap_content
    from found where domain is not null and domain not in (select domain from d_site)""",
)
def add_site(spark, sf):
    known = _page(spark, sf).select("url", F.col("id").alias("seen_at"))
    new = table(spark, sf, "pages").select("url", F.col("page_id").alias("seen_at"))
    return C.add_site(known.unionByName(new), derived(spark, sf, "d_site"))


@query(
    "add_link",
    f"""{with_inputs('d_link')}
    select distinct from_page, to_page from d_link
    except select l_orderkey, l_partkey * 10 from lineitem where l_returnflag = 'A'""",
)
def add_link(spark, sf):
    stored = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "A").select(
        F.col("l_orderkey").alias("from_page"), (F.col("l_partkey") * 10).alias("to_page")
    )
    return C.add_link(derived(spark, sf, "d_link"), stored)


@query(
    "add_image",
    f"""{with_inputs('d_rich', 'd_image')}, tags as ({S.tags('d_rich')}),
    found as (
      select page_id, pos, {S.attribute('tag', 'src')} as filename from tags where name = 'img')
    select (select max(id) from d_image) + row_number() over (order by page_id, pos) as id, page_id,
      filename, split_part(filename, '.', -1) as content_type
    from found where length(filename) <= 255 and length(split_part(filename, '.', -1)) <= 50""",
)
def add_image(spark, sf):
    found = images_of(derived(spark, sf, "d_rich"))
    new = C.add_image(found, derived(spark, sf, "d_image"), now())
    return new.drop("data", "accessed_time")


@query(
    "add_page_data",
    f"""{with_inputs('d_page', 'd_page_data')}
    select (select max(id) from d_page_data) + row_number() over (order by id) as id, id as page_id,
      upper(split_part(url, '.', -1)) as data_type_code
    from d_page where upper(split_part(url, '.', -1)) in ('PDF', 'DOC', 'DOCX', 'PPT', 'PPTX')""",
)
def add_page_data(spark, sf):
    return C.add_page_data(_page(spark, sf), derived(spark, sf, "d_page_data")).drop("data")


@query(
    "apply_fetch",
    f"""{with_inputs('d_doc')},
    h as (select *, sha256(html) as hash_code, {S.host('url')} as domain from d_doc),
    site as (select domain, min(id) as site_id from h where lang = 'en' group by domain),
    seen as (
      select hash_code, min(case when lang = 'en' then id end) as stored,
        min(case when lang <> 'en' then id end) as here from h group by hash_code),
    kind as (
      select h.*, site_id, case when h.url like '%.pdf' then 'BINARY'
        when stored is not null or here < h.id then 'DUPLICATE' else 'HTML' end as page_type_code,
        coalesce(stored, case when here < h.id then here end) as original_id
      from h join seen using (hash_code) left join site using (domain) where lang <> 'en')
    select id, site_id, page_type_code, url, html as captured_html, 200 as http_status_code, hash_code,
      original_id from kind""",
)
def apply_fetch(spark, sf):
    docs = derived(spark, sf, "d_doc")
    settled = docs.where(F.col("lang") == "en").withColumn(
        "hash_code", T.content_hash(F.col("html"))
    )
    waiting = docs.where(F.col("lang") != "en")
    site = settled.select("id", url_host(F.col("url")).alias("domain"))
    fetched = C.apply_fetch(waiting.select("id", "url"), waiting, site, settled, now())
    return fetched.drop("accessed_time")


@query(
    "set_page_status",
    f"""{with_inputs('d_page')} select id, url,
      case when priority in ('1-URGENT', '5-LOW') then 'HTML' else page_type_code end as page_type_code,
      case priority when '1-URGENT' then 403 when '5-LOW' then 404 else http_status_code end
        as http_status_code
    from d_page""",
)
def set_page_status(spark, sf):
    page = _page(spark, sf)
    status = F.when(F.col("priority") == "1-URGENT", 403).when(F.col("priority") == "5-LOW", 404)
    outcomes = page.select("url", status.alias("status")).dropna()
    return C.set_page_status(page, outcomes).select(
        "id", "url", "page_type_code", "http_status_code"
    )


@query(
    "set_site_robots",
    f"""{with_inputs('d_site')} select s.id, s.domain,
      case when c.c_custkey is not null then 'User-agent: ' || c.c_name else s.robots_content end
        as robots_content,
      case when c.c_custkey is not null then null else s.sitemap_content end as sitemap_content
    from d_site s left join customer c on c.c_custkey = s.id and c.c_mktsegment = 'BUILDING'""",
)
def set_site_robots(spark, sf):
    site = derived(spark, sf, "d_site")
    customers = table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")
    texts = customers.join(site, F.col("c_custkey") == F.col("id")).select(
        "domain",
        F.concat(F.lit("User-agent: "), "c_name").alias("robots_content"),
        F.lit(None).cast("string").alias("sitemap_content"),
    )
    return C.set_site_robots(site, texts)


@query(
    "delete_pages",
    f"""{with_inputs(*ALL)}
    select id, url from d_page where priority <> '1-URGENT' or id in (
      select from_page from d_link union all select to_page from d_link
      union all select page_id from d_image union all select page_id from d_page_data)""",
)
def delete_pages(spark, sf):
    store = derived_store(spark, sf)
    page = _page(spark, sf)
    urls = page.where(F.col("priority") == "1-URGENT").select("url")
    referenced = C.referenced_pages(store["link"], store["image"], store["page_data"])
    return C.delete_pages(page, urls, referenced).select("id", "url")


# --- counts, order, schedule -----------------------------------------------------
@query(
    "frontier_length",
    f"{with_inputs('d_page')} select count(*) as frontier from d_page where page_type_code = 'FRONTIER'",
)
def frontier_length(spark, sf):
    return A.frontier_length(_page(spark, sf))


@query(
    "pages_num",
    f"{with_inputs('d_page')} select count(*) as pages from d_page where page_type_code <> 'FRONTIER'",
)
def pages_num(spark, sf):
    return A.pages_num(_page(spark, sf))


@query(
    "crawl_summary",
    f"""{with_inputs(*ALL)}
    select 'frontier' as what, count(*) as rows from d_page where page_type_code = 'FRONTIER'
    union all select 'pages', count(*) from d_page where page_type_code <> 'FRONTIER'
    union all select 'sites', count(*) from d_site
    union all select 'page_data', count(*) from d_page_data
    union all select 'images', count(*) from d_image
    union all select 'links', count(*) from d_link""",
)
def crawl_summary(spark, sf):
    return A.crawl_summary(derived_store(spark, sf))


@query("site_domains", f"{with_inputs('d_site')} select id, domain from d_site order by id")
def site_domains(spark, sf):
    return A.site_domains(derived(spark, sf, "d_site"))


@query(
    "frontier_order",
    f"{with_inputs('d_page')} select id, url from d_page where page_type_code = 'FRONTIER' order by id",
)
def frontier_order(spark, sf):
    return A.frontier_order(_page(spark, sf))


@query(
    "next_per_host",
    f"""{with_inputs('d_page')}, {_FREE}
    select host, min(id) as id, min_by(url, id) as url from free group by host""",
)
def next_per_host(spark, sf):
    return A.next_per_host(_available(spark, sf))


@query(
    "fetch_schedule",
    f"""{with_inputs('d_site', 'd_page')}, {S.robots()}
    select p.id, p.url, p.host,
      cast((row_number() over (partition by p.host order by p.id) - 1) * d.delay as bigint) as start_at
    from d_page p join delays d on d.domain = p.host where p.page_type_code = 'FRONTIER'""",
)
def fetch_schedule(spark, sf):
    frontier = _page(spark, sf).where(SC.is_waiting()).select("id", "url")
    delays = robots_allowed(frontier, derived(spark, sf, "d_site"), ["id"])
    return A.fetch_schedule(delays)


# a store after two rounds of changes with a compaction between them
@query(
    "store_changes",
    f"""{with_inputs('d_page', 'd_site')},
    waiting as (select * from d_page where page_type_code = 'FRONTIER')
    select 'page' as table_name, id, concat_ws('|', page_type_code, http_status_code, url) as value
      from d_page where page_type_code <> 'FRONTIER'
    union all select 'page', id, concat_ws('|', 'HTML', 404, url) from waiting where id % 3 < 2
    union all select 'page', id, concat_ws('|', 'FRONTIER', 0, url) from waiting where id % 3 = 2
    union all select 'page', id + 10000000, concat_ws('|', 'FRONTIER', 0, url || '/next') from waiting where id % 3 = 0
    union all select 'site', id, domain || '|' || case when id % 2 = 0 then 'new'
      else coalesce(robots_content, '-') end from d_site
    union all select 'counts', 0, (select count(*) from waiting where id % 3 <> 1) || '|'
      || (select count(*) from d_page where page_type_code <> 'FRONTIER' or id % 3 < 2)""",
)
def store_changes(spark, sf):
    store, root = derived_store(spark, sf), work_dir(spark, "changes")
    ST.save_round(store, root, 0)
    none = {t: store[t].where(F.lit(False)) for t in ("site", "link", "image", "page_data")}
    waiting = store["page"].where(SC.is_waiting())

    def settled(rest: int) -> DataFrame:
        outcomes = waiting.where(F.col("id") % 3 == rest).select("url", F.lit(404).alias("status"))
        return C.set_page_status(waiting.where(F.col("id") % 3 == rest), outcomes)

    found = waiting.where(F.col("id") % 3 == 0).withColumns(
        {"id": F.col("id") + 10_000_000, "url": F.concat("url", F.lit("/next"))}
    )
    robots = store["site"].where(F.col("id") % 2 == 0).withColumn("robots_content", F.lit("new"))
    ST.save_round({**none, "page": settled(0).unionByName(found), "site": robots}, root, 1)
    ST.compact_store(spark, root)
    ST.save_round({**none, "page": settled(1)}, root, 3)
    after, known = ST.read_store(spark, root), ST.state(spark, root)
    page = after["page"].select(
        F.lit("page").alias("table_name"),
        "id",
        F.concat_ws("|", "page_type_code", "http_status_code", "url").alias("value"),
    )
    site = after["site"].select(
        F.lit("site"), "id", F.concat("domain", F.lit("|"), F.coalesce("robots_content", F.lit("-")))
    )
    counts = spark.range(1).select(F.lit("counts"), "id", F.lit(f"{known['waiting']}|{known['settled']}"))
    return page.union(site).union(counts)
