"""Inputs of the registered queries, derived from the given tables.

Each input is one SQL text that Spark and DuckDB read alike, so a query and its
check start from the same rows.  A third of the customers share one host, so that
every join on hosts, hashes or URLs meets a hot key.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def _home(key: str) -> str:
    return f"(case when {key} % 3 = 0 then 0 else {key} end)"


def _host(key: str) -> str:
    return f"('h' || cast({_home(key)} as string) || '.example.com')"


_LF = "chr(10)"
_CENTS = "cast(floor({0} * 100 + 0.5) as bigint)"


def _money(cents: str) -> str:
    whole = f"cast(cast(floor(({cents}) / 100) as bigint) as string)"
    return f"('$' || {whole} || '.' || lpad(cast(({cents}) % 100 as string), 2, '0'))"


SQL: dict[str, str] = {}

SQL["d_site"] = f"""
select id, domain, cast(null as string) as sitemap_content,
  case id % 7
    when 0 then 'User-agent: bot' || {_LF} || 'Disallow: /' || {_LF} || {_LF} || 'User-agent: *'
      || {_LF} || {_LF} || 'Disallow: /a*' || {_LF} || 'Disallow: *' || {_LF} || 'Allow: /o/1'
      || {_LF} || 'Disallow: /o/' || {_LF} || 'Crawl-delay: 3' || {_LF} || 'Crawl-delay: '
      || cast(id % 9 as string) || {_LF} || 'Sitemap: http://' || domain || '/s.xml' || {_LF}
    when 1 then 'User-agent: a' || {_LF} || {_LF} || 'USER-AGENT: * # all' || {_LF} || 'Disallow: /p/'
    when 2 then 'User-agent: *' || {_LF} || 'Disallow: /o/' || {_LF} || 'User-agent: *' || {_LF}
      || 'Disallow: /p/' || {_LF} || 'Crawl-delay: 9'
    when 3 then 'NULL'
    when 4 then 'User-agent:' || {_LF} || 'Disallow: /f/1' || {_LF} || 'User-agent: *' || {_LF}
      || 'Allow: /' || {_LF} || 'Crawl-delay: 2'
    when 5 then 'User-agent: *' || {_LF} || 'Disallow: # none' || {_LF} || 'Crawl-delay: 1.5' || {_LF}
      || 'SITEMAP: http://' || domain || '/a.xml' || {_LF} || 'Sitemap: http://' || domain || '/b.xml'
    else cast(null as string) end as robots_content
from (
  select min(c_custkey) as id, domain
  from (select c_custkey, {_host("c_custkey")} as domain from {{customer}}) c
  group by domain) s
"""

SQL["d_page"] = f"""
select o_orderkey as id, {_home("o_custkey")} as site_id,
  case o_orderstatus when 'O' then 'FRONTIER' when 'F' then 'HTML' else
    case when o_orderpriority = '4-NOT SPECIFIED' then 'OTHER'
         when o_orderpriority = '5-LOW' then 'DUPLICATE' else 'BINARY' end end as page_type_code,
  'http://' || {_host("o_custkey")} || '/' || lower(o_orderstatus) || '/' || cast(o_orderkey as string)
    || case o_orderkey % 20 when 0 then '.pdf' when 1 then '.docx' when 2 then '.html?b=1' else '' end
    as url,
  case when o_orderstatus = 'O' then '' else '<p>' || o_orderpriority || '</p>' end as html_content,
  case when o_orderstatus = 'O' then 0 else 200 end as http_status_code,
  case when o_orderstatus = 'O' then '' else md5(cast({_home("o_custkey")} as string)) end as hash_code,
  {_host("o_custkey")} as host, o_orderpriority as priority
from {{orders}}
"""

SQL["d_link"] = "select l_orderkey as from_page, l_partkey * 10 as to_page from {lineitem}"

SQL["d_image"] = """
select p_partkey as id, p_partkey * 8 as page_id,
  '/i/' || repeat('x', cast(p_partkey % 300 as int)) || '.' || lower(p_type) as filename,
  lower(p_type) as content_type
from {part}
"""

SQL["d_page_data"] = """
select p_partkey as id, p_partkey * 9 as page_id,
  case p_type when 'ECONOMY' then 'PDF' when 'SMALL' then 'DOCX' else p_type end as data_type_code
from {part}
"""

# links by URL: a third of them name one page
SQL["d_found"] = f"""
select l.l_orderkey as seen_at, l.l_linenumber as tie, l.l_orderkey % 50 as site_id,
  coalesce(p.url, 'http://new.example.com/' || cast(l.l_partkey as string)
    || repeat('y', cast(l.l_partkey % 31 * 100 as int))) as url
from {{lineitem}} l
left join (
  select o_orderkey, 'http://' || {_host("o_custkey")} || '/' || lower(o_orderstatus) || '/'
    || cast(o_orderkey as string) || case o_orderkey % 20 when 0 then '.pdf' when 1 then '.docx'
      when 2 then '.html?b=1' else '' end as url
  from {{orders}}) p
  on p.o_orderkey = case when l.l_partkey % 3 = 0 then 0 else l.l_partkey * 10 end
"""

# URL spellings of every page
SQL["d_url"] = " union all ".join(
    f"select page_id, {i} as variant, {text} as url from {{pages}}"
    for i, text in enumerate(
        [
            "url",
            "'HTTPS://User@' || upper(split_part(url, '/', 3)) || ':8080/A/' || cast(page_id as string)"
            " || ';Q=2;p=1?B=2&a=1#f'",
            "'http://a/x;y/' || cast(page_id as string) || ';w'",
            "'http://' || split_part(url, '/', 3) || '/b?x&&Y' || cast(page_id as string)",
            "'http://a.si/č d%20~*(' || cast(page_id as string) || ')'",
            "'ftp://' || upper(split_part(url, '/', 3)) || '/x;T'",
            "'mailto:x@' || split_part(url, '/', 3)",
            "'http:' || cast(page_id as string)",
            "'http:///x' || cast(page_id as string)",
            "'  http://' || split_part(url, '/', 3) || '?q'",
            "'gopher://' || split_part(url, '/', 3) || '/A;B'",
        ]
    )
)

# links as found on a page, with the host of the page
SQL["d_href"] = " union all ".join(
    f"select page_id, {i} as variant, {only} as absolute_only, split_part(url, '/', 3) as page_host, "
    f"{text} as link from {{pages}}"
    for i, (text, only) in enumerate(
        [
            ("'/a?B=' || cast(page_id as string)", "false"),
            ("'//x.si/y'", "false"),
            ("'/a'", "true"),
            ("'https://www.EXAMPLE.org/' || cast(page_id as string)", "true"),
            ("'http://gov.si/'", "false"),
            ("'HTTP://www.example.com/'", "false"),
            ("'x.html'", "false"),
            ("cast(null as string)", "false"),
            ("'httpfoo'", "false"),
            ("url", "false"),
        ]
    )
)

# pages with every kind of link and image put in front
SQL["d_rich"] = """
select page_id, url,
  '<img src="/i/' || cast(page_id as string) || '.PNG"><IMG alt="a > b" SRC=/logo><img src="/r.gif">'
  || '<img src="/r.gif"><img src="/' || repeat('z', cast(page_id % 300 as int)) || '.png">'
  || '<area href="/a/' || cast(page_id % 7 as string) || '?B=2&amp;a=1">'
  || '<link href="http://cdn.example.com/' || cast(page_id as string) || '.css"><link href="/rel.css">'
  || '<div onclick="location.href=' || chr(39) || '/o/' || cast(page_id as string) || chr(39) || '">x</div>'
  || '<span onclick="open(' || chr(39) || '/s' || chr(39) || ')">y</span>'
  || '<a title="href=/no" href="https://User@WWW.Example.COM:8080/A b;Q;p?z=1&amp;y=2#frag">q</a>'
  || '<a href="http://elsewhere.si/">z</a><a>n</a>' || html as html
from {pages}
"""

SQL["d_pair"] = """
select a.page_id as pair_id, a.html as left_html, b.html as right_html
from {pages} a join {pages} b on b.page_id = a.page_id + 1
"""

# pages of one host are one group
SQL["d_group"] = "select page_id, split_part(url, '/', 3) as host, html from {pages}"

# one product per line item, one list page per order
_LIST = _CENTS.format("l_extendedprice")
_DISCOUNT = _CENTS.format("l_discount")
_SAVING = f"cast(floor({_LIST} * {_DISCOUNT} / 100) as bigint)"
SQL["d_product"] = f"""
select l_orderkey as page_id,
  row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice)
    as record_no,
  p_partkey as product_id, p_name as title, {_money(_LIST)} as list_price,
  {_money(f"{_LIST} - {_SAVING}")} as price, {_money(_SAVING)} as saving,
  '(' || cast({_DISCOUNT} as string) || '%)' as percent, p_type || ' of ' || p_brand as content, p_size
from {{lineitem}} join {{part}} on l_partkey = p_partkey
"""

_ANCHOR = (
    "'<a href=\"http://www.overstock.com/cgi-bin/d2.cgi?PAGE=PROFRAME&amp;PROD_ID='"
    " || cast(product_id as string) || '\">'"
)
_CELL_HEAD = (
    "<table><tbody><tr><td>1</td><td>2</td><td>3</td><td>4</td><td><table><tbody><tr><td>h</td></tr>"
    "<tr><td><table><tbody><tr><td><table><tbody>"
)
_CELL_TAIL = (
    "</tbody></table></td></tr></tbody></table></td></tr></tbody></table></td></tr></tbody></table>"
)
# how a product looks on its list page
PRODUCT_HTML = f"""
'<tr><td>img</td><td>' || {_ANCHOR} || '<b>' || title || '</b></a>' || {_LF}
  || '<table><tbody><tr><td><table><tbody><tr><td>List:</td><td><s>' || list_price || '</s></td></tr>' || {_LF}
  || '<tr><td>Price:</td><td><span class="big"><b>' || price || '</b></span></td></tr>' || {_LF}
  || '<tr><td>Save:</td><td><span>' || saving || ' ' || percent || '</span></td></tr></tbody></table></td>' || {_LF}
  || '<td><span class="normal">' || content || '<br>' || {_ANCHOR} || '<span class="tiny"><b>more</b></span></a></span></td></tr></tbody></table>'
  || '</td></tr>'
"""


def _product_pages(item: str) -> str:
    return f"""
select page_id, '<html><body>{_CELL_HEAD}' || list_html || '{_CELL_TAIL}</body></html>' as html, page_id % 10 as grp
from (
  select page_id, {{join_items}} as list_html
  from (select page_id, record_no, {item} as item from ({SQL["d_product"]}) p) i
  group by page_id) g
"""


SQL["d_product_page"] = _product_pages(PRODUCT_HTML)

# the same lists with links to other pages inside the contents
CONTENT_LINK = "'<br><a href=\"/size\">sizes</a> second part<br><a href=\"/d2.cgi?PROD_ID=1\">other</a> end'"
SQL["d_linked_product_page"] = _product_pages(
    PRODUCT_HTML.replace("|| content ||", f"|| content || {CONTENT_LINK} ||")
)

# one article per document, whole text as content
_ESCAPED = "replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_BODY = f"replace({_ESCAPED.format('text')}, {_LF}, ' ')"
SQL["d_article"] = f"""
select doc_id as page_id,
  '<html><body><header class="article-header"><h1>Title ' || cast(doc_id as string) || '</h1>' || {_LF}
  || '<div class="subtitle">On ' || source || ' &amp; more</div>' || {_LF}
  || '<p class="lead">Written in ' || lang || '</p>' || {_LF} || '</header>'
  || '<div class="author"><div class="author-name">Ana Č ' || lang || '</div></div>'
  || '<div class="publish-meta">' || {_LF} || chr(9) || cast(n_chars as string) || '. marec 2020 ob 12:30'
  || {_LF} || chr(9) || 'x</div>'
  || '<div class="author-timestamp"><strong>Ana Č ' || lang || '</strong>| '
  || cast(n_chars as string) || '. marec 2020 ob 12:30' || chr(9) || '</div>' || {_LF}
  || '<div class="article-body"><article><p class="Body"></p><p class="Body">' || {_BODY} || {_LF}
  || '</p></article></div>' || case doc_id % 4 when 1 then '</div></p>' when 2 then '<div><p>' else '' end
  || '</body></html>' as html
from {{documents}}
"""
SQL["d_article_record"] = f"""
select doc_id as page_id, 'Title ' || cast(doc_id as string) as title, 'On ' || source as subtitle,
  'Ana Č ' || lang as author, cast(n_chars as string) || '. marec 2020 ob 12:30' as published,
  'Written in ' || lang as lead, replace(text, {_LF}, ' ') as content, {_BODY} as escaped
from {{documents}}
"""

# paragraphs, list items and cells without their ends, with inline tags in them
SQL["d_open_page"] = """
select doc_id as page_id,
  '<html><body><div><article><p>In ' || lang || ' <b>bold ' || cast(doc_id as string) || '</b> from ' || source
  || '<p>second<ul><li>' || source || '<ul><li>inner</ul> on<li>last <i>i</i> item</ul>'
  || '<table><tr><td>' || lang || '<td>' || cast(n_chars as string) || '<tr><td>x</table>'
  || case doc_id % 3 when 0 then '<p>end' when 1 then 'end' else '<div><p>end' end
  || '</article></div> after</body></html>' as html, lang, source, n_chars
from {documents}
"""

# one book list per order
BOOK_HTML = f"""
'<li class="ie-custom-grid tw-relative"><div class="book-item-information tw-relative">'
  || '<a class="ie-book-title x" href="/b">' || title || '<span></span></a>'
  || '<a class="tw-text-darkblue tw-text-sm tw-underline" href="/c"> ' || percent || ' Č </a>' || {_LF}
  || '<div>d</div><div>e</div>'
  || '<div class="product_var tw-text-darkblue tw-text-sm tw-font-bold">Vezava: ' || list_price || ' </div></div>'
  || '<div class="book-item-buy"> <div> <div><span>' || price || '</span></div></div></div></li>' || {_LF}
"""
SQL["d_book_page"] = f"""
select page_id, '<html><body><ul>' || {_LF} || list_html || '</ul></body></html>' as html
from (
  select page_id, {{join_items}} as list_html
  from (select page_id, record_no, {BOOK_HTML} as item from ({SQL["d_product"]}) p) i
  group by page_id) g
"""

# one list of terms per order; a third of the terms have two descriptions, some lists a heading,
# and those of one group a term without any at the end
_TERM = """
'<dt>' || title || '</dt><dd>' || price || '</dd>' || case record_no % 3 when 0 then '<dd>' || content || '</dd>' else '' end
"""
SQL["d_term_page"] = f"""
select page_id, 't' || cast(page_id % 10 as string) as host,
  '<html><body>' || case page_id % 20 when 2 then '<h2>Parts</h2>' else '' end || '<dl>' || list_html
  || case page_id % 10 when 3 then '<dt>more</dt>' else '' end || '</dl><p>end</p></body></html>' as html
from (
  select page_id, {{join_items}} as list_html
  from (select page_id, record_no, {_TERM} as item from ({SQL["d_product"]}) p) i
  group by page_id) g
"""

# documents as captures: English ones are stored already, the others are fetched
SQL["d_doc"] = """
select doc_id as id, 'http://' || source || '.example.com/' || lang || '/' || cast(doc_id as string)
  || case doc_id % 10 when 0 then '.pdf' else '' end as url, lang, text as html
from {documents}
"""

# captures of stored pages; a third have the same content, low priority pages have none
SQL["d_capture"] = f"""
select url, case when o_custkey % 3 = 0 then '<p>same</p>' else
    '<a href="http://' || host || '/new/' || cast(o_custkey as string) || '">n</a>'
    || '<a href="/f/' || cast(id - 1 as string) || '">f</a><a href="http://elsewhere.si/">e</a>'
    || '<img src="/i/' || cast(o_custkey as string) || '.png"><img src="/i/x.gif">' end as html
from (select p.*, o_custkey from ({SQL["d_page"]}) p join {{orders}} on o_orderkey = id) c
where priority <> '5-LOW'
"""

# lists whose items are in order: (Spark, DuckDB)
_JOIN_ITEMS = (
    "array_join(transform(array_sort(collect_list(struct(record_no, item))), x -> x.item), '')",
    "string_agg(item, '' order by record_no)",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fill(sql: str, tables: dict[str, str], join_items: str) -> str:
    sql = sql.replace("{join_items}", join_items)
    return re.sub(r"\{(\w+)\}", lambda m: tables.get(m[1], m[0]), sql)


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input as a Spark DataFrame."""
    sql = SQL[name]
    used = [t for t in TABLES if "{" + t + "}" in sql]
    text = _fill(sql, {}, _JOIN_ITEMS[0])
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in used})


def with_inputs(*names: str) -> str:
    """`with name as (...), ...` for check SQL."""
    parts = [
        f"{n} as ({_fill(SQL[n], {t: t for t in TABLES}, _JOIN_ITEMS[1]).strip()})" for n in names
    ]
    return "with " + ", ".join(parts)
