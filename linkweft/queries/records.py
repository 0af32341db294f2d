"""Queries which read records from pages, by regular expression and by path."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweft.operators import dom as D
from linkweft.operators import records as R
from linkweft.operators.template import template_lines
from linkweft.plans.crawl import extract_all as extract
from linkweft.queries import checksql as S
from linkweft.queries.inputs import CONTENT_LINK, derived, table, with_inputs
from linkweft.queries.registry import query
from linkweft.queries.templates import TERM_LINES
from linkweft.sources.store import records_to_json as to_json


@query(
    "first_match",
    """select page_id, case when regexp_matches(html, '<li><a href="/[^"]*[.,]">') then
      regexp_extract(html, '<li><a href="(/[^"]*[.,])">', 1) end as link from pages""",
)
def first_match(spark, sf):
    found = R.first_match(F.col("html"), '<li><a href="(/[^"]*[.,])">')
    return table(spark, sf, "pages").select("page_id", found.alias("link"))


@query(
    "record_ordinal",
    """select page_id, cast(n as int) as record_no, word as Word from (
      select page_id, unnest(found) as word, unnest(generate_series(1, len(found))) as n
      from (select page_id, regexp_extract_all(html, '<li><a href="/([^"]*)">', 1) as found from pages))""",
)
def record_ordinal(spark, sf):
    words = F.regexp_extract_all("html", F.lit('<li><a href="/([^"]*)">'), F.lit(1))
    return R.zip_fields(table(spark, sf, "pages"), {"Word": words}, "Word")


@query(
    "zip_fields",
    """select page_id, cast(n as int) as record_no, links[n] as Link, tags[n] as Tag from (
      select page_id, links, tags, unnest(generate_series(1, len(links))) as n
      from (select page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) as links,
        regexp_extract_all(html, '</([a-z0-9]+)>', 1) as tags from pages))""",
)
def zip_fields(spark, sf):
    links = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    tags = F.regexp_extract_all("html", F.lit("</([a-z0-9]+)>"), F.lit(1))
    return R.zip_fields(table(spark, sf, "pages"), {"Link": links, "Tag": tags}, "Link")


@query(
    "regex_record",
    """select page_id,
      case when regexp_matches(html, '<html lang="') then regexp_extract(html, '<html lang="([a-z]+)">', 1) end as Lang,
      case when regexp_matches(html, '<h1>[^<]*</h1>') then regexp_extract(html, '<h1>([^<]*)</h1>', 1) end as Title,
      case when regexp_matches(html, 'track\\(\\d+\\);') then regexp_extract(html, '(track)\\((\\d+)\\);', 1) end as Call,
      case when regexp_matches(html, 'track\\(\\d+\\);') then regexp_extract(html, '(track)\\((\\d+)\\);', 2) end as Number
    from pages""",
)
def regex_record(spark, sf):
    pages = table(spark, sf, "pages")
    pages = R.regex_record(pages, "html", '<html lang="([a-z]+)">', ["Lang"])
    pages = R.regex_record(pages, "html", "<h1>([^<]*)</h1>", ["Title"])
    pages = R.regex_record(pages, "html", r"(track)\((\d+)\);", ["Call", "Number"])
    return pages.drop("url", "html")


_ITEM = '<li><a href="(/([^"]*))">([^<]*)</a>'


@query(
    "regex_records",
    f"""select page_id, cast(n as int) as record_no, words[n] as Word, texts[n] as Text from (
      select page_id, words, texts, unnest(generate_series(1, len(words))) as n
      from (select page_id, regexp_extract_all(html, '{_ITEM}', 2) as words,
        regexp_extract_all(html, '{_ITEM}', 3) as texts from pages))""",
)
def regex_records(spark, sf):
    return R.regex_records(table(spark, sf, "pages"), "html", _ITEM, ["Word", "Text"])


_ARTICLE = (
    "{0} select page_id, title as Title, {1} as SubTitle, author as Author, "
    "published as PublishedTime, lead as Lead, {2} as Content from d_article_record"
)


@query(
    "article_regex",
    _ARTICLE.format(
        with_inputs("d_article_record"), "subtitle || ' &amp; more'", "escaped"
    ),
)
def article_regex(spark, sf):
    return R.article_regex(derived(spark, sf, "d_article"))


@query(
    "article_path",
    _ARTICLE.format(
        with_inputs("d_article_record"), "subtitle || ' & more'", "content || chr(10) || chr(10)"
    ),
)
def article_path(spark, sf):
    return D.article_path(derived(spark, sf, "d_article"))


_PRODUCT = (
    f"{with_inputs('d_product')} select page_id, cast(record_no as int) as record_no, title as Title, "
    "list_price as ListPrice, price as Price, saving as Saving, percent as SavingPercent, "
    "{0} as Content from d_product"
)


@query("product_regex", _PRODUCT.format(f"content || {CONTENT_LINK}"))
def product_regex(spark, sf):
    return R.product_regex(derived(spark, sf, "d_linked_product_page"))


@query("product_path", _PRODUCT.format("content"))
def product_path(spark, sf):
    return D.product_path(derived(spark, sf, "d_product_page"))


_BOOK = (
    f"{with_inputs('d_product')} select page_id, cast(record_no as int) as record_no, title as Title, "
    "percent || ' Č' as Author, list_price as Binding, price as Price from d_product"
)


@query("book_regex", _BOOK)
def book_regex(spark, sf):
    return R.book_regex(derived(spark, sf, "d_book_page"))


@query("book_path", _BOOK)
def book_path(spark, sf):
    return D.book_path(derived(spark, sf, "d_book_page"))


@query(
    "records_to_json",
    f"""{with_inputs('d_product')} select page_id, record_no, case when p_size < 25
      then json_object('Title', title, 'Price', price)
      else json_object('Title', title, 'Price', price, 'Saving', saving) end::varchar as record
    from d_product""",
)
def records_to_json(spark, sf):
    rows = derived(spark, sf, "d_product").select(
        "page_id",
        "record_no",
        F.col("title").alias("Title"),
        F.col("price").alias("Price"),
        F.when(F.col("p_size") >= 25, F.col("saving")).alias("Saving"),
    )
    return to_json(rows, ["Title", "Price", "Saving"])


def _digested(kind: str, strategy: str, source: str, *fields: str) -> str:
    return f"""
    select '{kind}' as kind, '{strategy}' as strategy, page_id, count(*) as records,
      sha256(string_agg(concat_ws(chr(9), {', '.join(fields)}), chr(10) order by record_no)) as digest
    from {source} group by page_id"""


_RECORD = ("title", "list_price", "price", "saving", "percent", "content")
_ARTICLE_START = ("published", "lead")
_ALL = [
    _digested("article", "regex", "articles", "title", "subtitle || ' &amp; more'", "author", *_ARTICLE_START, "escaped"),
    _digested("article", "path", "articles", "title", "subtitle || ' & more'", "author", *_ARTICLE_START, "content || chr(10) || chr(10)"),
    *[_digested("product", strategy, "d_product", *_RECORD) for strategy in ("regex", "path")],
    *[_digested("book", strategy, "d_product", "title", "percent || ' Č'", "list_price", "price") for strategy in ("regex", "path")],
]


# all kinds by all strategies: the records of a page, or the template lines of a group, as one digest
@query(
    "extract_all",
    f"""{with_inputs('d_product', 'd_article_record', 'd_term_page')}, {TERM_LINES},
    articles as (select *, 1 as record_no from d_article_record)
    {' union all '.join(_ALL)}
    union all select 'any', 'template', cast(substr(grp, 2) as bigint), len(texts), sha256(array_to_string(texts, chr(10)))
    from lines""",
)
def extract_all(spark, sf):
    sources = {"article": "d_article", "product": "d_product_page", "book": "d_book_page"}
    parts = []
    for kind, source in sources.items():
        pages = derived(spark, sf, source)
        for strategy in ("regex", "path"):
            found = extract(pages, kind, strategy)
            fields = [c for c in found.columns if c not in ("page_id", "record_no")]
            number = F.col("record_no") if "record_no" in found.columns else F.lit(1)
            record = F.concat_ws("\t", *fields)
            parts.append(_digests(found.select("page_id", number.alias("no"), record.alias("line")), kind, strategy))
    template = template_lines(extract(derived(spark, sf, "d_term_page"), "any", "template", "host"))
    group = F.substring("grp", 2, 20).cast("long").alias("page_id")
    parts.append(_digests(template.select(group, F.col("line_no").alias("no"), "line"), "any", "template"))
    return reduce(DataFrame.unionByName, parts)


def _digests(lines: DataFrame, kind: str, strategy: str) -> DataFrame:
    in_order = F.array_sort(F.collect_list(F.struct("no", "line")))
    made = lines.groupBy("page_id").agg(F.count(F.lit(1)).alias("records"), in_order.alias("all"))
    digest = F.sha2(F.array_join("all.line", "\n"), 256).alias("digest")
    return made.select(F.lit(kind).alias("kind"), F.lit(strategy).alias("strategy"), "page_id", "records", digest)


@query(
    "dom_nodes",
    f"""with {S.nodes()}
    select page_id, node_id, parent_id, kind, tag, case kind when 'element' then cast(nth as int) end as nth, level,
      case when nests or kind = 'text' then path else path || '/' || tag || '[' || nth || ']' end as path,
      {S.attribute('source', 'href')} as href, case kind when 'element' then {S.attributes('source')} end as attrs,
      after_tag, text
    from nodes""",
)
def dom_nodes(spark, sf):
    nodes = D.dom_nodes(table(spark, sf, "pages"))
    pairs = F.transform(F.map_entries("attrs"), lambda x: F.concat(x["key"], F.lit("="), x["value"]))
    joined = F.array_join(F.array_sort(pairs), "|")
    return nodes.withColumns({"href": F.col("attrs")["href"], "attrs": joined})


@query(
    "path_select",
    f"""with {S.nodes()}
    select page_id, cast(row_number() over (partition by page_id order by node_id) as int) as match_no, node_id,
      text
    from nodes where kind = 'text' and after_tag is null
      and regexp_matches(path, '^(/.*)?/nav\\[\\d+\\]/(.*/)?li\\[2\\]/a\\[\\d+\\]$')""",
)
def path_select(spark, sf):
    return D.path_select(table(spark, sf, "pages"), "//nav//li[2]/a/text()").drop("tag")


# direct texts of elements that end without an end tag
_OPEN_PATHS = {
    "paragraphs": "//article/p/text()",
    "items": "//article/ul/li/text()",
    "cells": "//article/table/tr/td/text()",
    "others": "//article/text()",
    "inside": "//article/div/p/text()",
}


@query(
    "open_path_lists",
    f"""{with_inputs('d_open_page')}
    select page_id, array_to_string(['In ' || lang || ' ', ' from ' || source, 'second',
        case page_id % 3 when 0 then 'end' end], '|') as paragraphs,
      source || '| on|last | item' as items, lang || '|' || n_chars || '|x' as cells,
      case page_id % 3 when 1 then 'end' else '' end as others, case page_id % 3 when 2 then 'end' else '' end as inside
    from d_open_page""",
)
def open_path_lists(spark, sf):
    lists = D.path_lists(derived(spark, sf, "d_open_page"), _OPEN_PATHS)
    return lists.select("page_id", *[F.array_join(c, "|").alias(c) for c in _OPEN_PATHS])
