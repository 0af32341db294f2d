"""Queries over URL and text columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkweft.functions import text as T
from linkweft.functions import url as U
from linkweft.operators.lookups import hash_exists
from linkweft.queries import checksql as S
from linkweft.queries.inputs import derived, table, with_inputs
from linkweft.queries.registry import query

SCOPE = "example."


@query("content_hash", "select doc_id, sha256(text) as hash_code from documents")
def content_hash(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", T.content_hash(F.col("text")).alias("hash_code")
    )


def _urls(expression: str) -> str:
    return f"{with_inputs('d_url')} select page_id, variant, {expression} from d_url"


@query("canonical_url", _urls(f"{S.canonical('url')} as canonical"))
def canonical_url(spark, sf):
    return derived(spark, sf, "d_url").select(
        "page_id", "variant", U.canonical_url(F.col("url")).alias("canonical")
    )


@query(
    "url_parts",
    _urls(
        ", ".join(
            f"case when {S.host('url')} is not null then {text} end as {name}"
            for name, text in (
                ("scheme", f"lower({S.part('url', 1)})"),
                ("host", S.host("url")),
                ("path", S.path("url")),
                ("params", S.params("url")),
                ("query", S.query("url")),
            )
        )
    ),
)
def url_parts(spark, sf):
    return derived(spark, sf, "d_url").select(
        "page_id", "variant", U.url_parts(F.col("url")).alias("p")
    ).select("page_id", "variant", "p.*")


@query("url_scheme_fold", _urls(f"{S.scheme('url')} as scheme"))
def url_scheme_fold(spark, sf):
    return derived(spark, sf, "d_url").select(
        "page_id", "variant", U.url_scheme(F.col("url")).alias("scheme")
    )


@query("url_host", _urls(f"{S.host('url')} as host"))
def url_host(spark, sf):
    return derived(spark, sf, "d_url").select(
        "page_id", "variant", U.url_host(F.col("url")).alias("host")
    )


@query("url_params_sort", _urls(f"case when {S.host('url')} is not null then {S.sort_params(S.params('url'))} end as params"))
def url_params_sort(spark, sf):
    return derived(spark, sf, "d_url").select(
        "page_id", "variant", U.sort_params(U.url_parts(F.col("url"))["params"]).alias("params")
    )


@query("url_query_sort", _urls(f"case when {S.host('url')} is not null then {S.sort_query(S.query('url'))} end as query"))
def url_query_sort(spark, sf):
    return derived(spark, sf, "d_url").select(
        "page_id", "variant", U.sort_query(U.url_parts(F.col("url"))["query"]).alias("query")
    )


@query(
    "url_quote",
    f"select doc_id, {S.quote('text')} as quoted from documents",
)
def url_quote(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", U.percent_encode(F.col("text")).alias("quoted")
    )


@query(
    "url_fallback",
    f"{with_inputs('d_url')} select variant, {S.canonical('url', 'http://none.example/')} as url, "
    f"count(*) as pages from d_url where {S.host('url')} is null group by all",
)
def url_fallback(spark, sf):
    canonical = U.canonical_url(F.col("url"), fallback="http://none.example/")
    urls = derived(spark, sf, "d_url").where(U.url_host(F.col("url")).isNull())
    return urls.groupBy("variant", canonical.alias("url")).agg(F.count(F.lit(1)).alias("pages"))


@query(
    "resolve_link",
    f"{with_inputs('d_href')} select page_id, variant, "
    f"{S.resolve('link', 'page_host', 'absolute_only', SCOPE)} as url from d_href",
)
def resolve_link(spark, sf):
    url = U.resolve_link(F.col("link"), F.col("page_host"), F.col("absolute_only"), SCOPE)
    return derived(spark, sf, "d_href").select("page_id", "variant", url.alias("url"))


@query(
    "in_scope",
    f"{with_inputs('d_url')} select page_id, variant from d_url "
    f"where contains({S.host('url')}, 'example.org')",
)
def in_scope(spark, sf):
    kept = U.in_scope(U.url_host(F.col("url")), "example.org")
    return derived(spark, sf, "d_url").where(kept).select("page_id", "variant")


@query(
    "url_length_guard",
    f"{with_inputs('d_found')} select url, count(*) as links from d_found "
    "where length(url) < 3000 group by url",
)
def url_length_guard(spark, sf):
    kept = derived(spark, sf, "d_found").where(U.url_fits(F.col("url")))
    return kept.groupBy("url").agg(F.count(F.lit(1)).alias("links"))


@query(
    "file_type",
    f"{with_inputs('d_page')} select id, upper(split_part(url, '.', -1)) as file_type, "
    "upper(split_part(url, '.', -1)) in ('PDF', 'DOC', 'DOCX', 'PPT', 'PPTX') as is_document from d_page",
)
def file_type(spark, sf):
    url = F.col("url")
    return derived(spark, sf, "d_page").select(
        "id", U.file_type(url).alias("file_type"), U.is_document(url).alias("is_document")
    )


@query(
    "page_class",
    f"""{with_inputs('d_doc')}, hashed as (select id, url, sha256(html) as h from d_doc)
    select id, case when url like '%.pdf' then 'BINARY'
      when id > min(id) over (partition by h) then 'DUPLICATE' else 'HTML' end as page_class
    from hashed""",
)
def page_class(spark, sf):
    docs = derived(spark, sf, "d_doc").withColumn("hash_code", T.content_hash(F.col("html")))
    seen = hash_exists(docs).select("id", "seen_before")
    kind = U.page_class(F.col("url"), F.col("seen_before"))
    return docs.select("id", "url").join(seen, "id").select("id", kind.alias("page_class"))


@query(
    "image_type",
    f"{with_inputs('d_image')} select id, split_part(filename, '.', -1) as image_type from d_image",
)
def image_type(spark, sf):
    return derived(spark, sf, "d_image").select(
        "id", U.ending(F.col("filename")).alias("image_type")
    )


@query(
    "image_filter",
    f"{with_inputs('d_image')} select id, filename from d_image where length(filename) <= 255 "
    "and length(split_part(filename, '.', -1)) <= 50",
)
def image_filter(spark, sf):
    return derived(spark, sf, "d_image").where(U.image_fits(F.col("filename"))).select(
        "id", "filename"
    )


@query(
    "split_saving",
    f"{with_inputs('d_product')} select page_id, record_no, saving, percent as saving_percent from d_product",
)
def split_saving(spark, sf):
    both = derived(spark, sf, "d_product").withColumn("both", F.concat_ws(" ", "saving", "percent"))
    saving, percent = T.split_saving(F.col("both"))
    return both.select(
        "page_id", "record_no", saving.alias("saving"), percent.alias("saving_percent")
    )


@query(
    "strip_fields",
    """select doc_id, trim(text, ' ' || chr(9) || chr(10) || chr(13)) as stripped,
      lang || ' ' || source as before_break, source as second_word, replace(text, chr(10), ' ') as one_line
    from documents""",
)
def strip_fields(spark, sf):
    padded = F.concat(F.lit("\n \t"), "text", F.lit(" \n"))
    words = F.concat(F.lit(" \n"), "lang", F.lit(" "), "source")
    return table(spark, sf, "documents").select(
        "doc_id",
        T.strip(padded).alias("stripped"),
        T.before_break(F.concat(words, F.lit("\n\tx\n\ty "))).alias("before_break"),
        T.second_word(F.concat(words, F.lit(" z"))).alias("second_word"),
        T.one_line(F.col("text")).alias("one_line"),
    )


@query(
    "join_paragraphs",
    """select page_id, coalesce(array_to_string(regexp_extract_all(html, '<p>([^<]*)</p>', 1), chr(10))
      || case when regexp_matches(html, '<p>[^<]*</p>') then chr(10) else '' end, '') as content
    from pages""",
)
def join_paragraphs(spark, sf):
    paragraphs = F.regexp_extract_all("html", F.lit("<p>([^<]*)</p>"), F.lit(1))
    return table(spark, sf, "pages").select(
        "page_id", T.join_paragraphs(paragraphs).alias("content")
    )
