"""URL columns: parts, canonical form, link resolution, types by ending."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkweft.plans.once import let

# Fixed values of the crawl rules.
SCOPE = "gov.si"
FALLBACK_URL = "http://gov.si/"
MAX_URL_LENGTH = 3000
MAX_IMAGE_NAME = 255
MAX_IMAGE_TYPE = 50
DOCUMENT_TYPES = ("PDF", "DOC", "DOCX", "PPT", "PPTX")

# Schemes whose last path segment may carry `;params` (RFC 1808 practice).
PARAM_SCHEMES = (
    "", "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps",
    "sip", "sips", "mms", "sftp", "tel",
)

_IPV6 = r"\[[0-9A-Fa-f:.]+(?:%[^\]/?#]*)?\]"
# 1 scheme, 2 host, 3 path with params, 4 query
SPLIT = (
    r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?//(?:[^/?#]*@)?"
    rf"({_IPV6}|[^/?#:\[\]]*)(?::[^/?#]*)?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
)
# 1 path, 2 params
PATH = r"(?s)^((?:.*/)?[^/;]*)(?:;([^/]*))?$"


def _clean(url: Column) -> Column:
    return F.translate(F.regexp_replace(url, r"^[\x00-\x20]+", ""), "\t\r\n", "")


def url_parts(url: Column) -> Column:
    """STRUCT<scheme, host, path, params, query> of a URL, read in one match.

    Scheme and host in lower case, the host without port, user info and brackets;
    `params` is the `;` part of the last path segment.  All NULL without a host.
    """
    # newlines are gone after cleaning, so they can stand between the parts
    split = F.split(F.regexp_replace(_clean(url), SPLIT, "$1\n$2\n$3\n$4"), "\n", -1)

    def cut(parts: Column) -> Column:
        scheme = F.lower(F.get(parts, F.lit(0)))
        host = F.translate(F.lower(F.get(parts, F.lit(1))), "[]", "")
        full = F.get(parts, F.lit(2))
        with_params = scheme.isin(*PARAM_SCHEMES) & F.contains(full, F.lit(";"))
        return F.when(
            host != "",
            F.struct(
                scheme.alias("scheme"),
                host.alias("host"),
                F.when(with_params, F.regexp_extract(full, PATH, 1)).otherwise(full).alias("path"),
                F.when(with_params, F.regexp_extract(full, PATH, 2)).otherwise("").alias("params"),
                F.get(parts, F.lit(3)).alias("query"),
            ),
        )

    return let(split, cut)


def fold_scheme(scheme: Column) -> Column:
    return F.when(scheme == "https", F.lit("http")).otherwise(scheme)


def url_scheme(url: Column) -> Column:
    """Scheme in lower case, https taken as http."""
    return fold_scheme(F.lower(F.regexp_extract(_clean(url), SPLIT, 1)))


def url_host(url: Column) -> Column:
    """Host in lower case without port, user info and brackets; NULL if missing."""
    host = F.translate(F.lower(F.regexp_extract(_clean(url), SPLIT, 2)), "[]", "")
    return F.when(host != "", host)


def sort_params(params: Column) -> Column:
    """Lower case, members sorted, each after its own `;`."""
    members = F.array_sort(F.split(F.lower(params), ";", -1))
    return F.when(params == "", F.lit("")).otherwise(
        F.concat(F.lit(";"), F.array_join(members, ";"))
    )


def sort_query(query: Column) -> Column:
    """Lower case, members sorted, with the leading `?`."""
    members = F.array_sort(F.split(F.lower(query), "&", -1))
    return F.when(query == "", F.lit("")).otherwise(
        F.concat(F.lit("?"), F.array_join(members, "&"))
    )


def percent_encode(text: Column, safe: str = ":/?;&=@") -> Column:
    """Percent-encode all but letters, digits, `_.-~` and the `safe` characters."""
    out = F.url_encode(text)
    out = F.replace(out, F.lit("+"), F.lit("%20"))
    out = F.replace(out, F.lit("%7E"), F.lit("~"))
    out = F.replace(out, F.lit("*"), F.lit("%2A"))
    for mark in safe:
        assert mark in string.punctuation
        out = F.replace(out, F.lit(f"%{ord(mark):02X}"), F.lit(mark))
    return out


def percent_decode(text: Column) -> Column:
    """Decode percent escapes; a `%` that starts no escape stays."""
    safe = F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(F.replace(safe, F.lit("+"), F.lit("%2B")))


def canonical_url(url: Column, fallback: str = FALLBACK_URL) -> Column:
    """The form that stands for page identity.

    Scheme and host in lower case, https as http; port, user info and fragment
    dropped; params and query in lower case with sorted members; the whole
    percent-encoded.  A URL without a host gives `fallback`.
    """

    def whole(parts: Column) -> Column:
        return F.concat(
            fold_scheme(parts["scheme"]),
            F.lit("://"),
            parts["host"],
            parts["path"],
            sort_params(parts["params"]),
            sort_query(parts["query"]),
        )

    encoded = percent_encode(let(url_parts(url), whole))
    return F.when(url.isNotNull(), F.coalesce(encoded, F.lit(fallback)))


def in_scope(host: Column, scope: str = SCOPE) -> Column:
    return F.contains(host, F.lit(scope))


def resolve_link(
    link: Column,
    page_host: Column,
    absolute_only: Column | bool = False,
    scope: str = SCOPE,
    fallback: str = FALLBACK_URL,
) -> Column:
    """Canonical URL of a link found on a page, NULL if it is out of scope.

    A link starting with `/` belongs to the host of the page (unless
    `absolute_only`), one starting with `http` stands alone, all others are
    ignored.
    """
    only = F.lit(absolute_only) if isinstance(absolute_only, bool) else absolute_only
    on_host = ~only & F.startswith(link, F.lit("/"))
    target = F.when(on_host, F.concat(F.lit("http://"), page_host, link)).when(
        F.startswith(link, F.lit("http")), link
    )

    def scoped(canonical: Column) -> Column:
        host = F.when(on_host, page_host).otherwise(url_host(canonical))
        return F.when(in_scope(host, scope), canonical)

    return let(canonical_url(target, fallback), scoped)


def url_fits(url: Column, limit: int = MAX_URL_LENGTH) -> Column:
    """Whether a new page may be stored under this URL."""
    return F.length(url) < limit


def ending(text: Column) -> Column:
    """Text after the last dot, the whole text where there is none."""
    return F.substring_index(text, ".", -1)


def file_type(url: Column) -> Column:
    return F.upper(ending(url))


def is_document(url: Column) -> Column:
    return file_type(url).isin(*DOCUMENT_TYPES)


def image_fits(src: Column) -> Column:
    return (F.length(src) <= MAX_IMAGE_NAME) & (F.length(ending(src)) <= MAX_IMAGE_TYPE)


def page_class(url: Column, seen_before: Column) -> Column:
    """BINARY by URL ending, else DUPLICATE if the content is known, else HTML."""
    return (
        F.when(is_document(url), F.lit("BINARY"))
        .when(seen_before, F.lit("DUPLICATE"))
        .otherwise(F.lit("HTML"))
    )
