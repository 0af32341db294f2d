"""HTML columns: tags and tokens of a page as arrays, attributes of a tag.

A page is cut by one regular expression whose possessive groups keep it linear:
comments, declarations and processing instructions; `script` / `style` with their
raw content; tags, where a `>` inside a quoted attribute does not end the tag;
and, for tokens, the text between.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkweft.functions.text import decode_entities
from linkweft.plans.once import let

_SKIP = r"!--(?:.*?--!?>|.*)|![^>]*+>|\?[^>]*+>"
_BODY = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
_RAW = rf"(?:script|style)(?=[\s/>]){_BODY}.*?(?=</(?:script|style)[\s/>]|\z)"
_TAG = rf"/?[a-z]{_BODY}|/?[a-z][^>]*+>"
MARKUP = rf"(?is)<(?:{_SKIP}|{_RAW}|{_TAG})"
TOKENS = rf"(?is)<(?:{_SKIP}|{_RAW}|{_TAG}|(?![a-z/!?]))|[^<]++"

OPENING = r"(?is)^<[a-z]" + _BODY + r"|^<[a-z][^>]*+>"
ATTRIBUTE = r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?"""


def _is_markup(token: Column) -> Column:
    """Whether a token is a tag; a lone `<` is text."""
    return F.startswith(token, F.lit("<")) & (F.length(token) > 1)


def _is_skipped(token: Column) -> Column:
    return F.startswith(token, F.lit("<!")) | F.startswith(token, F.lit("<?"))


def opening_tags(html: Column) -> Column:
    """Source of all start tags in page order, script and style content cut off."""
    found = F.regexp_extract_all(html, F.lit(MARKUP), F.lit(0))
    tags = F.filter(found, lambda t: F.rlike(t, F.lit("^<[A-Za-z]")))
    return F.transform(tags, start_tag)


def start_tag(token: Column) -> Column:
    """The start tag at the head of a token which may carry raw content."""
    may_be = F.startswith(token, F.lit("<s")) | F.startswith(token, F.lit("<S"))
    raw = may_be & F.rlike(token, F.lit(r"(?i)^<(?:script|style)[\s/>]"))
    return F.when(raw, F.regexp_extract(token, OPENING, 0)).otherwise(token)


def tag_name(tag: Column) -> Column:
    return F.lower(F.regexp_extract(tag, r"^</?([A-Za-z][^\s/>]*)", 1))


def closes_itself(tag: Column) -> Column:
    """`<br/>` does, `<a href=x/>` does not: there the slash ends the value."""
    return F.endswith(tag, F.lit("/>")) & ~F.rlike(tag, F.lit(r"""=\s*[^\s"'>]+/>$"""))


def _attribute_text(tag: Column) -> Column:
    return F.regexp_replace(tag, r"""^<[A-Za-z][^\s/>]*|(?<=[\s"'])/?>$|>$""", "")


def _unquote(value: Column) -> Column:
    return F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2")


def raw_attribute(tag: Column, name: str) -> Column:
    """Value of the first attribute of that name as written, NULL if absent."""

    def named(text: Column) -> Column:
        names = F.transform(F.regexp_extract_all(text, F.lit(ATTRIBUTE), F.lit(1)), F.lower)
        values = F.regexp_extract_all(text, F.lit(ATTRIBUTE), F.lit(2))
        return let(
            F.array_position(names, name),
            lambda at: F.when(at > 0, _unquote(F.get(values, (at - 1).cast("int")))),
        )

    # most tags lack the attribute, and a plain search says so at once
    return F.when(F.contains(F.lower(tag), F.lit(name)), let(_attribute_text(tag), named))


def attributes(tag: Column) -> Column:
    """All attributes as a map; the first of a repeated name counts."""

    def pairs(text: Column) -> Column:
        names = F.transform(F.regexp_extract_all(text, F.lit(ATTRIBUTE), F.lit(1)), F.lower)
        values = F.regexp_extract_all(text, F.lit(ATTRIBUTE), F.lit(2))
        return let(names, lambda n: _first_pairs(n, values))

    return let(_attribute_text(tag), pairs)


def _first_pairs(names: Column, values: Column) -> Column:
    """Map of names to decoded values."""
    zipped = F.zip_with(
        names,
        values,
        lambda n, v: F.struct(n.alias("name"), decode_entities(_unquote(v)).alias("value")),
    )
    first = F.filter(zipped, lambda p, i: F.array_position(names, p["name"]) == i + 1)
    return F.map_from_entries(first)


def _token(kind: str, value: Column, source: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"), value.alias("value"), source.alias("source")
    )


def _markup_parts(token: Column, head: Column) -> Column:
    none = F.lit(None).cast("string")
    name = tag_name(token)
    content = F.substr(token, F.length(head) + 1)
    return (
        F.when(
            F.length(token) > F.length(head),
            F.array(_token("stag", name, head), _token("value", content, none)),
        )
        .when(
            closes_itself(token),
            F.array(_token("stag", name, token), _token("etag", name, none)),
        )
        .otherwise(F.array(_token("stag", name, token)))
    )


def token_parts(token: Column) -> Column:
    """The tokens, one or two, of a piece of a page as an array."""
    text = F.array(_token("value", decode_entities(token), F.lit(None).cast("string")))
    markup = let(start_tag(token), lambda head: _markup_parts(token, head))
    end = F.array(_token("etag", tag_name(token), F.lit(None).cast("string")))
    # end tags are told apart first, as they need nothing else
    return F.when(F.startswith(token, F.lit("</")), end).when(_is_markup(token), markup).otherwise(text)


def pieces(html: Column) -> Column:
    """Source of the tags and texts of a page in order."""
    found = F.regexp_extract_all(html, F.lit(TOKENS), F.lit(0))
    return F.filter(found, lambda t: ~_is_skipped(t))


def tokens(html: Column) -> Column:
    """ARRAY<STRUCT<kind, value, source>> of stag / etag / value in page order.

    `value` is the tag name or the decoded text, `source` the start tag as
    written.  A self-closing tag counts as start and end; script and style
    content is one text token, not decoded.
    """
    return F.flatten(F.transform(pieces(html), token_parts))


def bare_tokens(html: Column) -> Column:
    """Tokens without the tag source: ARRAY<STRUCT<kind, value>>."""
    return F.transform(
        tokens(html), lambda t: F.struct(t["kind"].alias("kind"), t["value"].alias("value"))
    )
