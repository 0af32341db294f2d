"""Robots policy of one robots text, as columns of that row.

Everything below is a chain of array functions over the lines of one text, so a
site's policy needs no explode and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkweft.functions.url import percent_decode, percent_encode
from linkweft.plans.once import let

# Fixed values of the crawl rules.
DEFAULT_DELAY = 5
VALID_MARK = "User-agent"
VALID_WITHIN = 300
GROUP_KEYS = ("user-agent", "disallow", "allow", "crawl-delay", "request-rate")


def robots_valid(text: Column) -> Column:
    """Whether a fetched text is robots rules and not some other page."""
    return F.contains(F.substring(text, 1, VALID_WITHIN), F.lit(VALID_MARK))


def robots_lines(text: Column) -> Column:
    """ARRAY<STRUCT<no, key, value>> of the `key: value` lines, comments cut."""

    def parse(line: Column, at: Column) -> Column:
        body = F.trim(F.regexp_replace(line, r"(?U)#.*$|\s", " "))
        key, value = F.split(body, ":", 2)[0], F.get(F.split(body, ":", 2), F.lit(1))
        return F.struct(
            (at + 1).alias("no"),
            F.lower(F.trim(key)).alias("key"),
            percent_decode(F.trim(value)).alias("value"),
        )

    parsed = F.transform(F.split(text, "\n", -1), parse)
    return F.filter(parsed, lambda r: r["value"].isNotNull())


def _starts(rows: Column) -> Column:
    """Indexes of the agent lines which follow no other agent line."""
    is_agent = F.transform(rows, lambda r: r["key"] == "user-agent")
    follows = F.concat(F.array(F.lit(False)), F.slice(is_agent, F.lit(1), F.size(rows) - 1))
    marked = F.zip_with(is_agent, follows, lambda now, before: now & ~before)
    places = F.transform(marked, lambda first, i: F.when(first, i))
    return F.when(F.size(rows) > 0, F.filter(places, lambda p: p.isNotNull()))


def _slices(rows: Column, starts: Column) -> Column:
    """Cut `rows` into one array per start index."""

    def cut(start: Column, at: Column) -> Column:
        end = F.coalesce(F.get(starts, at + 1), F.size(rows))
        return F.slice(rows, start + 1, end - start)

    return F.transform(starts, cut)


def _has_agent(group: Column, agent: str) -> Column:
    return F.exists(group, lambda r: (r["key"] == "user-agent") & (r["value"] == agent))


def robots_group(text: Column) -> Column:
    """Lines of the group which applies to agent `*`, NULL if there is none.

    A group starts at an agent line which follows no other agent line and holds
    at least one rule line.  The first group with an empty agent comes before
    the first one with `*`.
    """
    lines = F.filter(robots_lines(text), lambda r: r["key"].isin(*GROUP_KEYS))
    cut = let(lines, lambda rows: let(_starts(rows), lambda starts: _slices(rows, starts)))

    def choose(slices: Column) -> Column:
        nameless = F.filter(slices, lambda g: _has_agent(g, "") & ~_has_agent(g, "*"))
        general = F.filter(slices, lambda g: _has_agent(g, "*"))
        return F.coalesce(F.get(nameless, F.lit(0)), F.get(general, F.lit(0)))

    groups = F.filter(cut, lambda g: F.exists(g, lambda r: r["key"] != "user-agent"))
    return let(groups, choose)


def robots_rules(text: Column) -> Column:
    """ARRAY<STRUCT<rule_no, allow, prefix>> in file order, empty if there is none."""
    lines = F.filter(robots_group(text), lambda r: r["key"].isin("allow", "disallow"))
    rules = F.transform(
        lines,
        lambda r, i: F.struct(
            (i + 1).alias("rule_no"),
            ((r["key"] == "allow") | (r["value"] == "")).alias("allow"),
            percent_encode(r["value"], safe="/").alias("prefix"),
        ),
    )
    return F.coalesce(
        rules, F.array().cast("array<struct<rule_no:int,allow:boolean,prefix:string>>")
    )


def robots_delay(text: Column, default: int = DEFAULT_DELAY) -> Column:
    """Seconds between fetches: the last whole-number crawl delay of the group."""
    delays = F.filter(
        robots_group(text),
        lambda r: (r["key"] == "crawl-delay") & F.rlike(r["value"], F.lit("^[0-9]+$")),
    )
    last = F.try_element_at(delays, F.lit(-1))["value"]
    return F.coalesce(last.try_cast("int"), F.lit(default))


def robots_sitemaps(text: Column) -> Column:
    """Sitemap URLs in file order."""
    lines = F.filter(robots_lines(text), lambda r: r["key"] == "sitemap")
    return F.transform(lines, lambda r: r["value"])


def robots_path(url: Column) -> Column:
    """The part of a URL which rule prefixes are compared with."""
    path = F.regexp_replace(
        percent_decode(url), r"(?s)^(?:(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*)", ""
    )
    path = F.regexp_replace(path, r"#$|\?(?=#|$)", "")
    return F.when(path == "", F.lit("/")).otherwise(percent_encode(path, safe="/"))


def allowed_by(rules: Column, url: Column) -> Column:
    """Decision of the first rule whose prefix fits; allowed if none does."""
    return let(
        robots_path(url),
        lambda path: F.coalesce(
            F.get(F.filter(rules, lambda r: F.startswith(path, r["prefix"])), F.lit(0))["allow"],
            F.lit(True),
        ),
    )
