"""Pieces of check SQL (DuckDB dialect): URL rules, tags, attributes, robots."""

from __future__ import annotations

from linkweft.operators.tree import ENDED_BY

SPLIT = (
    r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?//(?:[^/?#]*@)?"
    r"(\[[0-9A-Fa-f:.]+\]|[^/?#:\[\]]*)(?::[^/?#]*)?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
)
PATH = r"(?s)^((?:.*/)?[^/;]*)(?:;([^/]*))?$"
PARAM_SCHEMES = (
    "('', 'ftp', 'hdl', 'prospero', 'http', 'https', 'shttp', 'rtsp', 'rtsps', 'sip', 'sips', "
    "'mms', 'sftp', 'tel')"
)


def trimmed(url: str) -> str:
    return f"ltrim({url})"


def part(url: str, group: int) -> str:
    return f"regexp_extract({trimmed(url)}, '{SPLIT}', {group})"


def scheme(url: str) -> str:
    low = f"lower({part(url, 1)})"
    return f"(case when {low} = 'https' then 'http' else {low} end)"


def host(url: str) -> str:
    return f"nullif(lower({part(url, 2)}), '')"


def has_params(url: str) -> str:
    return f"(lower({part(url, 1)}) in {PARAM_SCHEMES})"


def path(url: str) -> str:
    full = part(url, 3)
    return (
        f"(case when {has_params(url)} then regexp_extract({full}, '{PATH}', 1) else {full} end)"
    )


def params(url: str) -> str:
    return (
        f"(case when {has_params(url)} then regexp_extract({part(url, 3)}, '{PATH}', 2) else '' end)"
    )


def query(url: str) -> str:
    return part(url, 4)


def sort_params(text: str) -> str:
    return (
        f"(case when {text} = '' then '' else ';' || array_to_string("
        f"list_sort(string_split(lower({text}), ';')), ';') end)"
    )


def sort_query(text: str) -> str:
    return (
        f"(case when {text} = '' then '' else '?' || array_to_string("
        f"list_sort(string_split(lower({text}), '&')), '&') end)"
    )


def quote(text: str, safe: str = ":/?;&=@") -> str:
    out = f"url_encode({text})"
    for mark in safe:
        out = f"replace({out}, '%{ord(mark):02X}', '{mark}')"
    return out


def canonical(url: str, fallback: str = "http://gov.si/") -> str:
    whole = (
        f"{scheme(url)} || '://' || {host(url)} || {path(url)} || {sort_params(params(url))}"
        f" || {sort_query(query(url))}"
    )
    return f"(case when {url} is null then null else coalesce({quote(whole)}, '{fallback}') end)"


def resolve(link: str, page_host: str, only: str, scope: str) -> str:
    inside = canonical(f"('http://' || {page_host} || {link})")
    outside = canonical(link)
    return f"""(case
      when not {only} and starts_with({link}, '/') then
        case when contains({page_host}, '{scope}') then {inside} end
      when starts_with({link}, 'http') then
        case when contains({host(outside)}, '{scope}') then {outside} end end)"""


# --- tags and tokens -------------------------------------------------------------
_BODY = "(?:[^>\"'']|\"[^\"]*\"|''[^'']*'')*>"
RAW_ELEMENT = r"<script(?:\s[^>]*)?>.*?</script\s*>|<style(?:\s[^>]*)?>.*?</style\s*>"
MARKUP = rf"(?is)<!--.*?-->|<![^>]*>|{RAW_ELEMENT}|</?[a-z]{_BODY}"
TOKENS = rf"{MARKUP}|[^<]+|<"
RAW_PARTS = r"(?is)^(<(?:script|style)(?:\s[^>]*)?>)(.*)</(?:script|style)\s*>$"
ATTRIBUTE = r"""([^\s"''<>/=]+)(?:\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>][^\s>]*))?"""


def decode(text: str) -> str:
    """The references which occur in the given pages."""
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("middot", "·"), ("copy", "©"), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{char}')"
    return text


def attribute(tag: str, name: str) -> str:
    body = f"regexp_replace({tag}, '^<[A-Za-z][^\\s/>]*', '')"
    names = f"list_transform(regexp_extract_all({body}, '{ATTRIBUTE}', 1), lambda x: lower(x))"
    values = f"regexp_extract_all({body}, '{ATTRIBUTE}', 2)"
    value = f"{values}[list_position({names}, '{name}')]"
    bare = f"regexp_replace({value}, '^[\"'']|[\"'']$', '', 'g')"
    return f"(case when list_contains({names}, '{name}') then {decode(bare)} end)"


def attributes(tag: str) -> str:
    """All attributes of a start tag as `name=value`, sorted; of a name given twice the first."""
    body = f"regexp_replace({tag}, '^<[A-Za-z][^\\s/>]*', '')"
    names = f"list_transform(regexp_extract_all({body}, '{ATTRIBUTE}', 1), lambda x: lower(x))"
    values = f"regexp_extract_all({body}, '{ATTRIBUTE}', 2)"
    bare = f"regexp_replace({values}[i], '^[\"'']|[\"'']$', '', 'g')"
    pairs = f"""list_transform(list_filter(generate_series(1, len({names})),
      lambda i: list_position({names}, {names}[i]) = i), lambda i: {names}[i] || '=' || {decode(bare)})"""
    return f"array_to_string(list_sort({pairs}), '|')"


def tags(source: str) -> str:
    """CTE body: (page_id, url, pos, tag, name) of the start tags in `source`."""
    return f"""
    select page_id, url, pos, tag, lower(regexp_extract(tag, '^<([A-Za-z][^\\s/>]*)', 1)) as name
    from (
      select page_id, url, unnest(found) as tag, unnest(generate_series(1, len(found))) as pos
      from (
        select page_id, url, list_filter(regexp_extract_all(html, '{MARKUP}'),
          lambda x: regexp_matches(x, '(?i)^<[a-z]') and not regexp_matches(x, '(?i)^<(script|style)')) as found
        from {source}))"""


def tokens(source: str, key: str = "page_id", html: str = "html") -> str:
    """CTE body: (key, pos, kind, value) of the tokens, pos from 0."""
    raw = f"regexp_matches(t, '{RAW_PARTS}')"
    name = "lower(regexp_extract(t, '^</?([A-Za-z][^\\s/>]*)', 1))"
    content = f"regexp_extract(t, '{RAW_PARTS}', 2)"
    open_tag = f"{{'kind': 'stag', 'value': {name}, 'source': t}}"
    open_raw = f"{{'kind': 'stag', 'value': {name}, 'source': regexp_extract(t, '{RAW_PARTS}', 1)}}"
    close = f"{{'kind': 'etag', 'value': {name}, 'source': ''}}"
    return f"""
    select {key}, pos - 1 as pos, item.kind as kind, item.value as value, item.source as source
    from (
      select {key}, unnest(items) as item, unnest(generate_series(1, len(items))) as pos
      from (
        select {key}, flatten(list_transform(
          list_filter(regexp_extract_all({html}, '{TOKENS}'), lambda x: not starts_with(x, '<!')),
          lambda t: case
            when {raw} and {content} = '' then [{open_raw}, {close}]
            when {raw} then [{open_raw}, {{'kind': 'value', 'value': {content}, 'source': ''}}, {close}]
            when starts_with(t, '</') then [{close}]
            when regexp_matches(t, '^<[A-Za-z]') and ends_with(t, '/>') then
              [{open_tag}, {close}]
            when regexp_matches(t, '^<[A-Za-z]') then [{open_tag}]
            else [{{'kind': 'value', 'value': {decode('t')}, 'source': ''}}] end)) as items
        from {source}))"""


LINKS = f"""
    select page_id, url, 'onclick' as kind, 1 as rank, pos, link from (
      select page_id, url, pos, regexp_extract({attribute('tag', 'onclick')}, '^[^'']*''([^'']*)''', 1) as link
      from tags where {attribute('tag', 'onclick')} like '%location.href%''%''%'
        or {attribute('tag', 'onclick')} like '%document.location%''%''%')
    union all
    select page_id, url, name, case name when 'area' then 2 when 'link' then 3 else 4 end, pos,
      {attribute('tag', 'href')} as link
    from tags where name in ('a', 'area', 'link') and {attribute('tag', 'href')} is not null"""


def _quoted(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


def _ended_by(tag: str, ender: str) -> str:
    cases = [f"{tag} in ({_quoted(group)}) and {ender} in ({_quoted(ends)})" for group, ends in ENDED_BY.items()]
    return f"({' or '.join(cases)})"


def nodes(source: str = "pages", html: str = "html") -> str:
    """CTEs ending in `nodes`: (page_id, node_id, parent_id, kind, tag, text, source, nests,
    level, nth, path, own_path, after_tag); `path` of a text is that of its element."""
    return f"""
    toks as ({tokens(source, "page_id", html)}),
    balanced as (
      select *, sum(case kind when 'stag' then 1 else -1 end)
        over (partition by page_id, value order by pos) as balance
      from toks where kind <> 'value'),
    paired as (
      select page_id, pos, value not in ('html', 'head', 'body') and case kind
        when 'stag' then min(balance) over (partition by page_id, value order by pos
          rows between current row and unbounded following) < balance
        else balance >= least(0, coalesce(min(balance) over (partition by page_id, value order by pos
          rows between unbounded preceding and 1 preceding), 0)) end as nests
      from balanced),
    flagged as (
      select t.*, coalesce(c.nests, false) as nests
      from toks t left join paired c on c.page_id = t.page_id and c.pos = t.pos),
    heights as (
      select *, cast(sum(case when not nests then 0 when kind = 'stag' then 1 else -1 end)
        over (partition by page_id order by pos) as int) as height from flagged),
    beside as (
      select *, case when kind = 'stag' then height - cast(nests as int) when kind = 'etag' and nests then height + 1
        when kind = 'etag' and value in ('html', 'head', 'body') then height end as at from heights),
    implied as (
      select x.page_id, x.pos, x.value, min(e.pos) as end_pos
      from beside x left join beside e on e.page_id = x.page_id and e.at = x.at and e.pos > x.pos
        and (e.kind = 'etag' or {_ended_by("x.value", "e.value")})
      where x.kind = 'stag' and not x.nests and x.value in ({_quoted(t for g in ENDED_BY for t in g)}) group by all),
    evented as (
      select t.page_id, t.pos, 1 as after, t.kind, t.value, t.source, t.nests or i.pos is not null as nests
      from flagged t left join implied i on i.page_id = t.page_id and i.pos = t.pos
      union all select page_id, end_pos, 0, 'etag', value, '', true from implied where end_pos is not null),
    levelled as (
      select *, cast(sum(case when not nests then 0 when kind = 'stag' then 1 else -1 end)
          over (partition by page_id order by pos, after) as int) as level,
        lag(case when kind = 'stag' and not nests and value not in ('html', 'head', 'body', 'area', 'base',
          'br', 'col', 'embed', 'hr', 'img', 'input', 'link', 'meta', 'source', 'track', 'wbr') then value end)
          over (partition by page_id order by pos, after) as before
      from evented),
    plain as (
      select page_id, pos as node_id, case kind when 'stag' then 'element' else 'text' end as kind,
        case kind when 'stag' then value end as tag, case kind when 'value' then value end as text,
        source, nests, level, case kind when 'value' then before end as after_tag,
        level - cast(nests as int) as ask
      from levelled where kind <> 'etag'),
    hung as (
      select n.*, p.node_id as parent_id
      from plain n asof left join (select page_id, node_id, level from plain where nests) p
        on p.page_id = n.page_id and p.level = n.ask and n.node_id > p.node_id),
    placed as (
      select *, row_number() over (partition by page_id, parent_id, tag order by node_id) as nth from hung),
    recursive_paths as (
      with recursive walk(page_id, node_id, path) as (
        select page_id, node_id, '/' || tag || '[' || nth || ']' from placed
        where parent_id is null and nests
        union all
        select c.page_id, c.node_id, w.path || '/' || c.tag || '[' || c.nth || ']'
        from walk w join placed c on c.page_id = w.page_id and c.parent_id = w.node_id and c.nests)
      select * from walk),
    nodes as (
      select c.*, case when c.nests then o.path else coalesce(u.path, '') end as path
      from placed c left join recursive_paths o on o.page_id = c.page_id and o.node_id = c.node_id and c.nests
      left join recursive_paths u on u.page_id = c.page_id and u.node_id = c.parent_id)"""


def groups(source: str) -> str:
    """CTEs ending in `counted`: one row per (grp, path) as in `group_paths`."""
    return rf"""{nodes(source)},
    keyed as (
      select g.host as grp, n.*, case when nests then '' else '/' || coalesce(tag, '#text') end as own
      from nodes n join {source} g on g.page_id = n.page_id),
    paths as (
      select grp, regexp_replace(path, '\[\d+\]', '', 'g') || own as path, min(kind) as kind,
        count(*) as nodes, count(*) filter (nth = 1) as parents_with, cast(max(nth) as int) as most,
        min(node_id) as first_pos, min(text) as low_text, max(text) as high_text
      from keyed group by all),
    counted as (
      select p.*, coalesce(u.nodes, case when regexp_replace(p.path, '/[^/]*$', '') = '' then g.pages end) as parents
      from paths p
      left join paths u on u.grp = p.grp and u.kind = 'element' and u.path = regexp_replace(p.path, '/[^/]*$', '')
      left join (select host, count(*) as pages from {source} group by host) g on g.host = p.grp)"""


# --- robots ----------------------------------------------------------------------
def robots(source: str = "d_site") -> str:
    """CTEs ending in `rows`: lines (id, domain, no, key, value) of the group for `*`."""
    return f"""
    lines as (
      select id, domain, no, lower(trim(string_split(body, ':')[1])) as key,
        trim(substr(body, instr(body, ':') + 1)) as value
      from (
        select id, domain, unnest(generate_series(1, len(string_split(robots_content, chr(10))))) as no,
          trim(regexp_replace(unnest(string_split(robots_content, chr(10))), '#.*$', '')) as body
        from {source})
      where contains(body, ':')),
    kept as (
      select * from lines where key in ('user-agent', 'disallow', 'allow', 'crawl-delay', 'request-rate')),
    starts as (
      select *, case when key = 'user-agent'
        and coalesce(lag(key) over (partition by id order by no), '') <> 'user-agent' then 1 else 0 end as s
      from kept),
    grouped as (select *, sum(s) over (partition by id order by no) as g from starts),
    groups as (
      select id, g, bool_or(key = 'user-agent' and value = '') as nameless,
        bool_or(key = 'user-agent' and value = '*') as general
      from grouped where g > 0 group by id, g having bool_or(key <> 'user-agent')),
    chosen as (
      select id, coalesce(min(case when nameless and not general then g end),
        min(case when general then g end)) as g
      from groups group by id),
    rows as (select r.* from grouped r join chosen c on c.id = r.id and c.g = r.g),
    rules as (
      select id, domain, row_number() over (partition by id order by no) as rule_no,
        key = 'allow' or value = '' as allow, {quote('url_decode(value)', '/')} as prefix
      from rows where key in ('allow', 'disallow')),
    delays as (
      select s.id, s.domain, coalesce(max_by(cast(r.value as int), r.no), 5) as delay
      from {source} s
      left join rows r on r.id = s.id and r.key = 'crawl-delay' and regexp_matches(r.value, '^[0-9]+$')
      group by s.id, s.domain)"""


def robots_path(url: str) -> str:
    bare = f"regexp_replace(url_decode({url}), '(?s)^(?:(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//[^/?#]*)', '')"
    return f"(case when {bare} = '' then '/' else {quote(bare, '/')} end)"
