"""Operators on small inputs with known results."""

import re

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkweft.operators import changes, dom, lookups, pages, records, robots, summaries, template
from linkweft.plans import skew


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def keyed(spark):
    """1000 rows: a third share one key, a third have none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    return spark.range(1000).select("id", key.alias("k"))


def test_skew_lookup_equals_a_join(spark):
    left = keyed(spark)
    right = spark.createDataFrame([("hot", 1), ("4", 2), ("zz", 3)], "k string, v int")
    found = skew.skew_lookup(left, right, "k", ["id"], hot_rows=20).select("id", "k", "v")
    assert rows(found) == rows(left.join(right, "k", "left").select("id", "k", "v"))


def test_skew_lookup_spreads_the_hot_key(spark):
    left = keyed(spark)
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    plan = skew.skew_lookup(left, right, "k", ["id"], hot_rows=20)
    salted = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in salted
    assert plan.where("_matched").count() == 334


def test_number_rows_equals_row_number(spark):
    left = keyed(spark)
    expected = left.withColumn(
        "row_no", F.row_number().over(Window.partitionBy("k").orderBy("id")).cast("long")
    )
    numbered = skew.number_rows(left, "id", within=["k"], parts=7)
    assert rows(numbered.select(expected.columns)) == rows(expected)
    whole = skew.number_rows(left, "id", base=10, parts=5).agg(F.min("row_no"), F.max("row_no"))
    assert rows(whole) == [(11, 1010)]


def brute_tree(tokens):
    """(seq path) of nested elements by a stack, for pages whose tags all pair up."""
    stack, counts, out = [], [{}], []
    for kind, value in tokens:
        if kind == "stag":
            counts[-1][value] = counts[-1].get(value, 0) + 1
            stack.append(f"/{value}[{counts[-1][value]}]")
            counts.append({})
            out.append("".join(stack))
        elif kind == "etag":
            stack.pop()
            counts.pop()
        else:
            out.append("".join(stack))
    return out


def test_dom_paths_of_deep_and_wide_pages(spark):
    deep = "<div>" * 150 + "x" + "</div>" * 150 + "<div><s>y</s><s>z</s></div>"
    wide = "<ul>" + "<li>a<i>b</i></li>" * 40 + "</ul>"
    data = spark.createDataFrame([(1, deep), (2, wide)], "page_id long, html string")
    from tests.test_columns import library_tokens

    for page_id, text in ((1, deep), (2, wide)):
        found = dom.dom_nodes(data).where(F.col("page_id") == page_id).orderBy("node_id")
        assert [r.path for r in found.collect()] == brute_tree(library_tokens(text))


PAGE = (
    '<html><body><div class="a x"><p>un<p>closed<br>z</div><table><tr><td>1</td><td>2 <b>q</b> w</td>'
    "</tr></table><ul><li>a</li><li>b<i>k</i></li></ul></body></html>"
)


def test_path_select(spark):
    data = spark.createDataFrame([(1, PAGE)], "page_id long, html string")
    expected = {
        "//table/tbody/tr/td[2]/text()": ["2 ", " w"],
        '//div[contains(@class,"x")]/p/text()': ["un", "closed", "z"],
        "//ul/li[2]/i/text()": ["k"],
        # an open paragraph goes on behind a line break
        '//div[@class="a x"]/text()': [],
        "//table//b/text()": ["q"],
        "/html/body/ul/li/text()": ["a", "b"],
    }
    for path, texts in expected.items():
        found = dom.path_select(data, path).orderBy("match_no").collect()
        assert [r.text for r in found] == texts, path
    tags = dom.path_select(data, "//ul/li").collect()
    assert [r.tag for r in tags] == ["li", "li"]


def test_pair_template_steps(spark):
    pair = [(1, "<ul><li>a</li></ul>", "<ul><li>b</li><li>c</li></ul>"), (2, "<b>x</b>", "<i>x</i>")]
    data = spark.createDataFrame(pair, "pair_id long, left_html string, right_html string")
    assert rows(template.pair_fields(data)) == [(1, 2)]
    assert rows(template.first_tag_mismatch(data)) == [(1, 4), (2, 0)]
    assert rows(template.square_candidates(data)) == [(1, 4, "etag:li", -1, 6), (2, 0, None, -1, -1)]
    assert rows(template.square_match(data)) == [(1, 4, False, True), (2, 0, False, False)]


def test_group_template(spark):
    data = spark.createDataFrame(
        [
            (1, "h", "<ul><li>a</li></ul>"),
            (2, "h", "<ul><li>b</li><li>c<s>k</s></li></ul>"),
        ],
        "page_id long, host string, html string",
    )
    lines = template.template_lines(template.page_template(data, "host")).orderBy("line_no").collect()
    assert [r.line for r in lines] == [
        "<ul>", "  ( <li>", "    #PCDATA", "    ( <s>", "      k", "    </s> )?", "  </li> )+", "</ul>",
    ]


def _lines(spark, *pages):
    data = spark.createDataFrame([(k, "h", page) for k, page in enumerate(pages)], "page_id long, host string, html string")
    lines = template.template_lines(template.page_template(data, "host")).orderBy("line_no").collect()
    runs = template.template_runs(data, "host").orderBy("path", "unit").collect()
    return [r.line.strip() for r in lines], [tuple(r)[1:] for r in runs]


def test_siblings_that_repeat_together(spark):
    lines, runs = _lines(spark, "<dl><dt>a</dt><dd>b</dd><dt>c</dt><dd>d</dd></dl>")
    assert runs == [("/dl", "dt dd", 1, 2)]
    assert lines == ["<dl>", "( <dt>", "#PCDATA", "</dt>", "<dd>", "#PCDATA", "</dd> )+", "</dl>"]
    # equal neighbours inside, a hr before on one page, one unit only on another
    lines, runs = _lines(
        spark,
        "<dl><hr><dt>a</dt><dd>b</dd><dd>e</dd><dt>c</dt><dd>d</dd><dt>g<i>x</i></dt><dd>h</dd></dl>",
        "<dl><dt>a</dt><dd>b</dd></dl>",
    )
    assert runs == [("/dl", "dt dd", 1, 3)]
    assert lines == [
        "<dl>", "( <dt>", "#PCDATA", "( <i>", "x", "</i> )?", "</dt>", "( <dd>", "#PCDATA", "</dd> )+ )+",
        "( <hr> )?", "</dl>",
    ]
    # half a unit behind the run, and tags in two units: marks of their own
    lines, runs = _lines(spark, "<b>1</b><i>2</i><b>3</b><i>4</i><b>5</b>")
    assert runs == [("", "b i", 1, 2)]
    assert lines == ["( <b>", "#PCDATA", "</b> )+", "( <i>", "#PCDATA", "</i> )+"]
    assert _lines(spark, "<p>a</p><p>b</p><b>c</b><p>d</p>")[1] == []
    assert _lines(spark, "", "plain")[1] == []


def test_template_is_in_tree_order(spark):
    data = spark.createDataFrame(
        [(1, "h", "<div><a>x</a></div><p>y</p>"), (2, "h", "<p>z</p>")],
        "page_id long, host string, html string",
    )
    steps = template.page_template(data, "host").orderBy("order_key").collect()
    assert [r.path for r in steps] == ["/div", "/div/a", "/div/a/#text", "/p", "/p/#text"]


def test_regex_records(spark):
    data = spark.createDataFrame([(1, "k1=a\n;k2=b;"), (2, "none")], "page_id long, t string")
    found = records.regex_records(data, "t", r"(k\d)=((\w+)\n?);", ["Whole", "Word"])
    assert rows(found) == [(1, 1, "a ", "a"), (1, 2, "b", "b")]
    one = records.regex_records(data, "t", r"(k\d)", ["A", "B"])
    assert rows(one) == [(1, 1, "1", "1"), (1, 2, "2", "2")]
    record = records.regex_record(data, "t", r"k(\d)=", ["A", "B"]).drop("t")
    assert rows(record) == [(1, "1", "1"), (2, None, None)]


def test_unicode_patterns(spark):
    data = spark.createDataFrame([(1, "<b>Čas\r x</b>")], "page_id long, t string")
    assert rows(records.regex_record(data, "t", r"<b>(\w+)(.*)</b>", ["A", "B"]).select("A", "B")) == [
        ("Čas", "\r x")
    ]


def test_onclick_links(spark):
    scripts = {
        "location.href='/p'": ["/p"],
        "document.location = '/q'": ["/q"],
        "location.href=&#39;/e&#39;": ["/e"],
        'location.href=/r': [],
        "open('/s')": [],
        "location.href='/t": [],
    }
    for script, expected in scripts.items():
        data = spark.createDataFrame([(1, f'<i onclick="{script}">x</i>')], "page_id long, html string")
        assert [r.link for r in pages.page_onclick_links(data).collect()] == expected, script


def test_duplicates_with_a_hot_hash(spark):
    captures = spark.range(300).select(
        "id", F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("hash_code")
    )
    found = lookups.duplicate_of(captures, hot_rows=10)
    assert rows(found) == sorted([(i, 0) for i in range(3, 300, 3)], key=repr)


def test_robots_join_with_a_hot_host(spark):
    urls = spark.range(90).select(
        "id", F.concat(F.lit("http://hot.si/"), F.when(F.col("id") % 2 == 0, "p").otherwise("q")).alias("url")
    )
    sites = spark.createDataFrame(
        [(1, "hot.si", "User-agent: *\nDisallow: /p\nCrawl-delay: 2"), (2, "hot.si", None)],
        "id long, domain string, robots_content string",
    )
    found = robots.robots_allowed(urls, sites, ["id"], hot_rows=10)
    assert rows(found.groupBy("delay", "allowed").count()) == [(2, False, 45), (2, True, 45)]


def test_schedule_of_a_hot_host(spark):
    frontier = spark.range(50).select(
        "id", F.concat(F.lit("http://h.si/"), "id").alias("url"), F.lit(3).alias("delay")
    )
    found = summaries.fetch_schedule(frontier, parts=7)
    assert rows(found.select("id", "start_at")) == sorted([(i, 3 * i) for i in range(50)], key=repr)


def test_attributes_are_told_by_their_decoded_value(spark):
    html = (
        '<div class="a&#98;"><p>one</p></div><div class="ab"><p>two</p></div><div title="ab"><p>no</p></div>'
        "<div class=ab><p>three</p></div><div><p>no</p></div><div class='b a'><p>no</p></div><b><i>ab</i></b>"
    )
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    lists = dom.path_lists(pages, {"x": '//div[@class="ab"]/p/text()', "y": '//div[contains(@class, "a")][@class="b a"]/p/text()', "z": "//div[5]/p/text()"})
    assert [tuple(r) for r in lists.collect()] == [(1, ["one", "two", "three"], ["no"], ["no"])]


def test_changes_are_idempotent(spark):
    page = spark.createDataFrame([(1, "http://a/")], "id long, url string")
    found = spark.createDataFrame(
        [("http://b/", 1, 0, 1), ("http://b/", 2, 0, 2), ("http://a/", 1, 1, 1), ("http://c/" + "x" * 3000, 1, 2, 1)],
        "url string, seen_at long, tie int, site_id long",
    )
    now = F.lit("2024-01-01").cast("timestamp_ntz")
    new = changes.add_frontier(found, page, now)
    assert rows(new.select("id", "url", "site_id")) == [(2, "http://b/", 1)]
    again = changes.add_frontier(found, page.unionByName(new.select("id", "url")), now)
    assert again.count() == 0
    edges = spark.createDataFrame([(1, 2), (1, 2), (2, None)], "from_page long, to_page long")
    link = changes.add_link(edges, spark.createDataFrame([], "from_page long, to_page long"))
    assert rows(link) == [(1, 2)]
    assert changes.add_link(edges, link).count() == 0


def test_checks_of_keys_take_tasks_by_rows(spark, monkeypatch):
    page = spark.range(1, 90).selectExpr("id", "id % 4 as site_id", "concat('u', id % 80) as url")
    store = {"page": page, "site": spark.createDataFrame([(1,), (2,), (3,), (None,)], "id long")}
    store["page"] = page.unionByName(spark.createDataFrame([(None, None, None)], "id long, site_id long, url string"))
    found = []
    for size in (10, 1_000_000):
        monkeypatch.setattr(skew, "TASK_ROWS", size)
        keys, references = lookups.unique_violations(store), lookups.fk_violations(store)
        found.append((rows(keys), rows(references)))
        tasks = references.rdd.getNumPartitions()
    assert found[0] == found[1] and found[0][1] == [("page.site_id", "0", 22)]
    assert [r[1:] for r in found[0][0]] == [(f"u{k}", 2) for k in range(1, 10)]
    monkeypatch.setattr(skew, "TASK_ROWS", 10)
    assert lookups.fk_violations(store).rdd.getNumPartitions() == 9 > tasks


def test_first_seen_urls_are_combined_by_hashing(spark):
    big, small = (1 << 63) - 1, -(1 << 63)
    found = spark.createDataFrame(
        [("a", big, (1 << 31) - 1, 1), ("a", big, 5, 2), ("b", 7, 0, 3), ("b", 7, -1, 4), ("b", 7, None, 5), ("c", small, -(1 << 31), 6),
         ("c", small, 0, 7), ("d", None, 9, 8), ("d", small, None, 9), ("d", None, None, 10), ("e", -1, 3, 11), ("e", -2, (1 << 31) - 1, 12)],
        "url string, seen_at long, tie int, site_id long",
    )
    page, now = spark.createDataFrame([], "id long, url string"), F.lit("2024-01-01").cast("timestamp_ntz")
    expected = [(1, "d", 10), (2, "c", 6), (3, "e", 12), (4, "b", 5), (5, "a", 2)]
    assert rows(changes.add_frontier(found, page, now).select("id", "url", "site_id")) == expected
    long_ties = found.withColumn("tie", F.col("tie").cast("long"))
    assert rows(changes.add_frontier(long_ties, page, now).select("id", "url", "site_id")) == expected
    first = found.groupBy("url").agg(F.min_by("site_id", changes._discovery(found)))
    assert "SortAggregate" not in first._jdf.queryExecution().executedPlan().toString()


ARTICLE = (
    '<html><body><header class="article-header"><h1>T</h1></header><div class="author"><div class="author-name">A</div>'
    '</div><div class="article-body"><article><p>one</p><p> two</p><p>three</p></article></div></body></html>'
)


def test_unpaired_tags_lose_no_field(spark):
    whole = ("T", "A", ["one", " two", "three"])
    cases = {
        1: ARTICLE,
        2: ARTICLE.replace("</body>", "</div></body>"),
        3: ARTICLE.replace("<p> two</p>", "<p> two"),
        4: ARTICLE.replace("</article>", ""),
        5: ARTICLE.replace("</div></body>", "</body>"),
        6: ARTICLE.replace("<body>", "<body></div></article></p>"),
        7: ARTICLE.replace("<article>", "<article><section>"),
        8: ARTICLE.replace('<div class="article-body">', '<div class="article-body"><div>'),
    }
    paths = {
        "title": "//header/h1/text()",
        "author": '//div[@class="author"]/div/text()',
        "content": "//article//p/text()",
    }
    data = spark.createDataFrame(list(cases.items()), "page_id long, html string")
    found = {r.page_id: (r.title[0], r.author[0], r.content) for r in dom.path_lists(data, paths).collect()}
    assert found == {k: whole for k in cases}
    inside = dom.path_lists(data, {"content": '//div[@class="article-body"]/article/p/text()'}).collect()
    assert {r.page_id for r in inside if r.content == whole[2]} == {1, 2, 3, 4, 5, 6}


def test_elements_end_without_end_tags(spark):
    expected = {
        "<div><p>one <b>two</b> three<p>four</div> x": "div/p one |div/p/b two|div/p  three|div/p four|  x",
        "<ul><li>a<ul><li>b</ul><li>c <p>d<li>e</ul>f": "ul/li a|ul/li/ul/li b|ul/li c |ul/li/p d|ul/li e| f",
        "<table><tr><td>1<td>2<p>z<tr><th>3</table>t": "table/tr/td 1|table/tr/td 2|table/tr/td/p z|table/tr/th 3| t",
        "<p>a<div>b</div>c<p>d</body></html>-": "p a|div b| c|p d| -",
        "<dl><dt>k<dd>v <i>w</i> u<dt>l<dd>m</dl>": "dl/dt k|dl/dd v |dl/dd/i w|dl/dd  u|dl/dt l|dl/dd m",
        "<p>x<br>y <b>q<p>r": "p x|p y |p q|p r",
        "<table><tbody><tr><td><div>a<td>b<tbody><tr><td>c</table>": "table/tbody/tr/td/div a|table/tbody/tr/td b|table/tbody/tr/td c",
        "<select><option>1<option>2</select>3": "select/option 1|select/option 2| 3",
        "<p>a</p><p>b<section>c<p>d</section><p>e</p>": "p a|p b|section c|section/p d|p e",
        "</p><li>a</li></ul><p>b": "li a|p b",
    }
    data = spark.createDataFrame(list(enumerate(expected)), "page_id long, html string")
    found = dom.dom_nodes(data).where("kind = 'text'").orderBy("page_id", "node_id").collect()
    for number, text in enumerate(expected):
        here = [r for r in found if r.page_id == number]
        shown = "|".join(re.sub(r"\[\d+\]", "", r.path)[1:] + " " + r.text for r in here)
        assert shown == expected[text], text
    second = [r for r in found if r.page_id == 0][3]
    assert second.path == "/div[1]/p[2]"


def test_article_of_open_paragraphs_loses_no_text(spark):
    html = (
        '<h1>T</h1><div class="article-body"><article><p class="Body">one <b>x</b> two <i>y</i> three'
        '<p class="Body">four<br> five<p>six</article></div>'
    )
    content = dom.path_lists(
        spark.createDataFrame([(1, html)], "page_id long, html string"),
        {"p": '//div[@class="article-body"]/article/p/text()', "b": "//article/p/b/text()"},
    ).first()
    assert content.p == ["one ", " two ", " three", "four", " five", "six"]
    assert content.b == ["x"]


def test_numbers_of_equal_values_come_from_even_ranges(spark, monkeypatch):
    data = spark.range(16_000).select(F.lit(7).alias("seen_at"), F.concat(F.lit("http://h/"), F.sha2(F.col("id").cast("string"), 256)).alias("url"))
    placed, write = [], skew.written
    monkeypatch.setattr(skew, "written", lambda df, name: placed.append(df) or write(df, name))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        numbered = skew.number_rows(data, "seen_at", ["url"], out="id", base=5)
        urls = [r.url for r in numbered.orderBy("id").collect()]
        assert urls == sorted(urls) and len(urls) == 16_000
        assert rows(numbered.agg(F.min("id"), F.max("id"), F.countDistinct("id"))) == [(6, 16_005, 16_000)]
        sizes = [r["count"] for r in placed[0].groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 16 and max(sizes) < 2_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_template_builds_the_tree_once(spark, monkeypatch):
    built, structure = [], template.page_structure
    monkeypatch.setattr(template, "page_structure", lambda *a: built.append(a) or structure(*a))
    data = spark.createDataFrame([(1, "h", "<p>a</p>"), (2, "h", "<p>b</p><i>c</i>")], "page_id long, host string, html string")
    plan = template.page_template(data, "host")
    assert len(built) == 1 and "regexp_extract_all" not in plan._jdf.queryExecution().optimizedPlan().toString()
    paths = template.group_paths(template.group_nodes(data, "host"))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in paths


def test_element_tree_is_built_within_the_row(spark):
    data = spark.createDataFrame([(1, "h", PAGE), (2, "h", "<p>b</p><i>c</i>")], "page_id long, host string, html string")
    lists = {"b": "//table//b/text()", "k": "//ul/li[2]/i/text()"}
    for made in (dom.path_lists(data, lists), dom.dom_nodes(data), template.group_nodes(data, "host")):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Window|Exchange|\bSort\b|Aggregate", plan)
    # rows that share an id are one page, their tokens side by side
    twice = dom.path_lists(data.unionByName(data.where("page_id = 1")), lists).orderBy("page_id").collect()
    assert [r.b for r in twice] == [["q", "q"], []]


def test_paths_are_states_along_the_page(spark):
    deep = "<div>" * 3000 + "<p class='x'>a<br>b<p>c&amp;d" + "</div>" * 3000 + "<table><tr><td>1</td><td><i>2</i>3</td></tr></table><script>if (a&amp;b)</script>"
    data = spark.createDataFrame([(1, deep), (2, ""), (3, None), (4, "<!-- -->"), (5, "x")], "page_id long, html string")
    lists = {
        "all": "//div/p/text()",
        "x": '//div//p[@class="x"]/text()',
        "far": "//div[2]/p/text()",
        "cells": "/html/body/table/tbody/tr/td[2]/text()",
        "inside": "//tbody//text()",
        "raw": "//script/text()",
        "root": "/text()",
        "any": "//tr/*[1]/text()",
    }
    found = dom.path_lists(data, lists)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # chains of elements are neither spelled nor searched, and only the selected nodes leave the function
    assert "zip_with" not in plan.lower() and "aggregate(" not in plan
    rows = {r.page_id: r for r in found.collect()}
    assert set(rows) == {1, 5}
    one = rows[1]
    assert [one.all, one.x, one.far] == [["a", "b", "c&d"], ["a", "b"], []]
    assert [one.cells, one.raw, one.any, one.root] == [["3"], ["if (a&amp;b)"], ["1"], []]
    # the tree may lack a tbody, so this path asks for nothing
    assert one.inside == ["a", "b", "c&d", "1", "2", "3", "if (a&amp;b)"]
    assert rows[5].root == ["x"] and rows[5].all == []


def test_nodes_come_as_flat_rows(spark):
    html = "<dl class=z><dt>a &amp; b</dt><dd/>c<script>x&amp;y</script></dl>"
    data = spark.createDataFrame([(1, "h", html), (2, "h", None), (None, "g", "t")], "page_id long, host string, html string")
    nodes = template.group_nodes(data, "host")
    plan = nodes._jdf.queryExecution().executedPlan().toString()
    # the array of the nodes of a page is never made
    assert "MapInArrow" in plan and "inline" not in plan
    assert rows(nodes.select("page_id", "grp", "path", "node_id", "parent_id", "nth", "text")) == [
        (1, "h", "/dl", 0, None, 1, None),
        (1, "h", "/dl/#text", 6, 0, 1, "c"),
        (1, "h", "/dl/dd", 4, 0, 1, None),
        (1, "h", "/dl/dt", 1, 0, 1, None),
        (1, "h", "/dl/dt/#text", 2, 1, 1, "a & b"),
        (1, "h", "/dl/script", 7, 0, 1, None),
        (1, "h", "/dl/script/#text", 8, 7, 1, "x&amp;y"),
        (None, "g", "/#text", 0, None, 1, "t"),
    ]


def test_runs_of_siblings_are_found_within_the_row(spark):
    lists = [
        (1, "h", "<dl><dt>a</dt><dd>b</dd><dd>c</dd><dt>d</dt><dd>e</dd></dl><b>1</b><i>2</i><b>3</b><u>4</u><i>5</i>"),
        (2, "h", "<p><i>x</i>text</p>"),
        (3, "h", "<i>1</i><b>2</b><u>3</u><i>4</i><b>5</b><u>6</u><i>7</i><b>8</b><dl><dt>a</dt><dd>b</dd></dl>"),
    ]
    data = spark.createDataFrame(lists, "page_id long, host string, html string")
    found = template.template_runs(data, "host")
    assert rows(found) == [("h", "", "i b u", 1, 2), ("h", "/dl", "dt dd", 1, 2)]
    nodes = template.group_nodes(data, "host", runs=True)
    assert not re.search("Window|Exchange", nodes._jdf.queryExecution().executedPlan().toString())
    noted = nodes.where("again or loose").select("page_id", "path", "again", "loose")
    assert rows(noted) == [(1, "/b", False, True), (1, "/b", False, True), (1, "/dl/dd", True, False), (1, "/i", False, True), (1, "/i", False, True), (3, "/b", False, True), (3, "/i", False, True)]
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()


def test_first_match_tells_an_empty_group_from_no_match(spark):
    data = spark.createDataFrame([("<b></b>",), ("<b>x</b>",), ("<i>",), (None,)], "html string")
    found = records.first_match(F.col("html"), "<b>([^<]*)</b>")
    assert [r[0] for r in data.select(found).collect()] == ["", "x", None, None]
    # the pattern is searched again only where its group is empty
    plan = data.select(records.first_match(F.col("html"), "<b>([^<]*)</b>"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("REGEXP_EXTRACT" if "REGEXP_EXTRACT" in plan else "regexp_extract") < plan.index("RLIKE")
