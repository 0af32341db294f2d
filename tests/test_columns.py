"""URL, entity, token and robots columns against vectors and the standard library."""

import html
import io
import urllib.robotparser
from html.parser import HTMLParser

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkweft.functions import html as H
from linkweft.functions import robots as R
from linkweft.functions import text as T
from linkweft.functions import url as U

NONE = "http://gov.si/"


def values(spark, column, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    out = spark.createDataFrame(rows, "i int, t string").select("i", column(F.col("t")).alias("o"))
    return [r.o for r in sorted(out.collect())]


def test_canonical_url(spark):
    vectors = {
        "HTTPS://User@Host.SI:8080/A/b;Q=2;p=1?B=2&a=1#f": "http://host.si/A/b;p=1;q=2?a=1&b=2",
        "http://a/x;y/z;w": "http://a/x;y/z;w",
        "http://a/b?": "http://a/b",
        "http://a?q": "http://a?q",
        "http://a/b?x&&Y": "http://a/b?&x&y",
        "http://a.si/č d%20": "http://a.si/%C4%8D%20d%2520",
        "ftp://H/x;T": "ftp://h/x;t",
        " \thttp://A/\nb": "http://a/b",
        "gopher://H/X;T": "gopher://h/X;T",
        "http:foo": NONE,
        "httpfoo": NONE,
        "http://": NONE,
        "http:///x": NONE,
        "http://[::1/a": NONE,
        "mailto:x@gov.si": NONE,
    }
    assert values(spark, U.canonical_url, vectors) == list(vectors.values())


def test_resolve_link(spark):
    host = F.lit("e-uprava.gov.si")
    vectors = {
        "/a?B=1": "http://e-uprava.gov.si/a?b=1",
        "//x.si/y": "http://e-uprava.gov.si//x.si/y",
        "https://www.GOV.si/": "http://www.gov.si/",
        "http://example.com/": None,
        "HTTP://www.gov.si/": None,
        "x.html": None,
        "#f": None,
        "mailto:a@gov.si": None,
        "httpfoo": NONE,
    }
    resolved = values(spark, lambda c: U.resolve_link(c, host), vectors)
    assert resolved == list(vectors.values())
    assert values(spark, lambda c: U.resolve_link(c, host, True), ["/a", None]) == [None, None]


def test_file_and_image_types(spark):
    assert values(spark, U.file_type, ["http://h/f.pdf", "http://h/f.pdf?x=1"]) == ["PDF", "PDF?X=1"]
    assert values(spark, U.ending, ["/i/a.b.PNG", "/logo"]) == ["PNG", "/logo"]
    assert values(spark, U.image_fits, ["/a.png", "x" * 300, "/a." + "p" * 51]) == [True, False, False]


ENTITIES = [
    "a&amp;b &amp;lt; &lt;x&gt; &#39;&#x26;&#128;&#0;&#xD800;&#x110000;",
    "&copy 2020 &ampx &unknown; & &; &notit; &notin; &nbsp;&middot;&quot;",
    "&#x1F600;&#99999999999;&#xFFFFFFFFFFFFF;&#1;&#129;&#x0041;&#0065&#65",
    "&NotEqualTilde;&#x;&#;&#xfdd0;&#11;",
    "plain",
]


def test_entities_like_the_library(spark):
    assert values(spark, T.decode_entities, ENTITIES) == [html.unescape(t) for t in ENTITIES]


class Reader(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        self.found.append(("stag", tag))

    def handle_endtag(self, tag):
        self.found.append(("etag", tag))

    def handle_data(self, data):
        self.found.append(("value", data))


def library_tokens(text):
    reader = Reader()
    reader.feed(text)
    return reader.found


MARKUP = [
    '<a href="x>y">t</a>',
    "<a title=it's>q</a>",
    "a < b <br/> c<br />d",
    '<script src=x></script><script type="a">if(a<b){"<!--"}</script>z',
    "<!-- <a> -->x<!doctype html>y",
    "<a href=http://x/>k</a>",
    "x<!--a-->y<?php x ?>z",
    "&lt;b&gt; <b>&amp;</b>",
    "<style>p>a{}</style><p\n class=a>u</p >",
]


def test_tokens_like_the_library(spark, sf_dir):
    pages = [r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("html").collect()]
    texts = MARKUP + pages
    found = values(spark, H.bare_tokens, texts)
    assert [[tuple(t) for t in f] for f in found] == [library_tokens(t) for t in texts]


def test_attributes(spark):
    tags = ['<IMG SRC="a.png" ALT=\'q\' src=b>', "<a href=http://x/>", '<a title="x href=no" HREF="/a&amp;b">']
    assert values(spark, H.attributes, tags) == [
        {"src": "a.png", "alt": "q"},
        {"href": "http://x/"},
        {"title": "x href=no", "href": "/a&b"},
    ]


ROBOTS = [
    "User-agent: bot\nDisallow: /\n\nUser-agent: *\n\nDisallow: /a*\nDisallow: *\nAllow: /p/x\n"
    "Disallow: /p\nCrawl-delay: 3",
    "User-agent: a\n\nUser-agent: *\nDisallow: /q",
    "User-agent: *\nDisallow: /a\nUser-agent: *\nDisallow: /b",
    "User-agent:\nDisallow: /\nUser-agent: *\nAllow: /",
    "User-agent: *\nDisallow:\nCrawl-delay: 1.5",
    "User-agent: *\r\nDisallow: /c%20d # x\r\nSitemap: http://q/s.xml\r\nDisallow: /s?x=1\r\n",
    "User-agent: *\nCrawl-delay: 7\nUser-agent: b\nDisallow: /z",
    "NULL",
    "",
]
PATHS = ["/a1", "/a*1", "/p/x1", "/p1", "/z", "/q", "/b", "/c d", "/c%20d", "/s?x=1", "/s", "", "?a"]


def check_robots(spark, texts):
    rows = [(t, "http://h.si" + p) for t in texts for p in PATHS]
    out = spark.createDataFrame(rows, "t string, u string").select(
        "t",
        "u",
        R.robots_delay(F.col("t")).alias("delay"),
        R.allowed_by(R.robots_rules(F.col("t")), F.col("u")).alias("allowed"),
        R.robots_sitemaps(F.col("t")).alias("maps"),
    )
    for r in out.collect():
        rules = urllib.robotparser.RobotFileParser()
        rules.parse(io.StringIO(r.t))
        expected = (rules.crawl_delay("*") or 5, rules.can_fetch("*", r.u), rules.site_maps() or [])
        assert (r.delay, r.allowed, r.maps) == expected, (r.t, r.u)


def test_robots_like_the_library(spark):
    check_robots(spark, ROBOTS)


LINES = st.sampled_from(
    ["User-agent: *", "User-agent: a", "User-agent:", "Disallow: /p", "Disallow:", "Allow: /p/x",
     "Disallow: /", "Crawl-delay: 4", "Crawl-delay: x", "Sitemap: http://s/", "# c", "", "junk"]
)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(LINES, max_size=12), min_size=20, max_size=20))
def test_robots_random_texts(spark, texts):
    check_robots(spark, ["\n".join(t) + "\n" for t in texts])


def test_clean_up_columns(spark):
    assert values(spark, T.strip, ["\xa0 a b\n"]) == ["a b"]
    assert values(spark, T.before_break, ["\n\ta ob 1\n\tb"]) == ["a ob 1"]
    assert values(spark, T.second_word, [" Vezava: trda ", "x"]) == ["trda", None]
    assert values(spark, lambda c: F.array(*T.split_saving(c)), ["$5.00 (10%)", "$5"]) == [
        ["$5.00", "(10%)"],
        ["$5", None],
    ]
