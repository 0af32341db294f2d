"""Crawl rounds, the stored crawl, the stream."""

import datetime
import os
import tempfile

from pyspark.sql import functions as F

from linkweft.operators import lookups, summaries
from linkweft.plans import crawl
from linkweft.sources import store as ST
from linkweft.streaming import ingest

CAPTURES = [
    (
        "http://gov.si/",
        '<a href="/x">1</a><a href="/d.pdf">d</a><a href="http://evem.gov.si/">e</a>'
        '<a href="http://evil.com/">z</a><img src="/i.png"><img src="/i.png">',
    ),
    ("http://evem.gov.si/", "same"),
    ("http://e-uprava.gov.si/", "same"),
    ("http://gov.si/x", "<a href=\"/\">h</a><div onclick=\"location.href='/y'\">"),
    ("http://gov.si/d.pdf", "pdf <a href='/q'>"),
    ("http://gov.si/y", "end"),
]


def now():
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_rounds_until_the_frontier_is_empty(spark):
    captures = spark.createDataFrame(CAPTURES, "url string, html string")
    store = crawl.crawl_rounds(spark, captures, now())
    types = {r.url: (r.page_type_code, r.http_status_code) for r in store["page"].collect()}
    assert types == {
        "http://gov.si/": ("HTML", 200),
        "http://www.e-prostor.gov.si/": ("HTML", 404),
        "http://evem.gov.si/": ("HTML", 200),
        "http://e-uprava.gov.si/": ("DUPLICATE", 200),
        "http://gov.si/x": ("HTML", 200),
        "http://gov.si/d.pdf": ("BINARY", 200),
        "http://gov.si/y": ("HTML", 200),
        "http://gov.si/q": ("HTML", 404),
    }
    assert rows(store["link"]) == [(1, 3), (1, 5), (1, 6), (4, 3), (5, 1), (5, 7), (6, 8)]
    assert rows(store["image"].select("page_id", "filename")) == [(1, "/i.png"), (1, "/i.png")]
    assert rows(store["page_data"].select("page_id", "data_type_code")) == [(6, "PDF")]
    assert rows(store["site"].select("domain"))[-1] == ("gov.si",)
    assert store["page"].where("page_type_code = 'BINARY' and html_content is not null").count() == 0
    for check in (
        lookups.fk_violations,
        lookups.enum_violations,
        lookups.unique_violations,
        lookups.length_violations,
    ):
        assert rows(check(store)) == [], check.__name__
    counts = dict(rows(summaries.crawl_summary(store)))
    assert counts == {"frontier": 0, "pages": 8, "sites": 4, "page_data": 1, "images": 2, "links": 7}


def test_interrupted_run_goes_on_and_reset_starts_anew(spark):
    root = tempfile.mkdtemp(prefix="run-")
    captures = spark.createDataFrame(CAPTURES, "url string, html string")
    crawl.crawl_rounds(spark, captures, now(), root=root, max_rounds=1)
    assert ST.rounds(spark, root) == (0, 1)
    store = crawl.crawl_rounds(spark, captures, now(), root=root)
    assert store["page"].count() == 8
    ST.reset_store(spark, root)
    store = ST.read_store(spark, root)
    assert store["page"].count() == 4
    assert store["link"].count() == 0


def test_robots_forbid_a_page(spark):
    store = ST.seed_store(spark, ("http://a.gov.si/p", "http://a.gov.si/q"))
    site = spark.createDataFrame(
        [(1, "a.gov.si", "User-agent: *\nDisallow: /p", None)],
        "id long, domain string, robots_content string, sitemap_content string",
    )
    captures = spark.createDataFrame(
        [("http://a.gov.si/p", "x"), ("http://a.gov.si/q", "y")], "url string, html string"
    )
    delta = crawl.crawl_round({**store, "site": site}, captures, now())
    status = rows(delta["page"].select("url", "http_status_code"))
    assert status == [("http://a.gov.si/p", 403), ("http://a.gov.si/q", 200)]


def test_stream_in_two_drops_equals_one_batch(spark):
    folder, root = tempfile.mkdtemp(prefix="run-"), tempfile.mkdtemp(prefix="run-")
    data = [(i, u, h) for i, (u, h) in enumerate(CAPTURES)]
    captures = spark.createDataFrame(data, ingest.CAPTURE_COLUMNS)
    for part in (captures.where("page_id < 3"), captures.where("page_id >= 3")):
        part.coalesce(1).write.mode("append").parquet(folder)
        stream = ingest.read_captures(spark, folder, files_per_batch=1)
        ingest.ingest_stream(stream, f"{root}/store", now()).awaitTermination()
    streamed = ST.read_store(spark, f"{root}/store")

    seeds = captures.select("url", F.col("page_id").alias("seen_at"))
    start = crawl.seed_crawl(spark, seeds, now())
    batch = crawl.merge_round(start, crawl.crawl_round(start, captures, now()))

    def pages(store):
        return rows(store["page"].select("url", "page_type_code", "http_status_code", "hash_code"))

    def edges(store):
        ids = store["page"].select("id", "url")
        joined = store["link"].join(ids, F.col("from_page") == F.col("id")).select("url", "to_page")
        target = ids.withColumnRenamed("url", "target")
        return rows(joined.join(target, F.col("to_page") == F.col("id")).select("url", "target"))

    assert pages(streamed) == pages(batch)
    assert edges(streamed) == edges(batch)


def _drop(spark, folder, urls, first_id):
    rows = [(first_id + k, u, f"text of {u}") for k, u in enumerate(urls)]
    captures = spark.createDataFrame(rows, ingest.CAPTURE_COLUMNS)
    captures.coalesce(1).write.mode("append").parquet(folder)


def _fetched(spark, root):
    page = ST.read_store(spark, root)["page"]
    return sorted(r.url for r in page.where("http_status_code = 200").collect())


def test_stream_adds_to_a_store_with_rounds(spark):
    folder, root = tempfile.mkdtemp(prefix="run-"), f"{tempfile.mkdtemp(prefix='run-')}/store"
    captures = spark.createDataFrame(CAPTURES, "url string, html string")
    crawl.crawl_rounds(spark, captures, now(), root=root)
    before = _fetched(spark, root)

    def run(checkpoint):
        stream = ingest.read_captures(spark, folder, files_per_batch=1)
        ingest.ingest_stream(stream, root, now(), checkpoint).awaitTermination()

    _drop(spark, folder, ["http://gov.si/s1", "http://gov.si/s2"], 100)
    run(f"{root}/one")
    assert _fetched(spark, root) == sorted([*before, "http://gov.si/s1", "http://gov.si/s2"])
    # another stream with its own batch 0, and the first one again with a later batch
    _drop(spark, folder, ["http://gov.si/s3"], 200)
    run(f"{root}/two")
    run(f"{root}/one")
    streamed = [f"http://gov.si/s{k}" for k in (1, 2, 3)]
    assert _fetched(spark, root) == sorted([*before, *streamed])
    # after a reset the store is empty and takes up what comes next
    ST.reset_store(spark, root)
    _drop(spark, folder, ["http://gov.si/s4"], 300)
    run(f"{root}/one")
    assert _fetched(spark, root) == ["http://gov.si/s4"]
    # a batch crawl goes on after a stream
    store = crawl.crawl_rounds(spark, captures, now(), root=root)
    assert store.finished and "http://gov.si/x" in _fetched(spark, root)


def test_a_batch_that_is_run_twice_counts_once(spark):
    root = f"{tempfile.mkdtemp(prefix='run-')}/store"
    ST.save_round(ST.seed_store(spark, ()), root, 0)
    batch = spark.createDataFrame([(1, "http://a.gov.si/", "x"), (2, "http://a.gov.si/", "y")], ingest.CAPTURE_COLUMNS)
    run = ingest.ingest_batch(root, now(), source="s")
    run(batch, 0)
    run(batch, 0)
    assert ST.rounds(spark, root) == (0, 1)
    assert _fetched(spark, root) == ["http://a.gov.si/"]
    run(batch.selectExpr("page_id + 5 as page_id", "'http://b.gov.si/' as url", "html"), 1)
    assert ST.rounds(spark, root) == (0, 2)
    assert _fetched(spark, root) == ["http://a.gov.si/", "http://b.gov.si/"]


def test_a_batch_writes_what_it_changes(spark):
    root = f"{tempfile.mkdtemp(prefix='run-')}/store"
    urls = spark.range(4_000).selectExpr("concat('http://w.gov.si/', id) as url", "id as seen_at")
    ST.save_round(crawl.seed_crawl(spark, urls, now()), root, 0)
    batch = [(1, "http://w.gov.si/7", "<a href='/new'>"), (2, "http://w.gov.si/8", "x"), (3, "http://n.gov.si/", "y"), (4, "http://w.gov.si/9", "z")]
    ingest.ingest_batch(root, now(), source="s")(spark.createDataFrame(batch, ingest.CAPTURE_COLUMNS), 0)

    def written(folder):
        return {t: spark.read.parquet(f"{folder}/{t}").count() for t in os.listdir(folder)}

    rounds = {t: spark.read.parquet(f"{root}/{t}/round=1").count() for t in ("page", "frontier", "site", "link")}
    assert rounds == {"page": 4, "frontier": 5, "site": 2, "link": 1}
    assert max(written(f"{root}/stage/round=1").values()) <= 5
    known = ST.state(spark, root)
    assert (known["waiting"], known["settled"], known["top_page"], known["base"]) == (3_998, 4, 4_002, 0)
    before = ST.read_store(spark, root)
    ST.compact_store(spark, root)
    after = ST.read_store(spark, root)
    assert ST.state(spark, root) == {**known, "base": 2, "source": None, "batch": None}
    for table in ("page", "site", "link"):
        assert rows(after[table]) == rows(before[table]), table
    assert after["page"].where("page_type_code = 'FRONTIER'").count() == 3_998


def test_budget_is_told_from_an_empty_frontier(spark):
    chain = [(f"http://gov.si/{k}", f'<a href="/{k + 1}">n</a>') for k in range(3)]
    captures = spark.createDataFrame(chain, "url string, html string")
    seeds = captures.where("url = 'http://gov.si/0'").selectExpr("url", "1 as seen_at")
    root = f"{tempfile.mkdtemp(prefix='run-')}/store"
    store = crawl.crawl_rounds(spark, captures, now(), root=root, seeds=seeds, max_rounds=1)
    assert not store.finished
    store = crawl.crawl_rounds(spark, captures, now(), root=root, seeds=seeds)
    assert store.finished and store["page"].count() == 4


def test_busy_or_in_flight_alone(spark):
    store = ST.seed_store(spark, ("http://a.gov.si/p", "http://b.gov.si/q"))
    captures = spark.createDataFrame([("http://a.gov.si/p", "x"), ("http://b.gov.si/q", "y")], "url string, html string")

    def waiting(**options):
        page = crawl.crawl_round(store, captures, now(), **options)["page"]
        return rows(page.where("page_type_code = 'FRONTIER'").select("url"))

    in_flight = spark.createDataFrame([("http://a.gov.si/p",)], "url string")
    assert waiting(in_flight=in_flight) == [("http://a.gov.si/p",)]
    assert waiting(busy=spark.createDataFrame([("b.gov.si",)], "busy_key string")) == [("http://b.gov.si/q",)]
    host_ip = spark.createDataFrame([("a.gov.si", "10.0.0.1"), ("b.gov.si", "10.0.0.2")], "host string, ip string")
    busy = spark.createDataFrame([("10.0.0.1",)], "busy_key string")
    assert waiting(busy=busy, host_ip=host_ip) == [("http://a.gov.si/p",)]


def test_robots_texts_and_polite_turns_inside_the_rounds(spark):
    urls = ["http://a.gov.si/1", "http://a.gov.si/private/2", "http://b.gov.si/3", "http://a.gov.si/4"]
    captures = spark.createDataFrame([(u, f"text {u}") for u in urls], "url string, html string")
    seeds = spark.createDataFrame([(u, k) for k, u in enumerate(urls)], "url string, seen_at long")
    texts = [
        ("a.gov.si", "User-agent: *\nDisallow: /private\nSitemap: http://a.gov.si/s.xml", "<urlset/>"),
        ("b.gov.si", "<html>not found</html>", None),
    ]
    robots = spark.createDataFrame(texts, "domain string, robots_content string, sitemap_content string")
    start = crawl.seed_crawl(spark, seeds, now())
    polite = crawl.crawl_round(start, captures, now(), robots=robots, one_per_host=True)
    waiting = polite["page"].where("page_type_code = 'FRONTIER'").select("url")
    assert rows(waiting) == [("http://a.gov.si/4",), ("http://a.gov.si/private/2",)]
    root = f"{tempfile.mkdtemp(prefix='run-')}/store"
    store = crawl.crawl_rounds(spark, captures, now(), root=root, seeds=seeds, robots=robots, one_per_host=True)
    assert store.finished and ST.rounds(spark, root) == (0, 3)
    status = {r.url: r.http_status_code for r in store["page"].collect()}
    assert status == {u: 403 if "private" in u else 200 for u in urls}
    sites = {r.domain: (r.robots_content[:10], r.sitemap_content) for r in store["site"].collect()}
    assert sites["a.gov.si"] == ("User-agent", "<urlset/>")
    assert sites["b.gov.si"] == ("NULL", "NULL")


def test_rounds_keep_the_delays_of_hosts(spark):
    texts = [("a.gov.si", "User-agent: *\nDisallow: /no\nCrawl-delay: 4\n", None), ("b.gov.si", "User-agent: *\nCrawl-delay: 0\n", None)]
    robots = spark.createDataFrame(texts, "domain string, robots_content string, sitemap_content string")
    urls = [f"http://{h}.gov.si/{k}" for h in ("a", "b", "c") for k in range(5)] + ["http://a.gov.si/no"]
    seeds = spark.createDataFrame([(u, k) for k, u in enumerate(urls)], "url string, seen_at long")
    captures = spark.createDataFrame([(u, f"<p>{u}</p>") for u in urls], "url string, html string")
    after = crawl.crawl_round(crawl.seed_crawl(spark, seeds, now()), captures, now(), robots=robots, turn_seconds=9)
    settled = [r.url[7:] for r in after["page"].where("page_type_code <> 'FRONTIER'").collect()]
    # 4, 1 and 5 seconds apart; what is forbidden takes no turn
    assert sorted(settled) == sorted(["a.gov.si/0", "a.gov.si/1", "a.gov.si/2", "a.gov.si/no", *[f"b.gov.si/{k}" for k in range(5)], "c.gov.si/0", "c.gov.si/1"])
    store = crawl.crawl_rounds(spark, captures, now(), seeds=seeds, robots=robots, turn_seconds=9)
    assert store.finished and store["page"].where("http_status_code = 200").count() == 15


def test_turns_are_limited_before_the_shuffle(spark):
    url = F.concat(F.lit("http://h"), F.col("id") % 3, F.lit(".si/"))
    frontier = spark.range(1000).select("id", url.alias("url"), F.lit(2).alias("delay"))
    in_time = summaries.rows_in_time(frontier, 60)
    assert in_time.count() == 3 * 31
    assert in_time._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


def test_stream_of_urls_leaves_out_known_and_late_rows(spark):
    folder = tempfile.mkdtemp(prefix="run-")
    schema = "url string, seen_at timestamp"
    stamp = lambda text: datetime.datetime.fromisoformat(f"2024-01-01 {text}")
    batches = [
        [("http://A.si/a#x", stamp("00:00:00")), ("http://a.si/a", stamp("00:00:01")), ("http://a.si/stored", stamp("10:00:00")), ("http://a.si/b", stamp("10:00:00"))],
        [("http://a.si/late", stamp("08:00:00")), ("http://a.si/a", stamp("10:01:00")), ("http://a.si/b", stamp("10:02:00")), ("http://a.si/c", stamp("09:30:00"))],
    ]
    known = spark.createDataFrame([("http://a.si/stored",)], "url string")
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        unique = ingest.stream_url_dedupe(stream, "seen_at", "1 hour", known)
        sink = unique.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state")
        sink.trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
    found = [r.url for r in spark.read.schema(schema).parquet(f"{folder}/out").collect()]
    # the first of a is older than the watermark's hour by the second batch, so its state is gone
    assert sorted(found) == ["http://a.si/a", "http://a.si/a", "http://a.si/b", "http://a.si/c"]


def test_saved_files_records_and_template(spark):
    from linkweft.operators.template import page_template

    folder = tempfile.mkdtemp(prefix="run-")
    for number in (1, 2):
        with open(f"{folder}/{number}.html", "w") as out:
            out.write(f"<p>\nž{number}</p>")
    pages = ST.load_html_files(spark, folder)
    assert rows(pages.select("html")) == [("<p>\nž1</p>",), ("<p>\nž2</p>",)]
    keyed = pages.select(F.xxhash64("path").alias("page_id"), F.lit("g").alias("grp"), "html")
    ST.write_template(page_template(keyed, "grp"), f"{folder}/template")
    lines = ST.read_template(spark, f"{folder}/template").orderBy("line_no")
    assert [(r.grp, r.line) for r in lines.collect()] == [("g", "<p>"), ("g", "  #PCDATA"), ("g", "</p>")]
    records = spark.createDataFrame([("a", None), ("b", "č")], "k string, v string")
    assert rows(ST.records_to_json(records, ["k", "v"])) == [('{"k":"a"}',), ('{"k":"b","v":"č"}',)]


def test_saved_pages_are_one_file_each(spark, tmp_path):
    texts = ["<p>a\nb</p>", None, "", "č\n\n", "<p>a\nb</p>"]
    pages = spark.createDataFrame([(t,) for t in texts], "html string").repartition(3)
    folder = f"file://{tmp_path}/new/html"
    assert ST.save_html_files(pages, folder) == 5
    files = sorted((tmp_path / "new/html").iterdir())
    assert sorted(f.read_bytes().decode() for f in files) == sorted(f"{t or ''}\r" for t in texts)
    assert sorted(r.html for r in ST.load_html_files(spark, folder).collect()) == sorted(f"{t or ''}\r" for t in texts)
    # written again, as by a task that is run twice, they are the same files
    ST.save_html_files(pages, folder)
    assert sorted((tmp_path / "new/html").iterdir()) == files
    assert ST.save_html_files(pages.where("false"), f"{tmp_path}/none") == 0
    assert ST.load_html_files(spark, f"{tmp_path}/none").count() == 0


def test_a_round_cuts_its_pages_into_tags_once(spark, monkeypatch):
    from linkweft.functions import html as H
    from linkweft.operators import pages as P

    cut, whole = [], H.opening_tags
    monkeypatch.setattr(H, "opening_tags", lambda html: cut.append(1) or whole(html))
    captures = spark.createDataFrame(CAPTURES, "url string, html string")
    start = ST.seed_store(spark)
    delta = crawl.crawl_round(start, captures, now())
    assert rows(delta["image"].select("filename")) == [("/i.png",), ("/i.png",)]
    assert len(cut) == 1
    # the same rows as with a pass for links and one for images, odd pages included
    odd = [
        (1, "http://a.gov.si/", '<a href="/x?b&amp;a">1</a><a href="/x?a&b">2</a><a>3</a><img><img src=\'/i&amp;j.png\'>'),
        (1, "http://a.gov.si/2", "<LINK HREF=/no><area href=/m><div onclick=\"location.href='/y'\" HREF=/n><div onclick='go()'>"),
        (2, "no host", '<a href="/x">1</a><a href="http://b.gov.si/">2</a><img src="' + "z" * 256 + '">'),
        (None, "http://a.gov.si/3", '<a href="/x">1</a><img src="/k.gif">'),
        (4, None, '<a href="/x">1</a><a href="http://gov.si">2</a>'),
        (5, "http://a.gov.si/5", None),
        (6, "http://a.gov.si/6", '<script>"<a href=/s>"</script><a title="href=/t" x="">no</a><a href="">e</a>'),
    ]
    pages = spark.createDataFrame(odd, "page_id long, url string, html string")
    found = P.page_references(pages)
    assert rows(P.reference_links(found)) == rows(P.page_links(pages)) != []
    assert rows(P.reference_images(found)) == rows(P.page_images(pages)) != []


def test_a_polite_round_applies_the_rules_of_hosts_once(spark, monkeypatch):
    applied, robots_allowed = [], crawl.robots_allowed
    monkeypatch.setattr(crawl, "robots_allowed", lambda *a, **k: applied.append(1) or robots_allowed(*a, **k))
    seeds = spark.createDataFrame([("http://a.gov.si/1", 1), ("http://a.gov.si/no", 2), ("http://b.gov.si/", 3)], "url string, seen_at long")
    robots = spark.createDataFrame([("a.gov.si", "User-agent: *\nDisallow: /no\n", None)], "domain string, robots_content string, sitemap_content string")
    captures = spark.createDataFrame([("http://a.gov.si/1", "x"), ("http://a.gov.si/no", "y")], "url string, html string")
    # several rows of a host with addresses make no further rows of the round
    host_ip = spark.createDataFrame([("a.gov.si", "10.0.0.1"), ("a.gov.si", "10.0.0.2")], "host string, ip string")
    after = crawl.crawl_round(crawl.seed_crawl(spark, seeds, now()), captures, now(), robots=robots, host_ip=host_ip, turn_seconds=1)
    status = rows(after["page"].select("url", "http_status_code"))
    assert status == [("http://a.gov.si/1", 200), ("http://a.gov.si/no", 403), ("http://b.gov.si/", 404)]
    assert len(applied) == 1
