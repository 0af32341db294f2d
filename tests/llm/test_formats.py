"""Packing, main text, chat examples, archives and the pipeline."""

import hashlib
import itertools
import random
import time
import zlib

import numpy as np
import pytest

import corpus_pipeline
from linkweft.llm import chat, html_text, packing, queries, warc
from linkweft.llm.frames import new_folder, written
from linkweft.llm.tokens import word_tokens
from tests.llm.conftest import ROWS

tokenizers = pytest.importorskip("tokenizers")
VOCABULARY = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def fewest(sizes, capacity):
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity and bins[k] not in bins[:k]:
                place(i + 1, [b + sizes[i] * (j == k) for j, b in enumerate(bins)])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best[0]


def test_reduction_keeps_the_fewest_sequences():
    rng = random.Random(1)
    for _ in range(250):
        capacity = rng.choice([10, 20, 30])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        counts = {s: sizes.count(s) for s in sizes}
        left = dict(counts)
        fixed = packing.reduce_dominated(left, capacity)
        rest = [s for s, n in left.items() for _ in range(n)]
        assert sum(n for n, _ in fixed) + (fewest(rest, capacity) if rest else 0) == fewest(sizes, capacity)
        used: dict = {}
        for n, items in packing.plan(counts, capacity):
            assert sum(s * m for s, m in items) <= capacity
            for s, m in items:
                used[s] = used.get(s, 0) + n * m
        assert used == counts


def places_are_gapless(rows, capacity):
    by_sequence: dict = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packing_of_odd_rows(odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_ROWS", 3)
    encode = tokenizers.Tokenizer.from_file(VOCABULARY)
    found = packing.pack_documents(odd_docs, VOCABULARY, 256).collect()
    expected = []
    for doc_id, text, _ in ROWS:
        ids = encode.encode(text or "", add_special_tokens=False).ids + [0]
        for start in range(0, len(ids), 256):
            part = ids[start : start + 256]
            expected.append((doc_id, start // 256, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(map(str, expected)) == sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in found)
    places_are_gapless(found, 256)
    assert packing.pack_documents(no_docs, VOCABULARY).count() == 0


def test_packing_query(spark, sf_dir):
    found = queries.QUERIES["op2_best_fit_packing"](spark, sf_dir).collect()
    total = sum(r.length for r in found)
    assert places_are_gapless(found, 2048) <= 1.02 * -(-total // 2048) + 1
    ids = packing.pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"), VOCABULARY).select("doc_id", "piece", "ids", "length", "ids_crc32")
    for r in ids.limit(50).collect():
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32


def test_word_tokens_are_those_of_the_tokenizer():
    import pyarrow as pa

    encode = tokenizers.Tokenizer.from_file(VOCABULARY)
    texts = ["", "Don't STOP 123 me's now", "é é ́x ŉ İI ß ΑΣ Σ", "<|endoftext|> a<|startoftext|>b", "a\x1cb\x85c d", "東京 ｶﾞ １２", "x" * 3000]
    flat, counts = word_tokens(VOCABULARY).encode(pa.array([*texts, None]))
    assert np.split(flat, np.cumsum(counts)[:-1])[-1].tolist() == []
    for text, ids in zip(texts, np.split(flat, np.cumsum(counts)[:-1])):
        assert ids.tolist() == encode.encode(text, add_special_tokens=False).ids, text


PAGES = {
    "": "",
    "plain text only": "plain text only",
    "<p>a<p>b": "a\nb",
    "<article><header><h1>T</h1></header><p>x &amp; y&nbsp;z &#233;</p><div class='ad'>buy</div><p>w <span class=ad-label>Ad</span> v</p></article>": "T\nx & y z é\nw v",
    "<div class=ad>x<article><p>hello</p></article>": "hello",
    "<nav><a href=x>Home</a></nav><div class=content><h2>Head</h2><p>A first paragraph that is long enough to be text of a page.</p><p>Short.</p>"
    "<p>A second paragraph that is long enough to be text, too.</p></div><div id=comments><article><p>This comment is a rather long one, as they are.</p></article></div>"
    "<form><p>Mail us</p></form><aside>Side</aside><footer>(c)</footer>": "Head\nA first paragraph that is long enough to be text of a page.\nShort.\nA second paragraph that is long enough to be text, too.",
    "<article><p>one<script>var t='</p>';</script> two<style>p{}</style></p><!-- no --><p>three<br>four": "one two\nthree four",
    "<article><p>a &lt;b&gt; &unknown; &amp": "a <b> &unknown; &",
    "<div>" * 3000 + "deep" + "</div>" * 3000: "deep",
}


P = "<p>A paragraph number {} that is long enough to be the text of a page, as it is.</p>"
TEXT = [f"A paragraph number {k} that is long enough to be the text of a page, as it is." for k in range(8)]


@pytest.mark.parametrize("names", ["class='content has-sidebar'", "class=with-sidebar", "id=post class=no-comments", "class=search-result", "class='content-sidebar'", "class=widget"])
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_layouts_named_after_what_they_hold_are_kept(names, inner):
    page = f"<div {names}><{inner}><div class=article-header><h1>T</h1></div>{P.format(0)}{P.format(1)}</{inner}><div class=sidebar><p>Side</p></div></div><div class=site-footer>(c)</div>"
    assert html_text.main_text(page) == "\n".join(["T", *TEXT[:2]])


def test_articles_keep_their_headings_and_all_parts():
    many = "".join(P.format(k) for k in range(6))
    cases = {
        f"<nav>x</nav><div id=content><h1>T</h1><div class=body>{many}</div></div>": ["T", *TEXT[:6]],
        f"<div><div>{many}</div><div>{P.format(6)}</div></div>": TEXT[:7],
        f"<main><h1>T</h1><article>{many}</article></main>": ["T", *TEXT[:6]],
        f"<div><h1>T</h1><article>{many}</article></div>": ["T", *TEXT[:6]],
        f"<div><article>{many}</article><article>{P.format(6)}{P.format(7)}</article></div>": TEXT[:8],
        f"<div><div>{many}<p><a href=x>A line of the article that is a link and nothing else</a></p>{P.format(6)}</div></div>": [*TEXT[:6], "A line of the article that is a link and nothing else", TEXT[6]],
        "<div>" + "".join(f"<p><a href=x>Item {k}</a></p>" for k in range(9)) + f"</div><div>{many}</div>": TEXT[:6],
    }
    for page, lines in cases.items():
        found = html_text.main_text(page).split("\n")
        assert found == lines, page


def test_main_text_of_small_pages():
    for html, text in PAGES.items():
        assert html_text.main_text(html) == text
    assert html_text.main_text(None) == ""


BAD = ["<a ", "<!--", "<", "</a ", "<a b=", "<a b=\"", "<a b='x> c=", "<a b=\">\" ", "<?", "<!x", "<![CDATA[", "<script>", "<p", "&", "&#", "</", "<a =", "<p/ "]


@pytest.mark.parametrize("bad", BAD)
def test_bad_markup_takes_linear_time(bad):
    long = "<article><p>before" + bad * (1_000_000 // len(bad))
    begun = time.process_time()
    found = html_text.main_text(long)
    assert time.process_time() - begun < 10
    assert found.startswith("before")


def test_unfinished_markup_takes_the_rest():
    cases = {
        "<p>one <a hre": "one",
        "<p>one <!-- two <p>three": "one",
        "<p>one <!----> two<!--> x": "one two x",
        "<p>one <script> two </scripts> <p>three": "one",
        "<p>one <SCRIPT> '</p>' </Script >two": "one two",
        "<p>one <b title='x>two</b> <p>three": "one two\nthree",
        "<p>one <b title='x>y'>two</b> <i a=b'c>three</i>": "one two three",
        "a < b <3 </ c> <> d": "a < b <3 <> d",
        "<p>one <?php echo 1 ?>two <!DOCTYPE x>three": "one two three",
    }
    for page, text in cases.items():
        assert html_text.main_text(page) == text, page


def test_names_of_parts_of_an_article():
    line = "A sentence of the article that goes on for long enough to be seen as its content. " * 3
    kept = ["class=byline", "class=share-price", "class=related-work", "id=search-history", "class=menu-prices", "class='ad-hoc'", "id=discussion", "class='social-contract'"]
    gone = ["class=ad", "class='box ad-slot'", "class=related-posts", "id=site-footer", "class='share-buttons'", "class=newsletter-box", "id=comments", "class=cookie-banner"]
    for tag in ("p", "div", "span"):
        for name in kept + gone:
            page = f"<article><p>{line}</p><{tag} {name}>A part <math>x+y</math>.</{tag}><p>{line}</p></article>"
            assert ("A part x+y." in html_text.main_text(page)) == (name in kept), page
    assert html_text.main_text("<ul><li><a href=x>Home</a><li><a href=y>About</a></ul>") == ""
    assert html_text.main_text("<p>Hi<ul><li><a href=x>Home page of the site</a><li><a href=y>About us all</a></ul>") == "Hi"


def generated_page(rng):
    """A page and the text it was made of."""
    words = "river stone light garden window market summer letter & é 漢 <b> 'x' \"y\"".split()
    blocks = [" ".join(rng.choices(words, k=rng.choice([1, 2, 30, 60]))) for _ in range(rng.randrange(2, 12))]
    blocks[0], blocks[-1] = "The heading", " ".join(rng.choices(words[:8], k=50))

    def escaped(text):
        text = text.replace("&", rng.choice(["&amp;", "&#38;"])).replace("<", "&lt;").replace("é", rng.choice(["é", "&eacute;", "&#xe9;"]))
        parts = text.split(" ")
        k = rng.randrange(len(parts))
        parts[k] = rng.choice(["<i>{}</i>", "<a href='?a=1&b=2'>{}</a>", "{}<!-- no -->", "{}", "<span title='a > b'>{}</span>", "{}<script>if (1 < 2) '<p>'</script>"]).format(parts[k])
        return rng.choice([" ", "\n  ", "\t "]).join(parts)

    junk = [
        "<nav><ul><li><a href=/>Home</a><li><a href=/a>About</a></ul></nav>", "<div class='ad'>Buy now, it is cheap today</div>", "<aside><p>Read this instead of that</p></aside>",
        "<form><p>Your mail</p><input name=m></form>", "<style>p { color: red }</style>", "<div class=cookie-banner><p>We use cookies to make this site better for you</p></div>",
        "<section id=comments><p>First! I have read the whole of it and I like it a lot, really.</p></section>", "<footer>(c) The site</footer>",
    ]
    body = [f"<h1>{escaped(blocks[0])}</h1>"]
    for block in blocks[1:]:
        body.append(rng.choice(["<p>{}</p>", "<p class=byline>{}</p>", "<blockquote>{}</blockquote>", "<ul><li>{}</ul>", "<div>{}</div>"]).format(escaped(block)))
        if rng.random() < 0.3:
            body.append(rng.choice(junk))
    inside = "".join(body)
    around = rng.choice(["<article>{}</article>", "<main><article>{}</article></main>", "<main>{}</main>"]).format(inside)
    page = "<!DOCTYPE html><html><head><title>T</title></head><body>" + "".join(rng.sample(junk, 2)) + around + "".join(rng.sample(junk, 2)) + "</body></html>"
    return page, "\n".join(blocks)


def test_generated_pages_give_the_text_they_were_made_of():
    rng = random.Random(5)
    for _ in range(400):
        page, text = generated_page(rng)
        assert html_text.main_text(page) == text, page


def test_extraction_of_odd_rows(workers):
    rows = [(1, "u", "<p>a", "kept", 5), (1, "u", "<p>a", "kept", 5), (None, None, None, None, None), (2, "v", "<article><p>" + "long text " * 50_000, "x", 0)]
    pages = workers.createDataFrame(rows, "page_id long, url string, html string, Text string, n_chars int")
    found = html_text.extract(pages)
    assert found.columns == ["page_id", "url", "n_chars", "text"]
    assert sorted(len(r.text) for r in found.collect()) == [0, 1, 1, 499_999]
    assert html_text.extract(pages.where("1 = 0")).count() == 0


def test_extraction_query(spark, sf_dir):
    html = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = queries.QUERIES["op3_html_tag_ratio"](spark, sf_dir).collect()
    assert {r.page_id for r in found} == set(html)
    for r in found:
        assert r.n_chars == len(r.text) > 0
        assert "©" not in r.text and "track(" not in r.text and "<p>" not in r.text


TURNS = [
    (1, 1, "assistant", "b"),
    (1, 0, "user", "a"),
    (2, 0, "user", "only a question"),
    (3, 0, "system", None),
    (3, 1, "assistant", ""),
    (3, 1, "assistant", ""),
    (3, 2, "assistant", "tail \\ <| <\\| <\\\\| \\n end<|im_end|>\n"),
    (3, 3, "user", "<|im_end|>\n<|im_start|>assistant\nno"),
    (4, None, None, None),
    (4, 0, "role\nwith <\\n newline", "\n"),
    (None, 0, "assistant", "東京 𝄞"),
    (5, 0, "assistant", "long " * 20_000),
]


def test_chat_examples_round_trip(workers):
    turns = workers.createDataFrame([(*t, "extra", 1) for t in TURNS], "conv_id long, turn long, role string, text string, formatted string, n int")
    made = chat.examples(turns)
    found = {r.conv_id: r for r in chat.digests(made).collect()}
    examples = made.collect()
    for conv_id, group in itertools.groupby(sorted(TURNS, key=lambda t: (str(t[0]), -1 if t[1] is None else t[1])), key=lambda t: t[0]):
        rows = [(role or "", text or "") for _, _, role, text in group]
        spoken = [text for role, text in rows if role == "assistant"]
        r = found.pop(conv_id)
        assert r.n_turns == len(rows)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in rows).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len("".join(spoken)), hashlib.sha256("".join(spoken).encode()).hexdigest())
        own = [e for e in examples if e.conv_id == conv_id]
        assert sum(e.loss_length is not None for e in own) == len(spoken)
        assert sum(e.is_last for e in own) == 1
        assert r.formatted_chars == sum(len(e.formatted) for e in own)
        for e in own:
            assert e.formatted.count("<|im_start|>") == e.formatted.count("<|im_end|>\n")
            if e.loss_length is not None:
                assert e.formatted.endswith(chat.TURN_END) and e.loss_start + e.loss_length == len(e.formatted) - len(chat.TURN_END)
                assert e.formatted[: e.loss_start].endswith("<|im_start|>assistant\n")
    assert not found
    assert chat.digests(chat.examples(turns.where("1 = 0"))).count() == 0


def test_chat_uses_no_python(spark, sf_dir):
    plan = queries.QUERIES["op6_prefix_targets"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_archives_of_odd_rows(workers):
    big, other = "é" * 600, "z" * 2000
    rows = [(1, "http://a/\r\nWARC-Type: x", big), (2, "http://b", big), (3, None, "small"), (4, "http://d", "small"), (None, "u", big), (None, None, None), (5, "u", ""), (6, "u", other), (6, "u", other), (7, "u", "a\r\n\r\nb" * 400)]
    pages = workers.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    index, folder = warc.write_archives(pages)
    found = warc.resolved(index, folder, with_payload=True).collect()
    assert len(found) == len(rows) == index.count()
    types = sorted((str(r.page_id), r.record_type, r.refers_to) for r in found)
    assert types == sorted([("1", "revisit", 2), ("2", "response", None), ("None", "revisit", 2), ("None", "response", None), *[(str(k), "response", None) for k in (3, 4, 5, 6, 6, 7)]])
    by_id = {i: (h or "").encode() for i, _, h in rows if i is not None}
    for r in found:
        payload = by_id.get(r.page_id, bytes(r.payload))
        assert (r.payload_bytes, r.payload_digest, bytes(r.payload)) == (len(payload), hashlib.sha1(payload).hexdigest(), payload)
    assert next(r.url for r in found if r.page_id == 1) == "http://a/%0D%0AWARC-Type:%20x"
    some = warc.read_records(index.where("page_id = 7"), folder).collect()
    assert [bytes(r.payload) for r in some] == [by_id[7]]
    empty, folder = warc.write_archives(pages.where("1 = 0"))
    assert warc.resolved(empty, folder).count() == 0


def test_neighbouring_records_are_one_read():
    spots = [("a", 0, 10), ("a", 10, 5), ("a", 20, 5), ("a", 20 + warc.GAP_BYTES + 100, 7), ("b", 0, 3)]
    found = [(name, start, end, len(part)) for name, start, end, part in warc._ranges(spots)]
    assert found == [("a", 0, 25, 3), ("a", 120 + warc.GAP_BYTES, 127 + warc.GAP_BYTES, 1), ("b", 0, 3, 1)]


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        assert 0 < docs.count() <= before
        before = docs.count()
    assert docs.select("doc_id").distinct().count() == before
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == before
    places_are_gapless(packed.collect(), 2048)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_pipeline_stages_take_no_rows(spark, sf_dir, name, stage):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("1 = 0")
    assert stage(spark, docs, sf_dir).count() == 0


def test_folders_are_below_the_shared_one(spark):
    assert "/linkweft-llm/" in new_folder(spark, "x")
