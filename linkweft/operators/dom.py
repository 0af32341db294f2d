"""Element tree of pages as arrays of nodes, and element paths over it.

All work is within the row of a page: Spark cuts it into an array of pieces, and the functions of
`operators.tree` give the place of each tag and text in the tree, or the nodes that paths select.
Nothing is shuffled or sorted, so a task holds one batch of pages.  Only where
rows share a `page_id` do they meet first: their tokens are one page.

Start and end tags are paired one by one.  A stray end tag is passed over.  Elements that
HTML lets go without their end (`p`, `li`, `td`) end where a start tag that cannot be inside
them comes next to them (`ENDED_BY`), or with the element around them.  A container without
its end (`div`, `article`) reaches to the end of the element around it; any other unclosed
tag (`br`, a `b` without end) is a leaf, and text after it belongs to the element around
it.  `html`, `head` and `body` never nest, so that a truncated page has the same paths as a
whole one.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweft.functions import html as H
from linkweft.functions import patterns as P
from linkweft.functions.text import before_break, decode_entities, join_paragraphs, second_word, split_saving, strip
from linkweft.operators.records import ARTICLE_FIELDS, BOOK_FIELDS, PRODUCT_FIELDS
from linkweft.operators.tree import FIELDS, FRAME_TAGS, OF_RUNS, Path, Step, Test, page_hits, page_rows
from linkweft.plans.once import compute_once

# Steps a path may name although the tree lacks the element.
OPTIONAL_STEPS = (*FRAME_TAGS, "tbody")



def _page_tokens(pages: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, list[Column]]:
    """(page_id, keep, pieces) of each page, and what the functions of `operators.tree` get of it.

    Where rows share a page id, `tokens` takes the place of `pieces`.
    """
    cut = pages.select("page_id", *keep, "html")
    if pages.groupBy("page_id").count().where("count > 1").isEmpty():
        return compute_once(cut, {"pieces": H.pieces(F.col("html"))}), [F.coalesce("pieces", F.array().cast("array<string>"))]

    # places among all tokens are needed only to put those of several rows in order
    def numbered(piece: Column, at: Column) -> Column:
        place = lambda part: (at * 2 + part).alias("place")
        return F.transform(H.token_parts(piece), lambda t, part: F.struct(place(part), t["kind"], t["value"], t["source"]))

    tokens = F.flatten(F.transform(H.pieces(F.col("html")), numbered))
    found = compute_once(cut, {"tokens": tokens}).where(F.size("tokens") > 0)
    whole = F.array_sort(F.flatten(F.collect_list("tokens"))).alias("tokens")
    tags = lambda t: F.coalesce(t["source"], F.when(t["kind"] == "value", "").otherwise(F.concat(F.lit("</"), t["value"], F.lit(">"))))
    known = [F.transform("tokens", tags), F.transform("tokens", lambda t: t["place"]), F.transform("tokens", lambda t: F.when(t["kind"] == "value", t["value"]))]
    return found.groupBy("page_id", *keep).agg(whole), known


def page_structure(
    pages: DataFrame, keep: tuple[str, ...], fields: tuple[str, ...], numbered: bool = False, of_text: str = "", runs: bool = False
) -> DataFrame:
    """(page_id, keep, fields) of the elements and texts of each page, a row per node, end tags left out.

    The fields are those of `page_rows`, which tells what they are, texts decoded.  With `runs` a node also has (again, loose, times, unit).
    """
    cut, known = _page_tokens(pages, keep)
    given = cut.select("page_id", *keep, *[c.alias(f"_known{at}") for at, c in enumerate(known)])
    of_page = [f"`{k}` {cut.schema[k].dataType.simpleString()}" for k in ("page_id", *keep)]
    kinds = {k: FIELDS[k] for k in fields} | (OF_RUNS if runs else {})
    schema = ", ".join([*of_page, *[f"{k} {v}" for k, v in kinds.items()]])
    rows = given.mapInArrow(page_rows(len(of_page), fields, numbered, of_text, runs), schema)
    return rows.withColumn("text", decode_entities(F.col("text")))


def dom_nodes(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The node table of pages.

    (page_id, keep, node_id, parent_id, kind, tag, nth, level, path, attrs,
    after_tag, text); a path looks like `/div[1]/a[2]`, and that of a text is the
    path of the element around it.
    """
    fields = ("node_id", "parent_id", "tag", "nth", "level", "path", "source", "after_tag", "text")
    nodes = page_structure(pages, keep, fields, numbered=True)
    element = F.col("tag").isNotNull()
    return nodes.select(
        "page_id",
        *keep,
        "node_id",
        "parent_id",
        F.when(element, "element").otherwise("text").alias("kind"),
        "tag",
        F.when(element, F.col("nth")).alias("nth"),
        "level",
        "path",
        F.when(element, H.attributes(F.col("source"))).alias("attrs"),
        "after_tag",
        "text",
    )


def _path_steps(path: str) -> list[tuple[str, str, str]]:
    """(axis, tag or text(), predicates) of each step of an element path."""
    step = r"(//?)(text\(\)|[A-Za-z][A-Za-z0-9]*|\*)((?:\[[^\]]*\])*)"
    if not re.fullmatch(rf"(?:{step})+", path):
        raise ValueError(f"unsupported path: {path}")
    return re.findall(step, path)


def _step_test(predicates: str) -> tuple[list[tuple[str, str, bool]], int | None]:
    """What a step asks of the attributes of a tag (name, value, whether it is all of it), and of its place among siblings."""
    asked: list[tuple[str, str, bool]] = []
    place = None
    for text in re.findall(r"\[([^\]]*)\]", predicates):
        equal = re.fullmatch(r'@([\w-]+)\s*=\s*["\'](.*)["\']', text)
        holds = re.fullmatch(r'contains\(@([\w-]+),\s*["\'](.*)["\']\)', text)
        if text.isdigit():
            place = int(text)
        elif equal or holds:
            asked.append((*(equal or holds).groups(), bool(equal)))
        else:
            raise ValueError(f"unsupported predicate: [{text}]")
    return asked, place


def _hits(pages: DataFrame, paths: list[str]) -> DataFrame:
    """(page_id, hits) of pages with nodes: what the paths select, with the number of the path; see `page_hits`."""
    tests: list[Test] = []
    made: list[Path] = []
    for path in paths:
        steps: list[Step] = []
        gap_behind, wants_text = False, False
        for axis, tag, predicates in _path_steps(path):
            if tag == "text()":
                gap_behind, wants_text = axis == "//", True
                continue
            test = (tag, *_step_test(predicates))
            if test not in tests:
                tests.append(test)
            steps.append((axis == "//", tests.index(test), tag in OPTIONAL_STEPS and not predicates))
        made.append((steps, gap_behind, wants_text))
    cut, known = _page_tokens(pages)
    # written once, as a filter would be moved below the function together with it
    hits = compute_once(cut.select("page_id", page_hits(known, tests, made).alias("_hits")), {"hits": F.col("_hits")})
    return hits.select("page_id", "hits").where("hits is not null")


def _of_path(number: int) -> Column:
    return F.filter("hits", lambda h: h["path"] == number)


def path_select(pages: DataFrame, path: str) -> DataFrame:
    """(page_id, match_no, node_id, tag, text) of the nodes a path selects."""
    hits = _hits(pages, [path]).select("page_id", F.posexplode("hits").alias("at", "n"))
    text = decode_entities(F.col("n.text")).alias("text")
    return hits.select("page_id", (F.col("at") + 1).alias("match_no"), "n.node_id", "n.tag", text)


def path_lists(pages: DataFrame, paths: dict[str, str]) -> DataFrame:
    """(page_id, one ARRAY<STRING> per path): selected texts in page order."""
    lists = [
        F.transform(_of_path(number), lambda h: decode_entities(h["text"])).alias(name)
        for number, name in enumerate(paths)
    ]
    return _hits(pages, list(paths.values())).select("page_id", *lists)


def _zip_lists(lists: DataFrame, fields: dict[str, Column], lead: str) -> DataFrame:
    rows = lists.select("*", F.posexplode(lead).alias("_at", "_lead"))
    return rows.select(
        "page_id",
        (F.col("_at") + 1).alias("record_no"),
        *[c.alias(k) for k, c in fields.items()],
    )


def article_path(pages: DataFrame) -> DataFrame:
    """One record per article page; a missing node leaves its field NULL."""
    lists = path_lists(pages, P.ARTICLE_PATHS)
    first = {k: F.get(F.col(k), F.lit(0)) for k in ARTICLE_FIELDS}
    first["PublishedTime"] = before_break(first["PublishedTime"])
    first["Content"] = join_paragraphs(F.col("Content"))
    return lists.select("page_id", *[first[k].alias(k) for k in ARTICLE_FIELDS])


def product_path(pages: DataFrame) -> DataFrame:
    """One record per product of a list page; the contents decide the number."""
    lists = path_lists(pages, P.PRODUCT_PATHS)
    at = F.col("_at")
    saving, percent = split_saving(F.get(F.col("Savings"), at))
    fields = {k: F.get(F.col(k), at) for k in PRODUCT_FIELDS if k in P.PRODUCT_PATHS}
    fields |= {"Saving": saving, "SavingPercent": percent}
    return _zip_lists(lists, {k: fields[k] for k in PRODUCT_FIELDS}, "Content")


def book_path(pages: DataFrame) -> DataFrame:
    """One record per book of a list page; the authors decide the number."""
    lists = path_lists(pages, P.BOOK_PATHS)
    at = F.col("_at")
    fields = {k: F.get(F.col(k), at) for k in BOOK_FIELDS}
    fields["Author"] = strip(fields["Author"])
    fields["Binding"] = second_word(fields["Binding"])
    return _zip_lists(lists, fields, "Author")
