"""Reading and writing: crawl tables, saved pages, records, templates.

A stored crawl is a folder with one parquet folder per table, to which a round only
appends a `round=<n>` folder.  Settled rows never change.  Of the frontier a round writes the
rows that are new and the ids of those that left it, of the site table the new and changed
rows, of which the latest counts; so what a round writes follows what it changes, not what
is there.  The marker of a round, written last, keeps the highest ids and the numbers of
rows, and the round from which these changes are to be read, `base`: `compact_store` writes
frontier and sites as a whole and moves it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkweft.operators.template import template_lines
from linkweft.sources.schema import (
    COLUMNS,
    NO_TEXT,
    SEED_SITE,
    SEED_URLS,
    Store,
    conform,
    empty_store,
    enum_table,
    is_waiting,
)


# Columns of the marker of a round: where its store and its changes begin, the stream and
# batch that made it, rows in the frontier, settled rows, and the highest ids.
NUMBERED = ("page", "site", "image", "page_data")
MARKER = (
    "first_round int, base int, source string, batch long, waiting long, settled long, "
    + ", ".join(f"top_{t} long" for t in NUMBERED)
)

# Rounds of changes after which writers of a store compact it.
COMPACT_ROUNDS = 64


def scan_pages(page: DataFrame) -> DataFrame:
    """All pages taken from the frontier, by id."""
    return page.where(~is_waiting()).orderBy("id")


def scan_sites(site: DataFrame) -> DataFrame:
    return site.orderBy("id")


def scan_images(image: DataFrame) -> DataFrame:
    return image.orderBy("id")


def scan_page_data(page_data: DataFrame) -> DataFrame:
    return page_data.orderBy("id")


def scan_links(link: DataFrame) -> DataFrame:
    return link.orderBy("from_page", "to_page")


def save_html_files(pages: DataFrame, folder: str, end: str = "\r") -> int:
    """Write the `html` of each page as a file of its own, with `end` after it; the number of files.

    Tasks write through the file system of the folder: Spark's writer makes a new committed part
    of every page, ten times as slow.  A file is named by partition and row, so a task that
    is run again replaces its files.  Without html a file holds `end` only, which keeps it from
    being empty, as readers pass over empty files.
    """
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    tail = end.encode()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for html in batch.column(0).cast(pa.binary()):
                with system.open_output_stream(f"{path}/page-{part:06d}-{number:09d}.html", compression=None) as out:
                    out.write((html.as_py() or b"") + tail)
                number += 1
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["files"])

    return pages.select("html").mapInArrow(write, "files long").agg(F.sum("files")).first()[0] or 0


def load_html_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, html) of saved pages, one row per file."""
    return (
        spark.read.text(paths, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))
    )


def records_to_json(records: DataFrame, keys: list[str], out: str = "record") -> DataFrame:
    """Pack record columns into one JSON text; a NULL field leaves its key out."""
    rest = [c for c in records.columns if c not in keys]
    return records.select(*rest, F.to_json(F.struct(*keys), {"ignoreNullFields": "true"}).alias(out))


def write_records(records: DataFrame, folder: str) -> None:
    records.write.mode("overwrite").json(folder)


def write_template(template: DataFrame, folder: str) -> None:
    """Text files of `group<tab>line`, sorted by group and by the order of the template's tree.

    Groups are dealt by range, so a file holds many groups and no task more than its share.
    """
    (
        template_lines(template)
        .repartitionByRange("grp", "line_no")
        .sortWithinPartitions("grp", "line_no")
        .select(F.concat_ws("\t", "grp", "line").alias("value"))
        .write.mode("overwrite")
        .text(folder)
    )


def read_template(spark: SparkSession, folder: str) -> DataFrame:
    """(grp, line_no, line) of written templates, numbered as they stand in the files."""
    files = spark.read.text(folder, wholetext=True).select(
        F.col("_metadata.file_name").alias("file"),
        F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n")).alias("pos", "text"),
    )
    rows = files.where("text <> ''").select(
        "file", "pos", F.substring_index("text", "\t", 1).alias("grp"), "text"
    )
    line_no = F.row_number().over(Window.partitionBy("grp").orderBy("file", "pos"))
    return rows.select("grp", line_no.alias("line_no"), F.expr("substr(text, length(grp) + 2)").alias("line"))


def seed_store(spark: SparkSession, urls: tuple[str, ...] = SEED_URLS) -> Store:
    """Empty tables with one site row and the seed URLs in the frontier."""
    store = empty_store(spark)
    site = spark.createDataFrame([(1, SEED_SITE, NO_TEXT, NO_TEXT)], COLUMNS["site"])
    rows = spark.createDataFrame([(i + 1, u) for i, u in enumerate(urls)], "id bigint, url string")
    page = rows.select(
        "id",
        "url",
        F.lit(1).alias("site_id"),
        F.lit("FRONTIER").alias("page_type_code"),
        F.lit("").alias("html_content"),
        F.lit(0).alias("http_status_code"),
        F.lit("").alias("hash_code"),
        F.localtimestamp().alias("accessed_time"),
    )
    return {**store, "site": conform(site, "site"), "page": conform(page, "page")}


def reset_store(spark: SparkSession, root: str, urls: tuple[str, ...] = SEED_URLS) -> None:
    """Start anew with empty tables and the seeds.

    Nothing is deleted: the seeds are written as the next round, and from then on
    readers ignore every earlier one.
    """
    known = rounds(spark, root)
    number = known[1] + 1 if known else 0
    save_round(seed_store(spark, urls), root, number, first=number)


def save_round(
    delta: Store,
    root: str,
    number: int,
    first: int = 0,
    source: str | None = None,
    batch: int | None = None,
) -> None:
    """Write the changes of one round; writing a round again replaces it.

    A round that a stream made keeps the stream's id and the batch it took up.

    `page` holds changed rows of every state: those still in the frontier are new there, the
    others are settled and leave it.  `site` holds new and changed sites.  With `first` the
    round itself, a store begins anew and these are all its rows.  The round counts for
    readers once its marker is written, which is the last step.
    """
    spark = delta["page"].sparkSession
    before = None if first == number else state(spark, root)
    waiting = is_waiting()
    settled = delta["page"].where(~waiting)
    left = settled.select("id", *[F.lit(None).cast(c.dataType).alias(c.name) for c in delta["page"].schema if c.name != "id"])
    parts = {
        "page": settled,
        "frontier": delta["page"].where(waiting).withColumn("gone", F.lit(False)).unionByName(left.withColumn("gone", F.lit(True))),
        **{t: delta[t] for t in ("site", "page_data", "image", "link")},
    }
    for table, rows in parts.items():
        rows.write.mode("overwrite").parquet(f"{root}/{table}/round={number}")

    def highest(table: str) -> int:
        return max(_round(spark, root, table, number).agg(F.max("id")).first()[0] or 0, before[f"top_{table}"] if before else 0)

    came = ~F.col("gone")
    known = F.col("id") <= before["top_page"] if before else F.lit(False)
    changes = _round(spark, root, "frontier", number).agg(
        F.count_if(came).alias("came"), F.count_if(~came & known).alias("went"), F.count_if(~came).alias("settled"), F.max("id").alias("top")
    ).first()
    row = {
        "first_round": first,
        "base": before["base"] if before else number,
        "source": source,
        "batch": batch,
        "waiting": (before["waiting"] if before else 0) + changes["came"] - changes["went"],
        "settled": (before["settled"] if before else 0) + changes["settled"],
        "top_page": max(changes["top"] or 0, before["top_page"] if before else 0),
        **{f"top_{t}": highest(t) for t in NUMBERED if t != "page"},
    }
    _mark(spark, root, number, row)


def _mark(spark: SparkSession, root: str, number: int, row: dict) -> None:
    names = [c.split(" ")[0] for c in MARKER.split(", ")]
    marker = spark.createDataFrame([tuple(row[n] for n in names)], MARKER).coalesce(1)
    marker.write.mode("overwrite").parquet(f"{root}/done/round={number}")


def _round(spark: SparkSession, root: str, table: str, number: int) -> DataFrame:
    """The rows that one round wrote to a table."""
    columns = f"{COLUMNS['page']}, gone boolean" if table == "frontier" else COLUMNS[table]
    return spark.read.schema(columns).parquet(f"{root}/{table}/round={number}")


def compact_store(spark: SparkSession, root: str) -> None:
    """Add a round which holds the frontier and the sites as a whole, so that readers begin there."""
    first, last = rounds(spark, root)
    store, before = read_store(spark, root), state(spark, root)
    number = last + 1
    whole = {
        "frontier": store["page"].where(is_waiting()).withColumn("gone", F.lit(False)),
        "site": store["site"],
        **{t: store[t].where(F.lit(False)) for t in ("page", "page_data", "image", "link")},
    }
    for table, rows in whole.items():
        rows.write.mode("overwrite").parquet(f"{root}/{table}/round={number}")
    _mark(spark, root, number, {**before, "base": number, "source": None, "batch": None})


def _markers(spark: SparkSession, root: str) -> DataFrame | None:
    """The markers of complete rounds, None where no round was ever written."""
    try:
        return spark.read.schema(f"{MARKER}, round int").parquet(f"{root}/done")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def rounds(spark: SparkSession, root: str) -> tuple[int, int] | None:
    """First and last complete round of a store, None for a folder without one."""
    done = _markers(spark, root)
    if done is None:
        return None
    row = done.agg(F.max_by("first_round", "round"), F.max("round")).first()
    return None if row[1] is None else (row[0], row[1])


def state(spark: SparkSession, root: str) -> dict | None:
    """The marker of the last complete round."""
    done = _markers(spark, root)
    row = None if done is None else done.orderBy(F.desc("round")).first()
    return None if row is None else {k: v for k, v in row.asDict().items() if k != "round"}


def batch_is_done(spark: SparkSession, root: str, source: str, batch: int) -> bool:
    """Whether some complete round has taken up this batch of this stream."""
    done = _markers(spark, root)
    taken = (F.col("source") == source) & (F.col("batch") == batch)
    return done is not None and not done.where(taken).isEmpty()


def read_store(spark: SparkSession, root: str) -> Store:
    """The tables as of the last complete round."""
    first, last = rounds(spark, root)
    base = state(spark, root)["base"]

    def appended(table: str) -> DataFrame:
        rows = spark.read.schema(f"{COLUMNS[table]}, round int").parquet(f"{root}/{table}")
        return rows.where(F.col("round").between(first, last)).drop("round")

    def changes(table: str, columns: str) -> DataFrame:
        rows = spark.read.schema(f"{columns}, round int").parquet(f"{root}/{table}")
        return rows.where(F.col("round").between(base, last))

    frontier = changes("frontier", f"{COLUMNS['page']}, gone boolean")
    waiting = frontier.where("not gone").join(frontier.where("gone").select("id"), "id", "left_anti")
    latest = Window.partitionBy("id").orderBy(F.desc("round"))
    site = changes("site", COLUMNS["site"]).withColumn("_version", F.row_number().over(latest))
    return {
        **{t: enum_table(spark, t) for t in ("data_type", "page_type")},
        **{t: appended(t) for t in ("page_data", "image", "link")},
        "page": appended("page").unionByName(conform(waiting, "page")),
        "site": conform(site.where("_version = 1"), "site"),
    }
