"""Captures that arrive over time: each batch runs one crawl round."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linkweft.functions.url import canonical_url
from linkweft.operators import changes
from linkweft.operators.changes import next_id
from linkweft.plans.crawl import crawl_changes, highest_ids, written_stage
from linkweft.sources.schema import Store
from linkweft.sources.store import COMPACT_ROUNDS, batch_is_done, compact_store, read_store, rounds, save_round, seed_store, state

CAPTURE_COLUMNS = "page_id bigint, url string, html string"


def read_captures(
    spark: SparkSession, folder: str, files_per_batch: int = 1000, pattern: str = "*.parquet"
) -> DataFrame:
    """Stream of (page_id, url, html) from the parquet files of a folder."""
    return (
        spark.readStream.schema(CAPTURE_COLUMNS)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", pattern)
        .parquet(folder)
    )


def queued_captures(store: Store, captures: DataFrame, now: Column, base: int | None = None) -> DataFrame:
    """Frontier rows of the captured URLs that the store does not know."""
    found = captures.select(
        "url", F.col("page_id").alias("seen_at"), F.lit(0).alias("tie"), F.lit(1).alias("site_id")
    )
    return changes.add_frontier(found, store["page"], now, base)


def stream_id(spark: SparkSession) -> str:
    """Id of the stream whose batch is being run; it lasts as long as its checkpoint."""
    found = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise ValueError("a batch of captures has to be run by a stream, or be given a source")
    return found


def ingest_batch(root: str, now: Column, source: str | None = None, **options):
    """Function for `foreachBatch` which adds a batch of captures to a stored crawl.

    A batch becomes the next round of the store, whoever wrote the rounds before.  The
    round keeps the stream's id and the number of the batch, so a batch that is run again
    after a failure is told from a new one: it is left out if its round is complete, and
    replaces the round if not.  `source` names the stream, by default its own id.
    One writer at a time may add rounds.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = source or stream_id(spark)
        if batch_is_done(spark, root, name, batch_id):
            return
        first, last = rounds(spark, root)
        if last - state(spark, root)["base"] >= COMPACT_ROUNDS:
            compact_store(spark, root)
            last += 1
        number = last + 1
        store = read_store(spark, root)
        urls = batch.withColumn("url", canonical_url(F.col("url")))
        stage = written_stage(spark, f"{root}/stage/round={number}")
        captures = stage("captures", first_captures(urls))
        bases = highest_ids(state(spark, root))
        queued = stage("queued", queued_captures(store, captures, now, bases["page"]))
        bases["page"] = max(bases["page"], next_id(queued))
        store["page"] = store["page"].unionByName(queued)
        delta = crawl_changes(store, captures, now, keep_unreached=True, stage=stage, bases=bases, **options)
        # captured URLs that this round did not take stay in the frontier
        waiting = queued.join(delta["page"].select("id"), "id", "left_anti")
        delta["page"] = delta["page"].unionByName(waiting.select(*delta["page"].columns))
        save_round(delta, root, number, first, name, batch_id)

    return run


def first_captures(captures: DataFrame) -> DataFrame:
    """(url, html, page_id): of each URL the capture of least page_id, chosen on keys."""
    chosen = captures.groupBy("url").agg(F.min("page_id").alias("page_id"))
    return (
        captures.select("url", "html", "page_id")
        .join(chosen, ["url", "page_id"])
        .dropDuplicates(["url", "page_id"])
    )


def ingest_stream(
    captures: DataFrame, root: str, now: Column, checkpoint: str | None = None, **options
) -> StreamingQuery:
    """Start a query that takes up all waiting captures and then stops."""
    spark = captures.sparkSession
    if rounds(spark, root) is None:
        save_round(seed_store(spark, ()), root, 0)
    return (
        captures.writeStream.foreachBatch(ingest_batch(root, now, **options))
        .option("checkpointLocation", checkpoint or f"{root}/stream")
        .trigger(availableNow=True)
        .start()
    )


def stream_url_dedupe(
    captures: DataFrame,
    time_col: str | None = None,
    delay: str = "1 day",
    known: DataFrame | None = None,
) -> DataFrame:
    """Stream in which each canonical URL enters once.

    On an endless stream give `time_col`: the URLs kept in state are then bounded
    by the watermark, and rows that come later than `delay` are left out.  URLs of `known`,
    a table with a column `url` such as the stored pages, do not enter; they are taken off
    before the state, as they stand when the query starts.
    """
    canonical = captures.withColumn("url", canonical_url(F.col("url")))
    if time_col is not None:
        canonical = canonical.withWatermark(time_col, delay)
    if known is not None:
        new = canonical.join(known.select("url"), "url", "left_anti")
        canonical = new.select(*captures.columns)
    if time_col is None:
        return canonical.dropDuplicates(["url"])
    return canonical.dropDuplicatesWithinWatermark(["url"])
