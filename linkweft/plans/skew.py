"""Joins and numbering that hold when one key owns a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkweft.plans.session import written

# A key is hot from this many rows on.  A table of N rows has at most
# N / HOT_ROWS hot keys, which bounds what `skew_lookup` broadcasts: of each hot key
# a 64-bit hash and a number, so 10^12 rows give at most 10^6 rows of 12 bytes.
HOT_ROWS = 1_000_000


# Rows that `task_parts` means for a task; at most a few hundred MB where each is a key of its own.
TASK_ROWS = 1_000_000


def task_parts(*tables: DataFrame) -> int:
    """How many tasks the largest of some tables needs, by its number of rows (a job each).

    For `repartition` by a key, after which Spark neither shuffles again for that key nor
    merges parts.  Left alone it merges them to about as many as there are cores, over all
    sides of a union together, so that what a task holds grows with the table.
    """
    return max(1, *(-(-t.count() // TASK_ROWS) for t in tables))


def key_rows(df: DataFrame, on: str, count_col: str = "_n") -> DataFrame:
    """One row per key with its number of rows (combined before the shuffle)."""
    return df.groupBy(on).agg(F.count(F.lit(1)).alias(count_col))


def skew_lookup(
    left: DataFrame,
    right: DataFrame,
    on: str,
    spread_by: Sequence[str],
    count_col: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join to a lookup table which has one row per `on`.

    A key with n left rows gets ceil(n / hot_rows) copies of its lookup row, and
    its left rows are spread over the copies by a hash of `spread_by`; so no task
    has to take much more than `hot_rows` rows of one key, and all copies together
    are at most two per `hot_rows` left rows.  Only hashes of the hot keys and their
    numbers of copies are broadcast, never keys or payload; keys which share a hash get
    the same number of copies on both sides.  Rows without a key are spread too.

    `count_col` names a right column which already holds the number of left rows
    per key; without it the keys of `left` are counted first.  The result has the
    left columns, the payload, and `_matched`.
    """
    payload = [c for c in right.columns if c not in (on, count_col)]
    if count_col is None:
        count_col = "_n"
        counts = key_rows(left, on, count_col)
        right = right.join(counts, on)
    else:
        counts = right
    hashed = F.xxhash64(F.lit(on), F.col(on))
    copies = F.ceil(F.col(count_col) / F.lit(hot_rows)).cast("int")
    hot = F.broadcast(
        counts.where(F.col(count_col) > hot_rows)
        .groupBy(hashed.alias("_hot"))
        .agg(F.max(copies).alias("_copies"))
    )

    def with_copies(side: DataFrame) -> DataFrame:
        joined = side.withColumn("_hash", hashed).join(hot, F.col("_hash") == F.col("_hot"), "left")
        return joined.withColumn("_copies", F.coalesce("_copies", F.lit(1))).drop("_hash", "_hot")

    spread = with_copies(right.select(on, *payload)).select(
        on,
        *payload,
        F.lit(True).alias("_matched"),
        F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("_salt"),
    )
    copies_here = F.when(F.col(on).isNull(), F.lit(4096)).otherwise(F.col("_copies"))
    salted = with_copies(left).withColumn(
        "_salt", F.pmod(F.xxhash64(*spread_by), copies_here).cast("int")
    )
    return salted.join(spread, [on, "_salt"], "left").select(
        *left.columns, *payload, F.coalesce("_matched", F.lit(False)).alias("_matched")
    )


def number_rows(
    df: DataFrame,
    by: str,
    ties: Sequence[str] = (),
    within: Sequence[str] = (),
    out: str = "row_no",
    base: Column | int = 0,
    parts: int | None = None,
) -> DataFrame:
    """Number rows 1, 2, ... in order of `by`, then `ties`.

    The same as `row_number() over (partition by within order by by, ties)`, but
    no task sorts a whole group, and neither equal groups nor equal values of `by` meet in
    one task: rows are dealt into `parts` ranges of (within, by, ties), as many as the
    session shuffles to unless given, which sampling makes about even; the rows of all
    lower ranges are added as an offset.  The sorted rows are written below the shared
    folder, since their places count twice.  Only row counts per range (and group) meet
    in one window.
    """
    order = [*within, by, *ties]
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = written(placed.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    # the upper bits of a place are the number of its range
    placed = placed.withColumn("_range", F.shiftright("_place", 33))
    keys = [*within, "_range"]
    lower = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(lower), F.lit(0)))
        .drop("_rows")
    )
    same = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
    number = F.col("_place") - F.col("_first") + 1 + F.col("_before") + base
    return (
        placed.alias("n")
        .join(offsets.alias("o"), same)
        .select(*[F.col(f"n.{c}") for c in df.columns], number.cast("long").alias(out))
    )
