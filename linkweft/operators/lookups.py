"""Joins between crawl tables, and checks of their constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweft.functions.url import url_host
from linkweft.plans.skew import HOT_ROWS, skew_lookup, task_parts
from linkweft.sources.schema import MAX_LENGTHS, REFERENCES, UNIQUE_KEYS, Store


def url_to_page(
    rows: DataFrame, page: DataFrame, spread_by: list[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add `to_page`, the id of the page stored under `url` (NULL if none).

    A URL which a large part of the rows name is spread over tasks.
    """
    ids = page.select("url", F.col("id").alias("to_page"))
    return skew_lookup(rows, ids, "url", spread_by, hot_rows=hot_rows).drop("_matched")


def first_sites(site: DataFrame) -> DataFrame:
    """(domain, site_id): the earliest site of each domain."""
    return site.groupBy("domain").agg(F.min("id").alias("site_id"))


def page_to_site(page: DataFrame, site: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(id, host, site_id): the site of each page by the host of its URL."""
    hosts = page.select("id", url_host(F.col("url")).alias("domain"))
    found = skew_lookup(hosts, first_sites(site), "domain", ["id"], hot_rows=hot_rows)
    return found.select("id", F.col("domain").alias("host"), "site_id")


def hash_groups(captures: DataFrame) -> DataFrame:
    """(hash_code, first_id, copies) per content hash.

    Combined before the shuffle, so copies of one text meet as counts.
    """
    return (
        captures.where("hash_code <> ''")
        .groupBy("hash_code")
        .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    )


def hash_exists(captures: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(id, hash_code, seen_before): whether an earlier row has the same hash."""
    # rows without content have the empty hash: as NULL they are spread over all tasks
    keyed = captures.select("id", "hash_code", F.nullif("hash_code", F.lit("")).alias("key"))
    groups = hash_groups(keyed).withColumnRenamed("hash_code", "key")
    found = skew_lookup(keyed, groups, "key", ["id"], count_col="copies", hot_rows=hot_rows)
    earlier = F.coalesce(F.col("first_id") < F.col("id"), F.lit(False))
    return found.select("id", "hash_code", earlier.alias("seen_before"))


def duplicate_of(captures: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(id, original_id) of each row with an earlier row of the same hash.

    The original is the earliest row.
    """
    keyed = captures.select("id", "hash_code").where("hash_code <> ''")
    found = skew_lookup(
        keyed,
        hash_groups(keyed).where(F.col("copies") > 1),
        "hash_code",
        ["id"],
        count_col="copies",
        hot_rows=hot_rows,
    )
    return found.where(F.col("first_id") < F.col("id")).select(
        "id", F.col("first_id").alias("original_id")
    )


def duplicate_links(captures: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(from_page, to_page): an edge from each copy to its original."""
    return duplicate_of(captures, hot_rows).select(
        F.col("id").alias("from_page"), F.col("original_id").alias("to_page")
    )


def with_politeness_key(rows: DataFrame, host_ip: DataFrame | None) -> DataFrame:
    """Add `host`, and `busy_key`: the address of the host, else the host itself."""
    hosted = rows if "host" in rows.columns else rows.withColumn("host", url_host(F.col("url")))
    if host_ip is None:
        return hosted.withColumn("busy_key", F.col("host"))
    found = skew_lookup(hosted, host_ip.select("host", "ip"), "host", ["url"])
    return found.select(*hosted.columns, F.coalesce("ip", "host").alias("busy_key"))


def frontier_available(
    frontier: DataFrame,
    in_flight: DataFrame | None,
    busy: DataFrame | None,
    host_ip: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Frontier rows whose `url` is not in flight and whose host is not busy.

    `busy` has one column `busy_key`: addresses where `host_ip` knows the host, else
    hosts.  None stands for an empty table.
    """
    columns = [*frontier.columns, "busy_key"]
    free = frontier
    if in_flight is not None:
        free = frontier.join(in_flight.select("url"), "url", "left_anti")
    keyed = with_politeness_key(free, host_ip)
    if busy is None:
        return keyed.select(*columns)
    blocked = busy.select("busy_key").distinct()
    found = skew_lookup(keyed, blocked, "busy_key", ["url"], hot_rows=hot_rows)
    return found.where(~F.col("_matched")).select(*columns)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def fk_violations(store: Store) -> DataFrame:
    """(constraint_name, value, child_rows) of references without parent.

    Rows of one value meet in one task, which keeps a count of them.
    """

    def check(child: str, column: str, parent: str, key: str) -> DataFrame:
        values = store[child].select(F.col(column).alias("value")).where(F.col("value").isNotNull())
        parents = store[parent].select(F.col(key).alias("value"))
        parts = task_parts(values, parents)
        if parts > 1:
            values, parents = values.repartition(parts, "value"), parents.repartition(parts, "value")
        values = values.groupBy("value").agg(F.count(F.lit(1)).alias("child_rows"))
        return values.join(parents, "value", "left_anti").select(
            F.lit(f"{child}.{column}").alias("constraint_name"),
            F.col("value").cast("string").alias("value"),
            "child_rows",
        )

    present = [r for r in REFERENCES if r[0] in store and r[2] in store]
    return _union([check(*r) for r in present])


def enum_violations(store: Store) -> DataFrame:
    """`fk_violations` of the references to the enum tables only."""
    enums = {"page_type", "data_type"}
    tables = {r[0] for r in REFERENCES if r[2] in enums} | enums
    found = fk_violations({k: v for k, v in store.items() if k in tables})
    names = [f"{c}.{col}" for c, col, parent, _ in REFERENCES if parent in enums]
    return found.where(F.col("constraint_name").isin(*names))


def unique_violations(store: Store) -> DataFrame:
    """(constraint_name, value, rows) of keys held by more than one row."""

    def check(table: str, keys: tuple[str, ...]) -> DataFrame:
        rows = store[table].select(*keys)
        parts = task_parts(rows)
        rows = rows.repartition(parts, *keys) if parts > 1 else rows
        grouped = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
        return grouped.where(F.col("rows") > 1).select(
            F.lit(f"{table}({','.join(keys)})").alias("constraint_name"),
            F.concat_ws(",", *[F.col(k).cast("string") for k in keys]).alias("value"),
            "rows",
        )

    return _union([check(t, k) for t, k in UNIQUE_KEYS if t in store])


def length_violations(store: Store, limits=MAX_LENGTHS) -> DataFrame:
    """(constraint_name, row_key, length) of texts above their column's limit."""

    def check(table: str, column: str, limit: int) -> DataFrame:
        key = "id" if "id" in store[table].columns else "code"
        size = F.length(column)
        return store[table].where(size > limit).select(
            F.lit(f"{table}.{column}").alias("constraint_name"),
            F.col(key).cast("string").alias("row_key"),
            size.alias("length"),
        )

    return _union([check(*m) for m in limits if m[0] in store])
