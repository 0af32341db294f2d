"""The seven crawl tables: columns, keys, references, enum rows, seeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Column types of the crawl tables (Spark DDL).
COLUMNS = {
    "data_type": "code string",
    "page_type": "code string",
    "site": "id bigint, domain string, robots_content string, sitemap_content string",
    "page": (
        "id bigint, site_id bigint, page_type_code string, url string, html_content string, "
        "http_status_code int, hash_code string, accessed_time timestamp_ntz"
    ),
    "page_data": "id bigint, page_id bigint, data_type_code string, data binary",
    "image": (
        "id bigint, page_id bigint, filename string, content_type string, data binary, "
        "accessed_time timestamp_ntz"
    ),
    "link": "from_page bigint, to_page bigint",
}

# The two enum tables.
DATA_TYPES = ("PDF", "DOC", "DOCX", "PPT", "PPTX")
PAGE_TYPES = ("HTML", "BINARY", "DUPLICATE", "FRONTIER")

# The seed rows.  A new site holds the text NULL, not a null.
NO_TEXT = "NULL"
SEED_SITE = "dummy-site-for-seeding-frontier.gov.si"
SEED_URLS = (
    "http://gov.si/",
    "http://www.e-prostor.gov.si/",
    "http://evem.gov.si/",
    "http://e-uprava.gov.si/",
)

# (table, column, parent, parent key) of the seven references.
REFERENCES = (
    ("image", "page_id", "page", "id"),
    ("link", "from_page", "page", "id"),
    ("link", "to_page", "page", "id"),
    ("page", "site_id", "site", "id"),
    ("page", "page_type_code", "page_type", "code"),
    ("page_data", "page_id", "page", "id"),
    ("page_data", "data_type_code", "data_type", "code"),
)

# Primary keys and unique columns.
UNIQUE_KEYS = (
    ("data_type", ("code",)),
    ("page_type", ("code",)),
    ("site", ("id",)),
    ("page", ("id",)),
    ("page", ("url",)),
    ("page_data", ("id",)),
    ("image", ("id",)),
    ("link", ("from_page", "to_page")),
)

# Longest text per column.
MAX_LENGTHS = (
    ("data_type", "code", 20),
    ("page_type", "code", 20),
    ("site", "domain", 500),
    ("page", "page_type_code", 20),
    ("page", "url", 3000),
    ("page", "hash_code", 128),
    ("page_data", "data_type_code", 20),
    ("image", "filename", 255),
    ("image", "content_type", 50),
)

Store = dict[str, DataFrame]


def is_waiting() -> Column:
    """Whether a page row is still in the frontier."""
    return F.col("page_type_code") == "FRONTIER"


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns and types of a crawl table, missing columns as NULL."""
    fields = [c.strip().split(" ") for c in COLUMNS[table].split(",")]
    return df.select(
        *[
            (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in fields
        ]
    )


def empty_store(spark: SparkSession) -> Store:
    """The seven tables without rows, enum tables filled."""
    store = {name: spark.createDataFrame([], ddl) for name, ddl in COLUMNS.items()}
    store["data_type"] = enum_table(spark, "data_type")
    store["page_type"] = enum_table(spark, "page_type")
    return store


def enum_table(spark: SparkSession, table: str) -> DataFrame:
    codes = {"data_type": DATA_TYPES, "page_type": PAGE_TYPES}[table]
    return spark.createDataFrame([(c,) for c in codes], COLUMNS[table])


def enum_usage(pages: DataFrame) -> DataFrame:
    """(code, pages) for each page type, those without pages included."""
    types = enum_table(pages.sparkSession, "page_type")
    counted = pages.groupBy(F.col("page_type_code").alias("code")).agg(
        F.count(F.lit(1)).alias("pages")
    )
    return types.join(counted, "code", "left").select(
        "code", F.coalesce("pages", F.lit(0)).cast("long").alias("pages")
    )
