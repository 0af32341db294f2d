"""Registered queries: each operator over whole given tables, with its check SQL."""

from linkweft.queries import crawl, pages, records, store, templates, urls  # noqa: F401
from linkweft.queries.registry import CHECKS, QUERIES  # noqa: F401
