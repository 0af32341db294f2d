"""Web-crawl tables, page-record extraction and template induction on Spark."""
