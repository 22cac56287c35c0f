"""Document ingestion on Spark: listing, extraction, storage by path and overlapping chunks."""
