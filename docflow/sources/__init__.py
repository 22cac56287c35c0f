"""Scans and sinks: listing pages, file bytes, keyed topics, the content store."""
