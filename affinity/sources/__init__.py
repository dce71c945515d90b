"""Scans, sinks and the interaction tables derived from the driver's data."""

from affinity.sources.io import (RATINGS_SCHEMA, MOVIES_SCHEMA, TAGS_SCHEMA, LINKS_SCHEMA,
                                 read_csv, read_parquet, load_or_convert, write_parquet,
                                 write_csv)
from affinity.sources.fixtures import (table, ratings, event_items, doc_words, labelled_documents)

__all__ = [
    "RATINGS_SCHEMA", "MOVIES_SCHEMA", "TAGS_SCHEMA", "LINKS_SCHEMA",
    "read_csv", "read_parquet", "load_or_convert", "write_parquet", "write_csv",
    "table", "ratings", "event_items", "doc_words", "labelled_documents",
]
