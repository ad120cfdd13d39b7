"""Sources: raw JSON documents, stored objects and columnar tables."""

from halfspace.sources.feeds import FileFeed, TableFeed
from halfspace.sources.json_documents import elements, scan_documents
from halfspace.sources.objects import list_objects, read_bytes, read_texts, read_texts_below
from halfspace.sources.tables import read_table, read_table_or_empty

__all__ = [
    "FileFeed",
    "TableFeed",
    "elements",
    "list_objects",
    "read_bytes",
    "read_table",
    "read_table_or_empty",
    "read_texts",
    "read_texts_below",
    "scan_documents",
]
