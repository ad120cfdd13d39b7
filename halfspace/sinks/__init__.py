"""Sinks: compressed columnar tables, versions of tables, files, named objects."""

from halfspace.sinks.files import exists, move, remove
from halfspace.sinks.objects import write_named_arrays, write_objects
from halfspace.sinks.tables import append_rows, replace_partitions, replace_table

__all__ = [
    "append_rows",
    "exists",
    "move",
    "remove",
    "replace_partitions",
    "replace_table",
    "write_named_arrays",
    "write_objects",
]
