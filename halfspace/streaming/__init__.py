"""Streaming forms."""

from halfspace.streaming.landing import EmptyFileError, empty_files, land_event_files, land_new_files

__all__ = ["EmptyFileError", "empty_files", "land_event_files", "land_new_files"]
