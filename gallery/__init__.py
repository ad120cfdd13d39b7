"""Every operator of the package, run over the whole driver tables.

Each query stands next to the SQL that gives the same rows.
"""

from gallery.registry import ORACLES, QUERIES

from gallery import analytics, checks, documents, landing, matches  # noqa: F401, I001

__all__ = ["ORACLES", "QUERIES"]
