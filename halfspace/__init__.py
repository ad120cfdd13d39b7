"""halfspace: land, check, flatten and analyse match-event documents with PySpark."""

__version__ = "0.1.0"
