"""capstan: document-capture analytics as Spark jobs.

Captures, blobs, archive records, capture indexes and item metadata are read
as DataFrames; every per-document rule is a Column expression so Catalyst can
prune, push down and code-generate it.  See README.md for the module map.
"""

__version__ = "0.1.0"
