"""postscope: social-post analytics on Spark DataFrames.

Subpackages
-----------
sources    readers and writers (NDJSON posts, strict decode, dead letters, Parquet)
           and the adapters that shape the driver's tables as posts
functions  column expressions (days, handles, text predicates, emoji patterns)
operators  DataFrame -> DataFrame steps (extract, aggregate, top-k, joins, sketches)
plans      questions Q1-Q5, data-quality profiles, ingest, run events, the
           on-demand registry and the catalog of registered queries
streaming  file-arrival processing with Structured Streaming
"""

from postscope.schema import POST, POST_DDL  # noqa: F401

__version__ = "0.1.0"
