"""pagesift: Spark-native filtering of web-crawl text archives and run reporting.

Sub-packages
------------
``functions``  Column expressions (postcode extraction, website, durations, log patterns).
``sources``    Readers: crawl list, manifest, lookup, logs, match output, the ``wet`` archive source.
``operators``  DataFrame -> DataFrame operators (matching, run status, output and log statistics).
``plans``      End-to-end jobs and the registry of named queries.
``streaming``  Incremental processing of newly landed archives with Structured Streaming.
"""

__version__ = "0.1.0"
