"""pullscope: pull-request corpus analytics as lazy Spark DataFrame operators.

Subpackages
-----------
functions   Column -> Column scalar expressions (title class, URL parsing, word counts, ...)
sources     readers for tables, landed JSON payloads and framed git text; writers (sinks); state
operators   DataFrame -> DataFrame operators (labels, joins, aggregates, statistics, revisions, quality)
plans       end-to-end flows (collect, classify, report, export) and the query registry
streaming   Structured Streaming ingestion and incremental volume
"""

__all__ = ["session"]
