"""pagewright: document ingestion as Spark jobs.

Subpackages: ``functions`` (column expressions), ``sources`` (scans, registry,
fixtures), ``operators`` (change detection, registry mutations, queues,
statistics and page jobs), ``plans`` (whole runs, registered queries and their
DuckDB oracles), ``streaming`` (incremental ingest).
"""

__version__ = "0.1.0"
