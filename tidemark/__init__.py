"""tidemark: incremental lakehouse ingestion as Spark DataFrame jobs.

Subpackages: ``functions`` (Column -> Column), ``operators`` (DataFrame ->
DataFrame), ``sources`` / ``sinks`` (readers and writers), ``plans`` (composed
jobs), ``streaming`` (incremental runs with Structured Streaming).
"""

__version__ = "0.1.0"
