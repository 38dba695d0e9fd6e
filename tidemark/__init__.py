"""tidemark: keyed sensor/event analytics on PySpark.

Tables and streams of keyed readings (id, ts, temp, seq): ingest, routing,
rolling and windowed aggregates, watermarks with lateness and late output,
keyed-state alerts, user functions and sinks. Everything is DataFrame, Spark
SQL or Structured Streaming code.
"""

from tidemark.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
