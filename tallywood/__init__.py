"""Analytics operators written on PySpark DataFrames, Spark SQL, Spark ML and
Structured Streaming.

Sub-packages:

* ``sources``   readers, the ``coded_text`` format, writers and keyed tables
* ``operators`` row, join, group, window, ranking and pair-key operators
* ``functions`` column expressions (text, casts, nested values, vectors)
* ``plans``     what keeps plans sound at scale: scratch space, hot keys, ordered scans
* ``streaming`` incremental ingest and idempotent sinks
* ``stats``     correlation, independence tests, summaries
* ``learning``  features, models, tuning, evaluation, clustering, recommendation
* ``queries``   the registered queries with their SQL twins
"""

from tallywood.session import build_session

__all__ = ["build_session"]
