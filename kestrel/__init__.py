"""kestrel: reusable PySpark data jobs on DataFrames, Structured Streaming and spark.ml.

Subpackages: ``functions`` (column expressions), ``sources`` (readers, parsers,
writers), ``operators`` (relational, text index, graph, learning), ``streaming``
(micro-batch jobs and the partitioned ETL) and ``plans`` (the registered queries).
"""

__version__ = "0.1.0"
