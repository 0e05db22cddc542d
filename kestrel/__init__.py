"""kestrel: DataFrame-in, DataFrame-out Spark jobs for lifetime analysis,
review-text classification, document retrieval preparation, delimited
export and chart/report tables.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` and
stays lazy unless its docstring says it runs a (bounded) job.
"""

__version__ = "0.1.0"
