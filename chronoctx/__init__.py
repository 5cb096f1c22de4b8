"""Context-notification history as Spark DataFrame operators.

Every operator is a function from DataFrames to DataFrames built on native
Spark SQL expressions, so the same code serves batch jobs and the micro-batches
of a Structured Streaming query.
"""

from chronoctx.options import Options

__all__ = ["Options"]
