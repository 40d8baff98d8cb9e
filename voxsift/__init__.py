"""voxsift: customer-feedback triage as Spark DataFrame jobs.

Every step is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, joins, aggregations and windows.  The same functions run in
batch (``voxsift.plans``) and inside Structured Streaming micro-batches
(``voxsift.streaming``).
"""

__all__ = ["session"]
