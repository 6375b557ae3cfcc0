"""natspark: NAT syslog analytics as Spark DataFrame operators.

Every operator takes and returns DataFrames (or Columns), so the same code
serves batch jobs and Structured Streaming queries.
"""

__version__ = "0.1.0"
