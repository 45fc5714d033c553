"""Clickstream and ticket-sales analytics on PySpark DataFrames.

Library functions take and return DataFrames and run no action of their own;
only the writers in ``gatetally.sources`` and the jobs in ``gatetally.plans`` do.
"""

__version__ = "0.1.0"
