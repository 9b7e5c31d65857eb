"""Prepare wide tables and learn interpretable decision trees on Spark.

Every operator takes and returns a ``DataFrame`` (or a ``Column``); only schema
information, statistics and tree nodes ever reach the driver.
"""

__version__ = "0.1.0"
