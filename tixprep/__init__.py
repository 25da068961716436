"""tixprep — dataset preparation for free-text ticket tables, built on Spark DataFrames.

Every operator is a ``DataFrame -> DataFrame`` function composed from native Spark SQL
expressions, so Catalyst can push filters and prune columns, and randomness is seeded by
row keys (never ``rand()``) so results do not depend on partitioning or task retries.
"""

__version__ = "0.1.0"
