"""cartographer: retail customer analytics as Spark DataFrame operators.

Every operator takes Spark DataFrames and returns a lazy DataFrame. Nothing is
collected to the driver except fitted model metadata and short literal lists
(pivot levels, category names) whose size is bounded by a parameter.
"""

__version__ = "0.1.0"
