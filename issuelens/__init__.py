"""issuelens: per-issue commit, churn and code metrics as Spark DataFrame operators.

See README.md for the layout; every public operator is a function from
DataFrames to a lazily planned DataFrame.
"""

__version__ = "0.1.0"
