"""casebook: DataFrame-in, DataFrame-out analytics jobs on Spark."""

__version__ = "0.1.0"
