"""tramline: table cleaning, auditing and profiling operators on Spark.

Every operator takes column names as parameters and returns a DataFrame plan;
counts come back as small aggregate DataFrames, never as rows pulled to the
driver.
"""

__version__ = "0.1.0"
