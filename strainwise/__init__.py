"""strainwise: variant, phenotype and resistance analytics for bacterial genomics on Spark.

Every operator is a function from DataFrames to a DataFrame.  Catalyst plans the
work; rules are data; nothing is pulled through the driver.
"""

__version__ = "0.1.0"
