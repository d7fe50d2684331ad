"""tidewater: engagement analytics on Spark DataFrames.

Nested API pages -> post features -> staged least-squares regressions, plus
trade/quote tick cleaning and merging.  Every function takes and returns
DataFrames; see README.md for the operator map.
"""

__version__ = "0.1.0"
