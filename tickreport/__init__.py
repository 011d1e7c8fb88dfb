"""tickreport: trade/quote analytics on Spark DataFrames.

Every operator is a function from DataFrame(s) to DataFrame built from native
column expressions, windows, joins and aggregates; nothing runs an action
except the explicit sinks and the size-checked broadcast helper.
"""

__version__ = "0.1.0"
