"""Daily retail sales panels on Spark: features, split, model, forecast, monitoring.

Every public function takes DataFrames (or column names) and returns a DataFrame.
Operators that read an intermediate table several times stage it when they are
called, which runs jobs; nothing else runs before the result is used, and nothing
is collected unless a docstring says so.
"""

__version__ = "0.1.0"
