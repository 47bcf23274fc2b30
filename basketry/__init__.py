"""basketry: the data work behind product recommendations, as Spark jobs.

Readers, cleaning, quality rules, feature tables, a factor model, top-K lists,
ranking metrics and event streams.  Every operator takes DataFrames and gives
a DataFrame back.
"""

__version__ = "0.1.0"
