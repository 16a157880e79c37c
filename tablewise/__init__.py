"""tablewise: everyday data-science operators as PySpark DataFrame jobs.

Every operator is a function from DataFrames to a DataFrame. Work is declared
with the DataFrame API so Catalyst prunes columns, pushes filters into the
Parquet scan and plans the joins; adaptive execution re-plans at shuffles.
"""

__version__ = "0.1.0"
