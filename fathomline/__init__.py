"""fathomline: filing, market, recommendation, graph, streaming and tabular-learning
operators for PySpark.

Every operator takes DataFrames (or Columns) and returns DataFrames (or Columns), so Catalyst
sees one declarative plan and results never pass through the driver.
"""

__version__ = "0.1.0"
