"""scrutin: election-results analytics as Spark DataFrame, SQL and MLlib jobs.

Sub-packages:

* ``sources``   -- JDBC/CSV/Parquet readers, column resolution, the ballots
  and socio views derived from the benchmark tables.
* ``functions`` -- column expressions (rounding, coercion, label rules).
* ``operators`` -- cleaning, filters, enrichment, joins, aggregates,
  ordering, classification, share prediction and backtest.
* ``plans``     -- composed pipelines (preprocess, analyze, staged run).
"""

__version__ = "0.1.0"
