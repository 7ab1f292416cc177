"""martlet: commerce marts as PySpark DataFrame operators.

Layers: ``sources`` (typed feeds, versioned Parquet tables), ``operators``
(gates, merges, latest-row, ranking, history), ``functions`` (column
expressions), ``plans`` (bronze, clean and mart tables) and ``streaming``.
Every time-dependent operator takes an explicit ``as_of`` date.
"""
