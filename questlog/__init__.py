"""questlog: game-event analytics on Spark DataFrames.

Layers: ``sources`` (readers, writers, driver-table mapping), ``functions``
(column expressions), ``operators`` (KPI and dashboard marts),
``streaming`` (Structured Streaming jobs), ``plans`` (query registry,
SQL oracle, plan checks).
"""

__version__ = "0.1.0"
