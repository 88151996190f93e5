"""shelfmart: a medallion retail-sales warehouse expressed as Spark DataFrame plans.

Layers: bronze (raw extract, contract, CDC, load modes) -> silver (typed, cleaned,
filtered, quarantined) -> gold (SCD1/SCD2 dimensions, star fact, rollups) plus
control state (watermarks, run ledger, quality results) and profiling queries.
Every operator is a ``DataFrame -> DataFrame`` function; writes live only in
``shelfmart.sources.store`` and ``shelfmart.plans.pipeline``.
"""

__version__ = "0.1.0"
