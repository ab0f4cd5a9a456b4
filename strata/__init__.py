"""Strata: layered e-commerce data pipelines on Spark DataFrames.

Modules by layer:

* ``strata.sources`` / ``strata.sinks``: tables, JSON documents, message
  streams, JDBC; raw landing, silver datasets, reports, bucketed tables
* ``strata.functions``: column-level building blocks (parsing, flattening,
  key rules, skew-safe sequence functions, time arithmetic)
* ``strata.operators``: reconciliation, contracts, normalisation, keyed
  tables, checks and marts, all ``DataFrame -> DataFrame``
* ``strata.streaming``: bronze streams and stateful stream operators
* ``strata.jobs``: the pipeline entry points
* ``strata.plans``: the registered queries over the driver tables
"""

__version__ = "0.1.0"
