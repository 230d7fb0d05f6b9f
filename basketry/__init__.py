"""Shopper-event analytics as plain Spark DataFrame operators.

Sub-packages:

* ``sources``   – readers (raw event dataset, catalog CSV, stream sources,
                  the test-table mapping to shop events)
* ``functions`` – column-expression helpers (rates, JSON codec, ids, text)
* ``operators`` – ``DataFrame -> DataFrame`` building blocks (windows,
                  funnel, segments, ranking, catalog, audits)
* ``sinks``     – writers (CSV reports, text reports, partitioned datasets)
* ``streaming`` – Structured Streaming runners built from the same operators
* ``plans``     – composite batch jobs and the registered query set
"""

__all__ = ["session", "schemas"]
