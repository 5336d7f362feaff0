"""candela: technical indicators and trading signals for price series on Spark.

Everything is expressed with DataFrame operators and built-in functions so
Catalyst plans it and executors run it in the JVM:

* ``sources``   – bars from Parquet tables, CSV files, JDBC tables, JSON messages
* ``functions`` – ordered-series functions (rolling frames, recursive averages),
                  indicators and signal rules
* ``operators`` – bar construction, data-quality contracts, batch/stream comparison
* ``sinks``     – insert-if-absent, keyed upsert, idempotent append, JSON publishing
* ``streaming`` – Structured Streaming legs (decode, windows, dedup, per-ticker state)
* ``plans``     – the batch, stream and comparison jobs and the registered queries
"""

__version__ = "0.1.0"
