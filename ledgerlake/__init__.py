"""ledgerlake: a retail-banking analytics pipeline on Spark DataFrames.

Layers (each a plain function from DataFrames to a DataFrame, composed lazily
so Catalyst sees the whole plan):

* ``sources``    raw-table scans with strict schemas, the city seed, test
                 adapters, and sinks (table writes, row counts)
* ``functions``  column expressions: standardisation, flags, bands, risk rules
* ``operators``  dedup, lookups, aggregations, data-quality checks,
                 incremental extract / upsert
* ``plans``      the staging, intermediate and mart models and ``build_all``
* ``streaming``  the incremental load as a Structured Streaming job
"""

__version__ = "0.1.0"
