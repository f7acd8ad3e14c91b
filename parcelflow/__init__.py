"""parcelflow — property-case lifecycle analytics on Spark.

Layers (each a set of functions from DataFrames to a DataFrame):

* ``sources``   — landing of dirty NDJSON feeds as all-text tables, the label
                  seed, the feed registry, and the binding of the test tables.
* ``functions`` — ``Column`` helpers (safe casts, key hashing, day arithmetic).
* ``operators`` — reusable relational building blocks (latest-per-key,
                  UNKNOWN members, skew-salted lookup join, top-k, checks).
* ``plans``     — staging, history, dimensions, facts, marts, dashboard
                  metrics and the ordered build that materializes them.
* ``streaming`` — incremental landing of new feed drops.
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming"]
