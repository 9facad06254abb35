"""emporia — e-commerce analytics as Spark DataFrame jobs.

Layers, each a set of pure ``DataFrame -> DataFrame`` functions:

* ``emporia.sources``    raw inputs (CSV ingest, the test-data adapter) and sinks
* ``emporia.functions``  column-level helpers (schema-tolerant coalesce, haversine, ...)
* ``emporia.operators``  staging, core, marts and the analyses built on them
* ``emporia.plans``      the model graph (lazy or materialised) and the query catalog
"""

__version__ = "0.1.0"
