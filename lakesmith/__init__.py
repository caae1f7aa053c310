"""lakesmith: validated ingest and dimensional modelling as plain Spark DataFrame functions.

Layers (each a module package):

* ``sources``   – string-schema CSV / Parquet readers and writers, driver-table loaders and the
                  landing views derived from them.
* ``functions`` – column-level helpers built only from ``pyspark.sql.functions`` (guarded casts,
                  text normalisation, surrogate and date keys).
* ``operators`` – parameterised DataFrame -> DataFrame operators (cleanse, classify, dedupe,
                  accounting, dimensions, SCD2, point-in-time join, marts, data-quality checks).
* ``plans``     – the concrete silver and star-schema compositions, the publish job and the
                  query registry used by ``__spark_entry__``.
* ``streaming`` – incremental silver maintenance with Structured Streaming.
"""

__all__ = ["sources", "functions", "operators", "plans", "streaming"]
