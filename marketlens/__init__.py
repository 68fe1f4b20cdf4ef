"""marketlens — e-commerce batch analytics on Spark DataFrames.

Layers (each a subpackage):

* ``sources``   — readers: raw CSV / JSON, Parquet datasets, catalog tables,
                  and the adapter that derives the raw inputs from the driver's
                  TPC-H-like test tables.
* ``sinks``     — partitioned / compressed Parquet, JSON, managed tables.
* ``functions`` — column helpers (exact rounding, money sums, day spans, ...).
* ``operators`` — the conversion jobs and the product-similarity operator.
* ``plans``     — the reports (business queries), the schema catalogue, and
                  measurement / data-quality jobs.
* ``streaming`` — intentionally empty: the modelled system is batch only.
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
