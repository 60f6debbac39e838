"""marketlens: marketplace analytics as Spark DataFrame jobs.

Layers (each a plain function returning a lazy DataFrame):

* ``sources``    — readers for the nine raw extracts (CSV or Parquet), the
  adapter that derives them from the TPC-H-shaped test tables, and sinks.
* ``functions``  — column-expression helpers (rounding, day differences,
  surrogate keys, great-circle distance, band ladders).
* ``operators``  — distributed global ranking (no single-partition window)
  and data-quality checks.
* ``plans``      — staging → intermediate → dimensions/facts → marts →
  analyses and dashboard questions, plus the pipeline that writes marts.
* ``streaming``  — intentionally empty: the workload is batch only.
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
