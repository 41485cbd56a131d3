"""sensorloom — process-plant sensor analytics as Spark DataFrame jobs.

Every operator is a plain function ``DataFrame -> DataFrame`` (or a small
Column builder) written with the DataFrame / SQL API so Catalyst can push
filters, prune columns and pick join strategies.  Layout:

* ``sensorloom.functions`` — Column expressions (NULL-aware arithmetic,
  guarded divide, cut/clip, name normalisation, epoch-time helpers).
* ``sensorloom.sources``   — scans and sinks (CSV/JSON/Parquet readers,
  test-table loaders and the derived fixtures).
* ``sensorloom.operators`` — time grid, resampling, windows, cleaning,
  filters, joins, quality screens, expectations, features, ML,
  clustering and the control search.
* ``sensorloom.plans``     — the registered queries and their SQL oracles.
* ``sensorloom.streaming`` — micro-batch adapter (the reference has no
  streams; see its module docstring).
"""

__version__ = "0.1.0"
