"""dockcast — station-occupancy analytics on Spark.

Subpackages: ``functions`` (column expressions, fixed values), ``sources``
(readers, scans, sinks), ``operators`` (skew-safe per-key sequences,
cleaning, windows, joins, aggregates, set operations, model, serving),
``plans`` (snapshot cleaning, features, serving, jobs, profile, the driver
catalog) and ``streaming`` (Structured Streaming forms of the flows).
"""

__version__ = "0.1.0"
