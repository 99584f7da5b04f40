"""lanwatch: LAN address-resolution security analytics on PySpark.

Every operator takes and returns DataFrames.  Sub-packages:

* ``sources``   – packet readers, contracts, sinks and state tables
* ``functions`` – column expressions (MAC normalisation, risk formulas)
* ``operators`` – dataset, features, sliding rules, forest, evaluation, trust ...
* ``plans``     – end-to-end compositions and the registered query catalogue
* ``streaming`` – Structured Streaming versions of ingest, features and rules
"""

__version__ = "0.1.0"
