"""encore: venue and music analytics on PySpark.

Every job is a pure function ``DataFrame(s) -> DataFrame``; sessions,
paths and dates are arguments.  Sub-packages:

* ``functions``  column-expression builders (no Python UDFs)
* ``sources``    scans, partition readers, client-log decoding, stand-in tables
* ``operators``  the batch jobs (catalog, features, popularity, machines, users, revenue)
* ``plans``      the daily pipeline that chains the jobs through partitioned tables
* ``streaming``  Structured Streaming counts and ``foreachBatch`` sinks
"""

__version__ = "0.1.0"
