"""revlens: review analytics on Spark.

Every operator is a lazy ``DataFrame -> DataFrame`` function built on Spark SQL
expressions (no Python UDFs, no driver collects).  Sub-packages:

* ``sources``   – readers and writers (CSV, JSON, Parquet) and schemas.
* ``functions`` – column expressions (text cleaning, scoring, formatting).
* ``operators`` – relational operators (cleaning, flags, RFM, patterns, ...).
* ``plans``     – end-to-end jobs and the mapping from the driver test tables.
* ``streaming`` – Structured Streaming forms of the trend aggregates.
"""

__version__ = "0.1.0"
