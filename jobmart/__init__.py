"""Job-market lakehouse operators for PySpark.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``) function: nothing is
collected, nothing reads the clock. Sub-packages:

* ``sources``    readers, column mapping, table writes
* ``functions``  column expressions: cleaning, text, HTML, follower counts
* ``operators``  dedup, merge, retention, checks, population pivot, enrichment
* ``plans``      the hourly and monthly flows and the report measures
* ``streaming``  Structured Streaming forms of the hourly flow
* ``catalog``    driver queries and their SQL counterparts
"""
