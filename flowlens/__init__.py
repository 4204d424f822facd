"""flowlens: company payment-flow analytics as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function that handles all
companies in one distributed pass.  Sub-packages:

* ``sources``   - readers, the test-data adapter, ingest and parquet sinks
* ``functions`` - reusable column expressions (sector/size rules, formats)
* ``operators`` - the analytics (flows, staging, sector, relations, risk ...)
* ``plans``     - the batch build and the query catalogue
* ``streaming`` - the monthly-flow aggregate fed by a file stream
"""

__version__ = "0.1.0"
