"""Event-driven demand features on Spark.

Sub-packages:

* ``functions``  column expressions (text cleaning, keyed digests, ISO dates)
* ``operators``  DataFrame -> DataFrame steps (privacy, validation, facts, bridge, mart, checks)
* ``sources``    readers and writers of the lake (exports, bronze, silver, quarantine, ledger)
* ``plans``      the batch jobs composed from the above
* ``streaming``  incremental pickup of newly landed exports
"""
